"""One metric on two frames: the direct metric call.

``calculate("null_rate", current, baseline, variable="age", thresholds={...})`` returns one
row with the columns of a metric result. Nothing is collected.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F

from modelmon.functions.columns import KEYS
from modelmon.operators import conjugate, quality, registry, stability
from modelmon.operators.bins import normalise_bins
from modelmon.operators.observations import from_pair
from modelmon.operators.thresholds import status_rule

PAIR_FAMILIES = {"roc", "fit", "lift", "separation"}
# Fixed value: the one metric that skips without a baseline in a run but still answers here.
WORKS_ALONE = {"concentration_gini"}


def calculate(
    name: str,
    current: DataFrame,
    baseline: DataFrame | None = None,
    thresholds: dict[str, float] | None = None,
    **params: Any,
) -> DataFrame:
    """One metric-result row for ``current`` against ``baseline``."""
    metric = registry.get(name)
    if metric.needs_baseline and baseline is None and name not in WORKS_ALONE:
        raise ValueError(f"{name} requires a baseline dataframe")
    spark = current.sparkSession
    thresholds = thresholds or {}
    ids = {k: params.get(k, "") for k in ("model_id", "information_date")}
    var_type = params.get("var_type", "input")
    variable = params.get("variable") or params.get("score_col") or params.get("target_col") or "score"
    table = _family_table(metric, current, baseline, {**params, "variable": variable, "var_type": var_type}, ids)
    if name in WORKS_ALONE and baseline is None:
        metric = registry.Metric(metric.name, metric.family, metric.value, metric.baseline)
    measured = registry.measure(table, [metric])
    key = spark.createDataFrame(
        [(ids["model_id"], ids["information_date"])], "model_id string, information_date string"
    )
    limit = {k: F.lit(thresholds.get(k)).cast("double") for k in ("threshold_ambar", "threshold_red")}
    empty_base = F.lit(0.0) if metric.baseline and baseline is not None else F.lit(None).cast("double")
    return key.join(measured, ["model_id", "information_date"], "left").select(
        "model_id",
        "information_date",
        F.lit(params.get("variable", variable)).alias("variable"),
        F.lit(params.get("var_type", "")).alias("var_type"),
        F.lit(name).alias("metric_name"),
        F.coalesce("metric_value", F.lit(0.0)).alias("metric_value"),
        F.when(F.col("metric_name").isNull(), empty_base).otherwise(F.col("baseline_value")).alias("baseline_value"),
        limit["threshold_ambar"].alias("threshold_ambar"),
        limit["threshold_red"].alias("threshold_red"),
        status_rule(F.col("metric_value"), limit["threshold_ambar"], limit["threshold_red"]).alias("status"),
        F.lit(params.get("baseline_process_date")).cast("string").alias("baseline_process_date"),
        F.lit(params.get("execution_id")).cast("string").alias("execution_id"),
        F.current_timestamp().alias("run_date"),
    )


def _family_table(metric, current, baseline, params, ids) -> DataFrame:
    spark = current.sparkSession
    build = registry.family(metric.family)
    data_type = params.get("data_type", "numeric")
    n_bins = params.get("n_bins", stability.DYNAMIC_BINS)

    if metric.family in PAIR_FAMILIES:
        return build(_pairs(current, baseline, params, ids))
    if metric.family == "correlation":
        names = [f.name for f in current.schema.fields if f.dataType.typeName() in _NUMERIC]
        names = params.get("columns", names)
        both = current.select(*names).withColumn("side", F.lit("current"))
        if baseline is not None:
            both = both.unionByName(baseline.select(*names).withColumn("side", F.lit("baseline")))
        keyed = both.withColumns({k: F.lit({**ids, **params}[k]) for k in KEYS})
        return build(keyed, names)
    if metric.family == "completeness":
        dates = params.get("expected_dates") or []
        column = params.get("date_column")
        keyed = {k: F.lit({**ids, **params}[k]) for k in KEYS}
        if not dates or column not in current.columns:
            dates, column = [], None
        expected = spark.createDataFrame([(str(d),) for d in dates], "date string").withColumns(keyed)
        present = (
            current.select(F.col(column).cast("string").alias("date")).withColumns(keyed)
            if column
            else expected
        )
        return build(expected, present)

    column = params.get("score_col") or params.get("target_col") or params["variable"]
    text = data_type == "categorical" or metric.family == "categories"
    rows = from_pair(
        current, baseline, column, variable=params["variable"], var_type=params["var_type"],
        data_type="categorical" if text else "numeric", **ids,
    )
    if metric.family in ("counts", "distinct") and not text and dict(current.dtypes)[column] == "string":
        rows = from_pair(
            current, baseline, column, variable=params["variable"], var_type=params["var_type"],
            data_type="categorical", **ids,
        )
        text = True
    if metric.family == "counts":
        return quality.text_counts(rows) if text else build(rows, params.get("cut_off_probability", 0.5))
    if metric.family == "outliers":
        return build(rows, stability.quartiles(stability.quantiles(rows, n_bins)))
    if metric.family == "categories":
        return build(rows, params.get("top_n", 10))
    if metric.family == "quantiles":
        return stability.dynamic_categories(rows, n_bins) if text else build(rows, n_bins)
    if metric.family in ("canonical", "split_psi", "target_psi"):
        bins = _bins(spark, params, ids)
        if metric.family == "split_psi":
            if bins is None:
                raise ValueError(f"{metric.name} requires bins")
            return build(rows, bins, params.get("cut_off_probability", 0.5))
        if metric.family == "target_psi":
            return build(rows, bins)
        dynamic = stability.dynamic_categories(rows, n_bins) if text else stability.quantiles(rows, n_bins)
        dynamic = dynamic.where(F.col("n_base") > 0)
        return dynamic.withColumn("psi_canonical", F.col("psi_dynamic")) if bins is None else build(
            rows, bins, dynamic, not text
        )
    return build(rows)


_NUMERIC = {"double", "float", "integer", "long", "short", "byte"}


def _bins(spark, params, ids) -> DataFrame | None:
    """Bins given as a DataFrame, or as a short list of dicts."""
    bins = params.get("bins")
    if bins is None or (isinstance(bins, list) and not bins):
        return None
    if isinstance(bins, list):
        columns = sorted({k for b in bins for k in b if k in _BIN_TYPES})
        ddl = ", ".join(f"{c} {_BIN_TYPES[c]}" for c in columns)
        rows = [
            tuple(_BIN_CASTS[_BIN_TYPES[c]](b[c]) if b.get(c) is not None else None for c in columns) for b in bins
        ]
        bins = spark.createDataFrame(rows, ddl)
        if "bin" not in columns:
            bins = bins.withColumn("bin", F.monotonically_increasing_id().cast("int"))
    fixed = {"model_id": F.lit(ids["model_id"]), "type": F.lit(params["var_type"]), "variable": F.lit(params["variable"])}
    return normalise_bins(bins.withColumns(fixed))


_BIN_TYPES = {
    "bin": "int", "bin_type": "string", "category_value": "string", "lb": "double", "ub": "double",
    "lower_bound_type": "string", "upper_bound_type": "string", "count_dev": "long",
}
_BIN_CASTS = {"int": int, "string": str, "double": float, "long": int}


def _pairs(current, baseline, params, ids) -> DataFrame:
    score, target = params.get("score_col", "score"), params.get("target_col", "target")
    keys = [c for c in current.columns if c not in (score, target)]

    def side(df: DataFrame, name: str) -> DataFrame:
        tie = conjugate.tie_order(keys) if keys else F.lit(0.0)
        return df.select(
            F.col(score).alias("score"), F.col(target).alias("target"), tie.alias("_tie")
        ).withColumns({"side": F.lit(name), **{k: F.lit(v) for k, v in ids.items()}})

    joined = side(current, "current")
    if baseline is not None:
        joined = joined.unionByName(side(baseline, "baseline"))
    return conjugate.as_pairs(joined, F.col("_tie"))
