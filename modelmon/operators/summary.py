"""Variable statistics and the one-row-per-run scoring summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.columns import KEYS, first_rank_key, is_current, one_per_key
from modelmon.operators.observations import value_counts
from modelmon.operators.stability import PERCENTILES
from modelmon.operators.thresholds import AMBAR, RED

# Stored texts of the summary.
PRE_SCORING = ["median_shift", "population_variation", "completeness"]
OK, STOP, REPROCESS, WARNING, PENDING_RUN = "OK", "Stop", "Reprocess", "WARNING", "DQR Process Pending"
DONE, PENDING = "DONE", "PENDING"


def _long(wide: DataFrame, statistics: list[tuple[str, Column, Column]], data_type: Column) -> DataFrame:
    entries = [
        F.struct(
            F.lit(name).alias("statistic"),
            value.cast("double").alias("statistic_value"),
            text.cast("string").alias("statistic_value_str"),
        )
        for name, value, text in statistics
    ]
    return wide.select(*KEYS, data_type.alias("data_type"), F.explode(F.array_compact(F.array(*entries))).alias("s")).select(
        *KEYS, "data_type", "s.*"
    )


def _counts(total: Column, non_null: Column) -> list[tuple[str, Column, Column]]:
    return [
        (name, value, value)
        for name, value in (
            ("count_total", total), ("count_non_null", non_null), ("count_null", total - non_null),
        )
    ]


def numeric_summary(rows: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Counts, range, mean, sample deviation and deciles of the current side, in long form.

    ``quantiles`` is the shared quantile pass. An all-null variable has its counts only.
    """
    v = F.col("value")
    plain = rows.where(is_current()).groupBy(*KEYS).agg(
        F.count("*").alias("total"), F.count(v).alias("non_null"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
    )
    return numeric_statistics(plain, quantiles)


def numeric_statistics(plain: DataFrame, quantiles: DataFrame) -> DataFrame:
    """The same from KEYS + total, non_null, min, max, mean, std."""
    deciles = quantiles.select(*KEYS, *[F.col(f"cur_p{p}") for p in PERCENTILES])
    wide = plain.join(deciles, KEYS, "left")
    counted = _long(wide, _counts(F.col("total"), F.col("non_null")), F.lit("numeric"))
    measured = [(s, F.coalesce(F.col(s), F.lit(0.0)), F.coalesce(F.col(s).cast("string"), F.lit("None"))) for s in ("min", "max", "mean", "std")]
    measured += [(f"p{p}", F.col(f"cur_p{p}"), F.col(f"cur_p{p}")) for p in PERCENTILES]
    return counted.unionByName(_long(wide.where(F.col("non_null") > 0), measured, F.lit("numeric")))


def categorical_summary(rows: DataFrame) -> DataFrame:
    """Counts, distinct categories and the most frequent one (missing is a category)."""
    per_value = value_counts(rows).where("n_cur > 0")
    wide = per_value.groupBy(*KEYS).agg(
        F.sum("n_cur").alias("total"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n_cur")).otherwise(0)).alias("non_null"),
        F.count("value").alias("distinct"),
        F.min(first_rank_key(F.col("n_cur"), F.col("value"))).alias("top"),
    )
    top_count = -F.col("top.n")
    statistics = _counts(F.col("total"), F.col("non_null")) + [
        ("distinct_count", F.col("distinct"), F.col("distinct")),
        ("top_category", F.lit(None), F.coalesce(F.col("top.value"), F.lit("None"))),
        ("top_category_count", top_count, top_count),
    ]
    return _long(wide, statistics, F.lit("categorical"))


def count_summary(rows: DataFrame, data_type: str) -> DataFrame:
    """Counts only: what variables of other data types (such as binary targets) get."""
    wide = rows.where(is_current()).groupBy(*KEYS).agg(F.count("*").alias("total"), F.count("value").alias("non_null"))
    return count_statistics(wide, F.lit(data_type))


def count_statistics(plain: DataFrame, data_type: Column) -> DataFrame:
    """The same from KEYS + total, non_null."""
    return _long(plain, _counts(F.col("total"), F.col("non_null")), data_type)


def vintage(information_date: Column) -> Column:
    return F.date_format(F.trunc(information_date.cast("date"), "month"), "yyyy-MM-dd")


def scoring_summary(results: DataFrame, summaries: DataFrame, available: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """One row per (model, date) from its metric results.

    ``available`` holds (model_id, information_date, done); a run without a row there is
    pending. ``models`` may bring (model_id, model_name).
    """
    run = ["model_id", "information_date"]
    name, kind, status = F.col("metric_name"), F.col("var_type"), F.col("status")
    inputs = kind.isin("raw", "input")

    def score_value(metric: str) -> Column:
        """That of the first variable by name; of several rows of it the smallest."""
        found = F.struct("variable", F.col("metric_value").alias("v"))
        return F.min(F.when((kind == "score") & (name == metric), found))["v"]

    def any_red(condition: Column) -> Column:
        return F.coalesce(F.bool_or(condition & (status == RED)), F.lit(False))

    per_run = results.groupBy(*run).agg(
        score_value("psi_canonical").alias("psi"),
        score_value("psi_dynamic").alias("psi_variation"),
        F.max(F.when(inputs & (name == "psi_canonical"), F.col("metric_value"))).alias("csi_max"),
        any_red(inputs & (name == "psi_canonical")).alias("csi_red"),
        any_red(inputs & name.isin(PRE_SCORING)).alias("pre_red"),
        F.bool_or(status.isin(RED, AMBAR)).alias("any_light"),
    )
    population = (
        summaries.where((F.col("var_type") == "score") & (F.col("statistic") == "count_total"))
        .groupBy(*run)
        .agg(F.min(F.struct("variable", F.col("statistic_value").alias("v")))["v"].alias("population_scored"))
    )
    joined = per_run.join(population, run, "left").join(available.select(*run, "done"), run, "left")
    if models is not None:
        joined = joined.join(one_per_key(models.select("model_id", "model_name"), ["model_id"]), "model_id", "left")
    else:
        joined = joined.withColumn("model_name", F.lit(None).cast("string"))
    done = F.coalesce("done", F.lit(False))
    return joined.select(
        F.coalesce("model_name", "model_id").alias("model_name"),
        F.col("information_date").cast("string").alias("scoring_date"),
        vintage(F.col("information_date")).alias("vintage"),
        F.when(done, DONE).otherwise(PENDING).alias("control_data_availability"),
        F.when(F.col("pre_red"), REPROCESS).otherwise(OK).alias("control_pre_scoring"),
        "psi",
        "psi_variation",
        "csi_max",
        F.when(F.col("csi_red"), STOP).otherwise(OK).alias("csi_status"),
        "population_scored",
        F.when(~done, PENDING_RUN)
        .when(F.col("pre_red"), REPROCESS)
        .when(F.col("any_light") | F.col("csi_red"), WARNING)
        .otherwise(OK)
        .alias("general_status"),
        *run,
    )
