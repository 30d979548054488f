"""Data-quality metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.columns import KEYS, first_rank_key, is_current, ratio
from modelmon.functions.ordering import top_per_group
from modelmon.functions.sizes import bounded, reliable
from modelmon.operators.observations import side_counts, value_counts, weighted, with_cutoff
from modelmon.operators.registry import Metric, register, register_family

DEFAULT_TOP_N = 10


def counts(rows: DataFrame, cutoff: float | DataFrame = 0.5) -> DataFrame:
    """Everything a single filtered count or mean can say about a variable."""
    value = F.col("value")
    n_cur, n_base = side_counts()
    null_cur, null_base = side_counts(value.isNull())
    approved_cur, approved_base = side_counts(value > F.col("cutoff"))
    outside = (value < 0.0) | (value > 1.0)
    return (
        with_cutoff(rows, cutoff)
        .groupBy(*KEYS)
        .agg(
            n_cur.alias("n_cur"),
            n_base.alias("n_base"),
            null_cur.alias("null_cur"),
            null_base.alias("null_base"),
            approved_cur.alias("approved_cur"),
            approved_base.alias("approved_base"),
            F.count_if(is_current() & outside).alias("outside_cur"),
            F.avg(F.when(is_current(), value)).alias("mean_cur"),
            F.avg(F.when(~is_current(), value)).alias("mean_base"),
        )
    )


def text_counts(rows: DataFrame) -> DataFrame:
    """The plain counts for text variables."""
    n_cur, n_base = side_counts()
    null_cur, null_base = side_counts(F.col("value").isNull())
    return rows.groupBy(*KEYS).agg(
        n_cur.alias("n_cur"), n_base.alias("n_base"), null_cur.alias("null_cur"), null_base.alias("null_base")
    )


def distinct(rows: DataFrame) -> DataFrame:
    """Distinct values per variable: values are grouped first, so no task holds a whole set."""
    return value_counts(rows).groupBy(*KEYS).agg(
        F.sum("n_cur").alias("n_cur"),
        F.sum("n_base").alias("n_base"),
        F.count_if(F.col("value").isNotNull() & (F.col("n_cur") > 0)).alias("distinct_cur"),
    )


def _beyond(rows: DataFrame, quartiles: DataFrame) -> tuple[DataFrame, Column]:
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    fences = quartiles.select(*KEYS, (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))
    fenced = weighted(rows).join(bounded(reliable(fences)), KEYS, "left")
    return fenced, (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))


def _sizes() -> list:
    return [F.sum("n_cur").alias("n_cur"), F.sum("n_base").alias("n_base")]


def outliers(rows: DataFrame, quartiles: DataFrame) -> DataFrame:
    """Rows beyond 1.5 inter-quartile ranges. ``quartiles`` holds KEYS + q1, q3."""
    fenced, beyond = _beyond(rows, quartiles)
    return fenced.groupBy(*KEYS).agg(*_sizes(), F.sum(F.when(beyond, F.col("n_cur")).otherwise(0)).alias("outliers_cur"))


def values(counted: DataFrame, quartiles: DataFrame) -> DataFrame:
    """What ``distinct`` and ``outliers`` say, from one pass over values counted before."""
    fenced, beyond = _beyond(counted, quartiles)
    return fenced.groupBy(*KEYS).agg(
        *_sizes(), F.sum(F.when(beyond, F.col("n_cur")).otherwise(0)).alias("outliers_cur"),
        F.count_if(F.col("value").isNotNull() & (F.col("n_cur") > 0)).alias("distinct_cur"),
    )


def categories(rows: DataFrame, top_n: int | DataFrame = DEFAULT_TOP_N, max_top_n: int | None = None) -> DataFrame:
    """Category measures of text variables.

    ``top_n`` is one number, or a (model_id, variable, top_n) frame whose largest value is
    ``max_top_n``. Missing counts as a category.
    """
    per_value = value_counts(rows)
    limit = top_n if isinstance(top_n, int) else max(max_top_n or DEFAULT_TOP_N, DEFAULT_TOP_N)

    def leaders(count: str) -> DataFrame:
        order = [first_rank_key(F.col(count), F.col("value"))]
        present = per_value.where(F.col(count) > 0).select(*KEYS, "value", count)
        return top_per_group(present, KEYS, order, limit).withColumn("side", F.lit(count))

    top = leaders("n_cur").drop("n_cur").unionByName(leaders("n_base").drop("n_base"))
    if isinstance(top_n, DataFrame):
        policy = top_n.select("model_id", "variable", F.col("top_n").cast("int"))
        top = top.join(policy, ["model_id", "variable"], "left").where(
            F.col("rank") <= F.coalesce("top_n", F.lit(DEFAULT_TOP_N))
        )
    shared = (
        top.groupBy(*KEYS, "value")
        .agg(F.count_distinct("side").alias("sides"))
        .groupBy(*KEYS)
        .agg((F.count_if(F.col("sides") == 2) / F.count("*")).alias("jaccard"))
    )
    totals = per_value.groupBy(*KEYS).agg(
        F.sum("n_cur").alias("n_cur"),
        F.sum("n_base").alias("n_base"),
        F.max("n_cur").alias("largest_cur"),
        F.count_if(F.col("value").isNotNull() & (F.col("n_cur") > 0)).alias("distinct_cur"),
    )
    return totals.join(shared, KEYS, "left")


def completeness(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected dates without data. Both frames hold KEYS + date."""
    found = present.select(*KEYS, "date").distinct().withColumn("found", F.lit(1))
    return (
        expected.select(*KEYS, "date")
        .distinct()
        .join(found, [*KEYS, "date"], "left")
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("expected_dates"),
            F.count_if(F.col("found").isNull()).alias("missing_dates"),
            F.lit(0).alias("n_base"),
        )
    )


register_family("counts", counts)
register_family("distinct", distinct)
register_family("outliers", outliers)
register_family("categories", categories)
register_family("completeness", completeness)


def _has_base(value):
    return F.when(F.col("n_base") > 0, value)


NULL_RATE = register(Metric(
    "null_rate", "counts",
    lambda: ratio(F.col("null_cur"), F.col("n_cur")),
    lambda: _has_base(ratio(F.col("null_base"), F.col("n_base"))),
))
CARDINALITY_RATIO = register(Metric(
    "cardinality_ratio", "distinct", lambda: ratio(F.col("distinct_cur"), F.col("n_cur"))
))
OUTLIER_RATE = register(Metric(
    "outlier_rate", "outliers", lambda: ratio(F.col("outliers_cur"), F.col("n_cur"))
))
DOMINANT_CATEGORY_RATE = register(Metric(
    "dominant_category_rate", "categories", lambda: ratio(F.col("largest_cur"), F.col("n_cur"))
))
CATEGORY_COMPOSITION_DRIFT = register(Metric(
    "category_composition_drift", "categories",
    lambda: 1.0 - F.coalesce("jaccard", F.lit(1.0)),
    lambda: F.coalesce("jaccard", F.lit(1.0)),
))
MEDIAN_SHIFT = register(Metric(
    "median_shift", "quantiles",
    lambda: F.when(F.col("cur_p50").isNull() | F.col("base_p50").isNull(), 0.0)
    .when(F.col("base_p50") != 0, F.try_divide(F.abs(F.col("cur_p50") - F.col("base_p50")), F.abs("base_p50")))
    .when(F.col("cur_p50") == 0, 0.0)
    .otherwise(1.0),
    lambda: F.col("base_p50"),
    needs_baseline=True,
))
POPULATION_VARIATION = register(Metric(
    "population_variation", "counts",
    lambda: F.when(F.col("n_cur") > 0, F.abs(F.try_divide(F.col("n_base"), F.col("n_cur")) - 1.0))
    .when(F.col("n_base") > 0, 1.0)
    .otherwise(0.0),
    lambda: F.col("n_base"),
    needs_baseline=True,
))
COMPLETENESS = register(Metric(
    "completeness", "completeness", lambda: ratio(F.col("missing_dates"), F.col("expected_dates"))
))
