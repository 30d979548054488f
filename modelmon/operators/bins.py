"""Development bins: building them, assigning values, counting, and the PSI they feed.

A bin row carries ``bin, bin_type, category_value, lb, ub, lower_bound_type,
upper_bound_type, count_dev`` next to ``model_id, type, variable``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from modelmon.functions.columns import KEYS, first_rank_key
from modelmon.functions.ordering import Grid, cut_points, top_per_group
from modelmon.functions.sizes import fits, reliable
from modelmon.operators.observations import occurrences, sizes, value_counts, weighted

PSI_EPSILON = 1e-6
# Shares over which a variable's values are dealt where its bins are too many to broadcast.
SPREAD = 64
NUMERIC, CATEGORICAL = "NUMERIC", "CATEGORICAL"
TRAINED_CATEGORIES = 50

BIN_COLUMNS = {
    "bin": "int",
    "bin_type": "string",
    "category_value": "string",
    "lb": "double",
    "ub": "double",
    "lower_bound_type": "string",
    "upper_bound_type": "string",
    "count_dev": "long",
}
BIN_DEFAULTS = {"bin_type": NUMERIC, "lower_bound_type": ">", "upper_bound_type": "<="}


def normalise_bins(bins: DataFrame) -> DataFrame:
    """Stored bins with every expected column, typed; absent bound types get their default."""
    columns = [
        (F.col(name).cast(dtype) if name in bins.columns else F.lit(BIN_DEFAULTS.get(name)).cast(dtype)).alias(name)
        for name, dtype in BIN_COLUMNS.items()
    ]
    keys = [F.col("model_id") if "model_id" in bins.columns else F.lit("").alias("model_id")]
    return bins.select(*keys, F.col("type").alias("var_type"), "variable", *columns)


def bound_holds(value: Column, bound: Column, operator: Column) -> Column:
    """One side of a bin. A missing or infinite bound, or an unknown operator, holds for all."""
    open_ended = bound.isNull() | (F.abs(bound) == float("inf"))
    return (
        F.when(open_ended, F.lit(True))
        .when(operator == ">", value > bound)
        .when(operator == ">=", value >= bound)
        .when(operator == "<", value < bound)
        .when(operator == "<=", value <= bound)
        .otherwise(F.lit(True))
    )


def in_bin(value: Column, numeric: bool = True, source: str = "b") -> Column:
    """Membership of a value in the bin of the joined row aliased ``source``."""
    if not numeric:
        return value == F.col(f"{source}.category_value")
    inside = bound_holds(value, F.col(f"{source}.lb"), F.col(f"{source}.lower_bound_type")) & bound_holds(
        value, F.col(f"{source}.ub"), F.col(f"{source}.upper_bound_type")
    )
    category = F.expr(f"try_cast({source}.category_value AS double)")
    return F.when(F.col(f"{source}.bin_type") == CATEGORICAL, value == category).otherwise(inside)


# -- building ---------------------------------------------------------------------------


def numeric_bins(rows: DataFrame, n_bins: int = 10, keys: list[str] = KEYS) -> DataFrame:
    """Right-closed quantile bins (-inf, e1] ... (e_last, inf) with their counts.

    Duplicate edges are kept and give empty bins. ``freq_dev`` is the share among binned rows.
    """
    cuts = cut_points(
        rows.withColumn("n", occurrences(rows)), keys, "value", ["n"], {"n": ["n"]}, [Grid("n", n_bins)]
    ).where((F.col("step") > 0) & (F.col("step") < n_bins))
    edges = cuts.groupBy(*keys).agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("step").cast("int").alias("i"), F.col("cut"), F.col("upto_n").alias("upto")))
        ).alias("edges"),
        F.first("total_n").alias("total"),
    )
    first = F.struct(F.lit(0).alias("i"), F.lit(float("-inf")).alias("cut"), F.lit(0).cast("long").alias("upto"))
    last = F.struct(F.lit(n_bins).alias("i"), F.lit(float("inf")).alias("cut"), F.col("total").alias("upto"))
    ends = F.concat(F.array(first), F.col("edges"), F.array(last))
    return (
        edges.select(*keys, "total", ends.alias("ends"))
        .select(*keys, "total", "ends", F.explode(F.sequence(F.lit(1), F.lit(n_bins))).alias("bin"))
        .select(
            *keys,
            "bin",
            F.lit(NUMERIC).alias("bin_type"),
            F.lit(None).cast("string").alias("category_value"),
            F.col("ends")[F.col("bin") - 1]["cut"].alias("lb"),
            F.col("ends")[F.col("bin")]["cut"].alias("ub"),
            F.lit(">").alias("lower_bound_type"),
            F.lit("<=").alias("upper_bound_type"),
            (F.col("ends")[F.col("bin")]["upto"] - F.col("ends")[F.col("bin") - 1]["upto"]).alias("count_dev"),
            "total",
        )
        .withColumn("freq_dev", F.col("count_dev") / F.col("total"))
        .drop("total")
    )


def category_counts(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return rows.groupBy(*keys, "value").agg(F.sum(occurrences(rows)).alias("count_dev"))


def categorical_bins(rows: DataFrame, top_n: int = TRAINED_CATEGORIES, keys: list[str] = KEYS) -> DataFrame:
    """The most frequent categories, each its own bin. Missing is a category of its own."""
    order = [first_rank_key(F.col("count_dev"), F.col("value"))]
    top = top_per_group(category_counts(rows, keys), keys, order, top_n, "bin")
    none = F.lit(None)
    return top.select(
        *keys,
        "bin",
        F.lit(CATEGORICAL).alias("bin_type"),
        F.col("value").cast("string").alias("category_value"),
        none.cast("double").alias("lb"),
        none.cast("double").alias("ub"),
        none.cast("string").alias("lower_bound_type"),
        none.cast("string").alias("upper_bound_type"),
        "count_dev",
    )


# -- counting ---------------------------------------------------------------------------


def bin_counts(rows: DataFrame, bins: DataFrame, numeric: bool = True) -> DataFrame:
    """Rows per (key, bin) and side against stored bins, zero-filled for empty bins.

    ``rows`` are observations. A category is counted before it meets the bins; a number meets
    the few bins of its own variable only. Bins too many to broadcast meet counted values, and each
    variable's values are dealt over ``SPREAD`` copies of its bins, so a variable with a third of all
    rows is not one task. Adds ``n_cur, n_base`` to each bin of each key.
    """
    owner = ["model_id", "var_type", "variable"]
    bins = bins.select(*owner, *BIN_COLUMNS)
    on = owner
    if fits(bins):
        counted, side = weighted(rows) if numeric else value_counts(rows), F.broadcast(bins)
    else:
        on = [*owner, "_share"]
        counted = value_counts(rows).withColumn("_share", F.pmod(F.xxhash64("value"), F.lit(SPREAD)).cast("int"))
        side = bins.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    matched = (
        counted.alias("o")
        .join(
            side.alias("b"),
            [F.col(f"o.{c}") == F.col(f"b.{c}") for c in on] + [in_bin(F.col("o.value"), numeric)],
        )
        .groupBy(*[F.col(f"o.{c}").alias(c) for c in KEYS], F.col("b.bin").alias("bin"))
        .agg(F.sum("o.n_cur").alias("n_cur"), F.sum("o.n_base").alias("n_base"))
    )
    wanted = sizes(rows).select(*KEYS).join(bins, owner)
    return wanted.join(matched, [*KEYS, "bin"], "left").fillna(0, ["n_cur", "n_base"])


def psi_term(actual: Column, expected: Column) -> Column:
    return (actual - expected) * F.ln((actual + PSI_EPSILON) / (expected + PSI_EPSILON))


def psi(binned: DataFrame, actual: str, expected: str, keys: list[str] = KEYS, name: str = "psi") -> DataFrame:
    """Population stability index per key over already counted bins."""
    totals = binned.groupBy(*keys).agg(
        F.greatest(F.sum(actual), F.lit(1)).alias("_a"), F.greatest(F.sum(expected), F.lit(1)).alias("_e")
    )
    return (
        binned.join(totals, keys)
        .groupBy(*keys)
        .agg(F.sum(psi_term(F.col(actual) / F.col("_a"), F.col(expected) / F.col("_e"))).alias(name))
    )


def woe(positive: Column, negative: Column, total_positive: Column, total_negative: Column) -> Column:
    """100 times the ratio of smoothed class shares, rounded to six places (not a logarithm)."""
    p = (positive + PSI_EPSILON) / F.when(total_positive == 0, 1).otherwise(total_positive)
    n = (negative + PSI_EPSILON) / F.when(total_negative == 0, 1).otherwise(total_negative)
    return (
        F.when(n <= 0, F.lit(float("inf")))
        .when(p <= 0, F.lit(float("-inf")))
        .otherwise(F.round(100.0 * F.try_divide(p, n), 6))
    )


def category_rank(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Every category with its share and its rank by frequency (ties by value, missing last).

    The counted categories are range-partitioned in rank order and fixed as a table with their
    partition number; a rank is then the rows of earlier partitions plus the place inside one.
    A variable with very many categories is spread like everything else.
    """
    spark = rows.sparkSession
    order = [F.desc("count_dev"), F.col("value").isNull(), F.col("value")]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    spread = reliable(
        category_counts(rows, keys).repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id())
    )
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    per_part = spread.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.sum("count_dev").alias("_rows"))
    per_part = per_part.select(
        *keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"), F.sum("_rows").over(whole).alias("_total")
    )
    inside = W.partitionBy("_part", *keys).orderBy(*order)
    return (
        spread.withColumn("_rank", F.row_number().over(inside))
        .join(per_part, [*keys, "_part"])
        .select(
            *keys,
            F.col("value").alias("category_value"),
            (F.col("_offset") + F.col("_rank")).cast("int").alias("rank_dev"),
            (F.col("count_dev") / F.col("_total")).alias("freq_dev"),
        )
    )
