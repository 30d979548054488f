"""Small column expressions shared by every operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# One measured quantity: every metric row carries these.
KEYS = ["model_id", "information_date", "var_type", "variable"]

CURRENT = "current"
BASELINE = "baseline"


def is_current() -> Column:
    return F.col("side") == CURRENT


def is_baseline() -> Column:
    return F.col("side") == BASELINE


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, and 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def clean_double(value: Column) -> Column:
    """As a double; NaN and text that is no number are missing."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), frames)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: of several the greatest, column by column, so that the choice is the same on every run."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    chosen = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_chosen"))
    return chosen.select(*[c if c in keys else F.col("_chosen")[c].alias(c) for c in df.columns])


def smallest_per_key(df: DataFrame, keys: list[str], values: list[str], removed: str | None = None) -> DataFrame:
    """``keys`` and ``values`` of one row per key: of several the smallest, so that the choice is the same on every run.

    ``removed`` names a column for the number of rows that went.
    """
    dropped = [(F.count("*") - 1).alias(removed)] if removed else []
    if len(values) == 1 and df.schema[values[0]].dataType.typeName() == "double":
        # A struct is compared by sorting; a number need not be. As in a struct, a missing value is the smallest.
        smallest = F.when(F.count(values[0]) == F.count("*"), F.min(values[0])).alias(values[0])
        return df.groupBy(*keys).agg(smallest, *dropped)
    chosen = df.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_chosen"), *dropped)
    return chosen.select(*keys, "_chosen.*", *([removed] if removed else []))


def first_rank_key(count: Column, value: Column) -> Column:
    """Sort key for 'most frequent first': ties go to the smaller value, null last."""
    return F.struct((-count).alias("n"), value.isNull().alias("is_null"), value.alias("value"))
