"""Measured values in long form: one row per (variable, side, source row).

``KEYS + side + value`` where side is ``current`` or ``baseline``. Numeric and text variables
travel in separate frames, so numbers are never turned into strings. One scan of a source
feeds all of its variables and both sides. Counted once by value (``value_counts``), the same
observations are ``KEYS + value + n_cur + n_base``; families take either form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.columns import (
    BASELINE,
    CURRENT,
    KEYS,
    clean_double,
    is_baseline,
    is_current,
)

from modelmon.functions.sizes import bounded


def from_pair(
    current: DataFrame,
    baseline: DataFrame | None,
    column: str,
    *,
    variable: str | None = None,
    var_type: str = "input",
    data_type: str = "numeric",
    model_id: str = "",
    information_date: str = "",
) -> DataFrame:
    """Observations of one column from a current and an optional baseline frame."""

    def side(df: DataFrame, name: str) -> DataFrame:
        value = F.col(column).cast("string") if data_type == "categorical" else clean_double(F.col(column))
        return df.select(
            F.lit(model_id).alias("model_id"),
            F.lit(information_date).alias("information_date"),
            F.lit(var_type).alias("var_type"),
            F.lit(variable or column).alias("variable"),
            F.lit(name).alias("side"),
            value.alias("value"),
        )

    rows = side(current, CURRENT)
    return rows if baseline is None else rows.unionByName(side(baseline, BASELINE))


def unpivot(rows: DataFrame, variables: list[tuple[str, str, str]], numeric: bool) -> DataFrame:
    """Long observations from a source slice that already carries model, date and side.

    ``variables`` lists (source column, variable, var_type). A source has one role as a rule, so
    its variables are told apart by name; names used in two roles get a numbered label.
    """
    labels = [f"v{i}" for i in range(len(variables))]
    ids = ["model_id", "information_date", "side"]
    values = [
        (clean_double(F.col(f"`{column}`")) if numeric else F.col(f"`{column}`").cast("string")).alias(label)
        for label, (column, _, _) in zip(labels, variables)
    ]
    long = rows.select(*ids, *values).unpivot(ids, labels, "label", "value")

    def named(position: int) -> Column:
        texts = [v[position] for v in variables]
        out = F.lit(texts[-1])
        for label, text in list(zip(labels, texts))[:-1]:
            if text != texts[-1]:
                out = F.when(F.col("label") == label, text).otherwise(out)
        return out

    return long.select(
        "model_id", "information_date", named(2).alias("var_type"), named(1).alias("variable"), "side", "value"
    )


def is_counted(rows: DataFrame) -> bool:
    """Whether a frame holds values with their occurrences (``n_cur``, ``n_base``) in place of sides."""
    return "n_cur" in rows.columns and "side" not in rows.columns


def occurrences(rows: DataFrame) -> Column:
    """How many rows each row of a frame stands for, whatever its side."""
    return F.col("n_cur") + F.col("n_base") if is_counted(rows) else F.lit(1).cast("long")


def weighted(rows: DataFrame) -> DataFrame:
    """Add whole-number weights ``n_cur`` / ``n_base`` in place of the side."""
    if is_counted(rows):
        return rows
    return rows.withColumns(
        {"n_cur": is_current().cast("long"), "n_base": is_baseline().cast("long")}
    )


def sizes(rows: DataFrame) -> DataFrame:
    """KEYS with the rows of both sides."""
    return weighted(rows).groupBy(*KEYS).agg(F.sum("n_cur").alias("n_cur"), F.sum("n_base").alias("n_base"))


def with_cutoff(rows: DataFrame, cutoff: float | DataFrame) -> DataFrame:
    """Attach the approval cutoff: one number, or a (model_id, cutoff) frame."""
    if isinstance(cutoff, DataFrame):
        per_model = bounded(cutoff.select("model_id", F.col("cutoff").cast("double")))
        joined = rows.join(per_model, "model_id", "left")
        return joined.withColumn("cutoff", F.coalesce("cutoff", F.lit(0.5)))
    return rows.withColumn("cutoff", F.lit(float(cutoff)))


def value_counts(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Occurrences per value and side, counted before anything is shuffled. What is counted already stays as it is."""
    if is_counted(rows) and keys == KEYS:
        return rows.select(*keys, "value", "n_cur", "n_base")
    return rows.groupBy(*keys, "value").agg(
        F.count_if(is_current()).alias("n_cur"), F.count_if(is_baseline()).alias("n_base")
    )


def merged(counted: DataFrame) -> DataFrame:
    """Counted values with each value of a key in one row."""
    return counted.groupBy(*KEYS, "value").agg(F.sum("n_cur").alias("n_cur"), F.sum("n_base").alias("n_base"))


def side_counts(condition: Column | None = None) -> tuple[Column, Column]:
    if condition is None:
        return F.count_if(is_current()), F.count_if(is_baseline())
    return F.count_if(is_current() & condition), F.count_if(is_baseline() & condition)
