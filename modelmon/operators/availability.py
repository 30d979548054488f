"""Freshness control of every configured source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.sizes import dealt

# The stored control texts (spelling included).
UPDATED = "Latest Data Updated"
IN_PROGRESS = "Data ingestion in progress"
LATE = "Data Ingestation has not met the deadline"
NO_DATA = "Not enough data to process the models"


def newest_dates(dates: DataFrame) -> DataFrame:
    """Newest date per source from (source_table, date)."""
    return dates.groupBy("source_table").agg(F.max("date").alias("max_date"))


def data_availability(configured: DataFrame, newest: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Control per (model, date, schema, table).

    ``configured``: model_id, information_date (date), source_schema, source_table,
    deadline_days. ``newest``: source_table, max_date. The deadline counts from the month start.
    Rows are dealt over all tasks before they are grouped: nearly each is a group of its own, which a task would hold.
    """
    as_of = F.current_date() if as_of is None else as_of
    vintage = F.trunc("information_date", "month")
    deadline = F.date_add(vintage, F.coalesce(F.col("deadline_days"), F.lit(0)))
    sources = ["model_id", "information_date", "source_schema", "source_table"]
    unique = dealt(configured, *sources).groupBy(*sources).agg(F.first("deadline_days").alias("deadline_days"))
    newest_date = F.col("max_date")
    control = (
        F.when(newest_date >= F.col("information_date"), UPDATED)
        .when(as_of <= deadline, IN_PROGRESS)
        .when(newest_date.isNotNull(), LATE)
        .otherwise(NO_DATA)
    )
    iso = F.date_format("information_date", "yyyy-MM-dd")
    return unique.join(newest, "source_table", "left").select(
        "model_id",
        iso.alias("information_date"),
        F.coalesce("source_schema", F.lit("")).alias("schema_name"),
        "source_table",
        iso.alias("scoring_date"),
        F.date_format(deadline, "yyyy-MM-dd").alias("deadline_data_ingestion"),
        F.date_format(vintage, "yyyy-MM-dd").alias("vintage"),
        iso.alias("update_data_required"),
        control.alias("control"),
    )


def availability_done(availability: DataFrame) -> DataFrame:
    """Per (model, date): every source is up to date. No source at all gives no row."""
    return availability.groupBy("model_id", "information_date").agg(
        F.bool_and(F.col("control") == UPDATED).alias("done")
    )
