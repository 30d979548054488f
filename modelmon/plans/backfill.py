"""Backfill: all missed dates of a model's history in one multi-date run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from modelmon.operators.runs import candidate_dates
from modelmon.plans.feeds import ConfigTables
from modelmon.plans.monitor import run_models
from modelmon.sources.config import latest_partition


def date_window(last: str, amount: int, unit: str = "days"):
    """First and last day of ``amount`` days, weeks or months back from ``last``."""
    if amount <= 0:
        raise ValueError("amount must be a positive whole number")
    end = F.lit(last).cast("date")
    if unit == "months":
        return F.add_months(end, -amount), end
    return F.date_sub(end, amount * (7 if unit == "weeks" else 1)), end


def backfill(
    spark: SparkSession,
    config: ConfigTables,
    models: list[str],
    window: tuple,
    out_dir: str,
    execution_id: str,
    log: DataFrame | None = None,
    force: bool = False,
    **options,
) -> DataFrame:
    """Run every candidate date without a SUCCESS run (or all of them with ``force``).

    Returns the dates that were run.
    """
    summary = latest_partition(config.model_summary).where(F.col("model_id").isin(models))
    for name, dtype in (("execution_monthly_day", "int"), ("execution_weekday", "int"), ("frequency", "string")):
        if name not in summary.columns:
            summary = summary.withColumn(name, F.lit(None).cast(dtype))
    summary = summary.select("model_id", F.coalesce("frequency", F.lit("daily")).alias("frequency"), "execution_monthly_day", "execution_weekday")
    dates = candidate_dates(summary, config.calendar, *window, None if force else log)
    if not dates.isEmpty():
        run_models(spark, config, dates, out_dir, execution_id, "manual_backfill", "BACKFILL", models, **options)
    return dates
