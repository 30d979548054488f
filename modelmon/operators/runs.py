"""Which runs are due, what was logged, and checks on what was written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.operators.calendar import expected_information_date, is_business_day

SUCCESS = "SUCCESS"
NEW_MODEL = "NEW_MODEL"


def successful_runs(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == SUCCESS).select(
        "model_id", F.col("information_date").cast("string").alias("information_date")
    ).distinct()


def successful_run_exists(runs: DataFrame, log: DataFrame) -> DataFrame:
    done = successful_runs(log).withColumn("_done", F.lit(True))
    return runs.join(done, ["model_id", "information_date"], "left").withColumn(
        "run_exists", F.coalesce("_done", F.lit(False))
    ).drop("_done")


def due_runs(models: DataFrame, calendar: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Runs due on each (model, date) row: adds ``information_date`` (ISO text).

    ``business_daily`` waits for business days; weekly and monthly models run only on their
    expected date; finished runs (``log``) drop out.
    """
    expected = expected_information_date(is_business_day(models, calendar), calendar)
    frequency = F.col("frequency")
    due = expected.where(
        ~((frequency == "business_daily") & ~F.col("is_business_day"))
        & ~(frequency.isin("weekly", "monthly") & (F.col("expected_date") != F.col("date")))
    ).withColumn("information_date", F.date_format("expected_date", "yyyy-MM-dd"))
    due = due.drop("expected_date", "is_business_day")
    return due if log is None else due.join(successful_runs(log), ["model_id", "information_date"], "left_anti")


def candidate_dates(models: DataFrame, calendar: DataFrame, first: Column, last: Column, log: DataFrame | None = None) -> DataFrame:
    """Backfill: every run a model would have had in [first, last], less the finished ones."""
    days = models.withColumn("date", F.explode(F.sequence(first, last)))
    return due_runs(days, calendar, log).select("model_id", "information_date").distinct()


def execution_log(
    results: DataFrame, missing: DataFrame, execution_id: str, job: str, reason: str = "SCHEDULED", failed: DataFrame | None = None
) -> DataFrame:
    """One log row per run: SUCCESS from its results, MISSING_DATA from ``missing``, FAILED from ``failed``.

    ``missing``: model_id, information_date, error_message, variables_missing; ``failed`` the same without the last. A
    metric without a value counts as failed. A run that failed has no other row.
    """
    run = ["model_id", "information_date"]
    done = results.groupBy(*run).agg(
        F.count_distinct("variable").cast("int").alias("variables_expected"),
        F.count("*").cast("int").alias("metrics_calculated"),
        F.count_if(F.col("metric_value").isNull()).cast("int").alias("metrics_failed"),
    ).select(
        *run, F.lit(SUCCESS).alias("status"), F.lit("").alias("error_message"), "variables_expected",
        F.col("variables_expected").alias("variables_processed"), F.lit(0).alias("variables_missing"),
        "metrics_calculated", "metrics_failed",
    )
    zero = F.lit(0)
    absent = missing.select(
        *run, F.lit("MISSING_DATA").alias("status"), "error_message", zero.alias("variables_expected"),
        zero.alias("variables_processed"), F.col("variables_missing").cast("int").alias("variables_missing"),
        zero.alias("metrics_calculated"), zero.alias("metrics_failed"),
    )
    rows = done.unionByName(absent)
    if failed is not None:
        broken = failed.groupBy(*run).agg(F.concat_ws("; ", F.sort_array(F.collect_set("error_message"))).alias("error_message"))
        broken = broken.withColumns({"status": F.lit("FAILED"), **{c: zero for c in rows.columns if c not in (*run, "status", "error_message")}})
        rows = rows.join(broken.select(*run), run, "left_anti").unionByName(broken)
    return rows.withColumns(
        {
            "execution_id": F.lit(execution_id), "dag_id": F.lit(job), "airflow_run_id": F.lit(execution_id),
            "reason": F.lit(reason),
        }
    )


def output_validation(dates: DataFrame, results: DataFrame, alerts: DataFrame) -> DataFrame:
    """Rows written per date; ``valid`` needs metric and alert rows."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("information_date").agg(F.count("*").alias(name))

    joined = dates.join(counted(results, "metric_rows"), "information_date", "left").join(
        counted(alerts, "alert_rows"), "information_date", "left"
    ).fillna(0, ["metric_rows", "alert_rows"])
    return joined.withColumn("valid", (F.col("metric_rows") > 0) & (F.col("alert_rows") > 0))


def new_models(latest: DataFrame, changelog: DataFrame) -> DataFrame:
    """Models of the newest configuration that the change log does not know."""
    return latest.join(changelog.select("model_id").distinct(), "model_id", "left_anti")


def config_changes(latest: DataFrame, changelog: DataFrame, table_name: str, process_date: Column, job: str, run_id: str) -> DataFrame:
    """NEW_MODEL change rows, one per unknown model."""
    empty = F.lit("")
    return new_models(latest, changelog).select(F.col("model_id").cast("string").alias("model_id")).distinct().select(
        F.current_timestamp().alias("change_timestamp"), F.lit(table_name).alias("table_name"),
        F.lit(NEW_MODEL).alias("change_type"), empty.alias("field_changed"), empty.alias("old_value"),
        empty.alias("new_value"), F.lit(True).alias("triggered_retraining"), empty.alias("error_message"),
        F.lit(job).alias("executed_by_dag_id"), F.lit(run_id).alias("run_id"),
        process_date.cast("string").alias("process_date"), "model_id",
    )


def retraining_list(changelog: DataFrame, process_date: Column | None = None) -> DataFrame:
    chosen = changelog.where((F.col("change_type") == NEW_MODEL) & F.col("triggered_retraining"))
    if process_date is not None:
        chosen = chosen.where(F.col("process_date") == process_date)
    return chosen.select("process_date", "model_id").distinct()


def untrained_models(changelog: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Models marked for training on a date that have no threshold row of that date."""
    return retraining_list(changelog).join(
        thresholds.select("process_date", "model_id").distinct(), ["process_date", "model_id"], "left_anti"
    )
