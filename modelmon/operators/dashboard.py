"""Views and queries over the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RUN = ["model_id", "information_date"]

# Metrics of the official controls, status words, and check names.
CANONICAL_METRICS = [
    "median_shift", "population_variation", "completeness", "psi_canonical", "psi_dynamic",
    "event_rate", "psi_target", "approval_rate",
]
SEVERITY = {"GREEN": "PASS", "AMBAR": "WARNING", "RED": "FAIL"}
CHECKS = {
    "median_shift": "Median Shift (Population Growth check)",
    "population_variation": "Population Growth (Raw Sources)",
    "completeness": "Completeness (Observation windows availability)",
}
DECILES = ["p10", "p20", "p30", "p40", "p50", "p60", "p70", "p80", "p90"]


def _map(column: Column, words: dict[str, str], default: Column) -> Column:
    out = default
    for key, word in words.items():
        out = F.when(column == key, word).otherwise(out)
    return out


def severity(status: Column) -> Column:
    return _map(F.upper(status), SEVERITY, status)


def semaphore_view(results: DataFrame, alerts: DataFrame, log: DataFrame, match_var_type: bool = False) -> DataFrame:
    """Metric lights with the alert and run they belong to.

    By default alerts meet every metric of the run, so a row repeats per variable type and
    per log row; ``match_var_type`` keeps one alert per metric.
    """
    on = [*RUN, "var_type"] if match_var_type else RUN
    a = alerts.select(*on, "aggregate_status", "stress_ratio")
    e = log.select(*RUN, F.col("status").alias("execution_status"), "variables_missing")
    return results.join(a, on, "left").join(e, RUN, "left").select(
        "information_date", "model_id", "var_type", "metric_name", "metric_value", "status",
        "aggregate_status", "stress_ratio", "execution_status", "variables_missing",
    )


def model_summary_view(alerts: DataFrame, log: DataFrame) -> DataFrame:
    """One row per run: the light of every variable type side by side."""
    joined = alerts.join(log.select(*RUN, F.col("status").alias("execution_status")), RUN, "left")

    def light(var_type: str, name: str) -> Column:
        return F.max(F.when(F.col("var_type") == var_type, F.col("aggregate_status"))).alias(name)

    return joined.groupBy("information_date", "model_id").agg(
        light("score", "score_status"), light("input", "input_status"), light("raw", "raw_status"),
        light("transformed", "transformed_status"), light("SYSTEM", "system_status"),
        F.max(F.when(F.col("execution_status") == "MISSING_DATA", 1).otherwise(0)).alias("has_missing_data"),
        F.count_distinct("var_type").alias("var_types_evaluated"),
    )


def create_views(spark: SparkSession, results: str, alerts: str, log: str, semaphore: str, summary: str) -> None:
    """Register both views over the named tables."""
    tables = spark.table(results), spark.table(alerts), spark.table(log)
    semaphore_view(*tables).createOrReplaceTempView(semaphore)
    model_summary_view(tables[1], tables[2]).createOrReplaceTempView(summary)


def param_filter(
    df: DataFrame,
    model_id: str | None = None,
    start: str | None = None,
    end: str | None = None,
    within: dict[str, list[str] | None] | None = None,
) -> DataFrame:
    """Optional model, date bounds and IN lists; what is not given does not filter."""
    if model_id:
        df = df.where(F.col("model_id") == model_id)
    if start:
        df = df.where(F.col("information_date") >= str(start)[:10])
    if end:
        df = df.where(F.col("information_date") <= str(end)[:10])
    for column, values in (within or {}).items():
        if values:
            df = df.where(F.col(column).isin(values))
    return df


def models(summary: DataFrame) -> DataFrame:
    return summary.select("model_id").distinct().orderBy("model_id")


def date_range(summary: DataFrame, model_id: str | None = None) -> DataFrame:
    return param_filter(summary, model_id).agg(
        F.min("information_date").alias("min_date"), F.max("information_date").alias("max_date")
    )


def by_date(df: DataFrame, **filters) -> DataFrame:
    return param_filter(df, **filters).orderBy("information_date")


def by_model(df: DataFrame, *more: str, **filters) -> DataFrame:
    return param_filter(df, **filters).orderBy("model_id", "information_date", *more)


def metric_rows(results: DataFrame, var_types: list[str] | None = None, metrics: list[str] | None = None, **filters) -> DataFrame:
    return by_date(results, within={"var_type": var_types, "metric_name": metrics}, **filters)


def statistic_rows(summaries: DataFrame, var_types: list[str] | None = None, statistics: list[str] | None = None, **filters) -> DataFrame:
    return by_date(summaries, within={"var_type": var_types, "statistic": statistics}, **filters)


def latest(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows of the newest date, per model unless other keys are given ([] = over the whole table)."""
    keys = ["model_id"] if keys is None else keys
    newest = df.groupBy(*keys).agg(F.max("information_date").alias("information_date"))
    return df.join(newest, [*keys, "information_date"], "left_semi")


def semaphore_pivot(results: DataFrame, metrics: list[str]) -> DataFrame:
    """Newest lights, one column per metric. The metric list is given, so no extra pass finds it."""
    return latest(results).groupBy("model_id", "var_type", "variable").pivot("metric_name", metrics).agg(F.min("status"))


def stat_pivot(summaries: DataFrame, statistics: list[str]) -> DataFrame:
    return (
        latest(summaries).groupBy("model_id", "var_type", "variable").pivot("statistic", statistics)
        .agg(F.min("statistic_value"))
    )


def status_trend(results: DataFrame) -> DataFrame:
    return results.groupBy("model_id", "information_date", severity(F.col("status")).alias("severity")).agg(
        F.count("*").alias("count")
    )


def noncanonical_metrics(results: DataFrame) -> DataFrame:
    return results.where(~F.col("metric_name").isin(CANONICAL_METRICS))


def prescoring(results: DataFrame) -> DataFrame:
    rows = param_filter(results, within={"var_type": ["raw", "input"], "metric_name": list(CHECKS)})
    return rows.withColumns(
        {
            "check": _map(F.col("metric_name"), CHECKS, F.lit(None).cast("string")),
            "result": severity(F.col("status")),
        }
    )


def prescoring_counts(results: DataFrame) -> DataFrame:
    return prescoring(results).groupBy("model_id", "check", "result").agg(F.count("*").alias("count"))


def prescoring_latest(results: DataFrame) -> DataFrame:
    return latest(prescoring(results)).select(
        "model_id", "variable", "check", "metric_value", "baseline_value", "result"
    )


def availability_latest(availability: DataFrame) -> DataFrame:
    return latest(availability).select(
        "model_id", "schema_name", "source_table", "scoring_date", "deadline_data_ingestion", "vintage",
        "update_data_required", "control",
    )


def conjugate_latest(results: DataFrame) -> DataFrame:
    return latest(param_filter(results, within={"var_type": ["conjugate"]})).select(
        "model_id", "metric_name", "metric_value", "baseline_value", "threshold_ambar", "threshold_red", "status"
    )


def median_history(summaries: DataFrame) -> DataFrame:
    return statistic_rows(summaries, ["raw", "input"], ["p50"])


def percentile_latest(summaries: DataFrame) -> DataFrame:
    return latest(statistic_rows(summaries, ["raw", "input"], [*DECILES, "min", "max", "mean"]))


def raw_source_trend(results: DataFrame) -> DataFrame:
    return metric_rows(results, ["raw", "input"], ["population_variation", "completeness", "null_rate"])


def score_trend(results: DataFrame) -> DataFrame:
    return metric_rows(
        results, ["score"],
        ["entropy", "approval_rate", "concentration_gini", "population_variation", "range_violation"],
    )


def csi_series(results: DataFrame) -> DataFrame:
    return metric_rows(results, ["raw", "input"], ["psi_canonical"])


def psi_series(results: DataFrame) -> DataFrame:
    return metric_rows(results, ["score"], ["psi_canonical", "psi_dynamic"])
