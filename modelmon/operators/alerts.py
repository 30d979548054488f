"""Roll-ups of metric lights: alerts per variable type, digests, recipients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelmon.functions.columns import one_per_key
from modelmon.operators.thresholds import AMBAR, GREEN, RED

# The alert policy where no table gives one.
DEFAULT_POLICY = {
    "raw": (3, 0.60, 0.40),
    "input": (3, 0.50, 0.30),
    "transformed": (3, 0.50, 0.30),
    "score": (2, 0.30, 0.15),
    "target": (3, 0.50, 0.30),
    "conjugate": (2, 0.50, 0.30),
}
UNKNOWN_POLICY = (3, 0.50, 0.30)
PERFORMANCE = ["auc", "gini", "brier_score", "lift_top_decile"]
MISSING_DATA, SUCCESS = "MISSING_DATA", "SUCCESS"
RUN = ["model_id", "information_date"]


def default_policy(spark: SparkSession) -> DataFrame:
    rows = [(k, *v) for k, v in DEFAULT_POLICY.items()]
    return spark.createDataFrame(
        rows, "var_type string, red_equivalent int, alert_ambar_pct double, alert_red_pct double"
    )


def alert_aggregate(results: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """Stress per (model, date, variable type): (ambar + red * W) / (total * W).

    RED is tested before AMBAR, and every result counts in the total. ``policy`` is keyed by
    var_type, and by model_id where it has that column.
    """
    policy = default_policy(results.sparkSession) if policy is None else policy
    on = [c for c in ("model_id", "var_type") if c in policy.columns]
    limits = ["red_equivalent", "alert_ambar_pct", "alert_red_pct"]
    counted = results.groupBy(*RUN, "var_type").agg(
        F.count("*").cast("int").alias("total_metrics"),
        F.count_if(F.col("status") == AMBAR).cast("int").alias("count_ambar"),
        F.count_if(F.col("status") == RED).cast("int").alias("count_red"),
    )
    used = counted.join(one_per_key(policy.select(*on, *limits), on), on, "left").fillna(
        dict(zip(limits, UNKNOWN_POLICY))
    )
    weight = F.col("red_equivalent")
    equivalent = F.col("count_ambar") + F.col("count_red") * weight
    stress = equivalent / (F.col("total_metrics") * weight)
    return used.withColumns(
        {"equivalent_yellow": equivalent.cast("double"), "stress_ratio": stress.cast("double")}
    ).select(
        *RUN, "var_type", "total_metrics", "count_ambar", "count_red", "equivalent_yellow", "stress_ratio",
        F.when(F.col("stress_ratio") >= F.col("alert_red_pct"), RED)
        .when(F.col("stress_ratio") >= F.col("alert_ambar_pct"), AMBAR)
        .otherwise(GREEN)
        .alias("aggregate_status"),
        F.lit(False).alias("alert_sent"),
        F.lit(None).cast("string").alias("alert_type"),
        F.col("red_equivalent").alias("red_equivalent_used"),
        F.col("alert_ambar_pct").alias("alert_ambar_pct_used"),
        F.col("alert_red_pct").alias("alert_red_pct_used"),
    )


def worst(status: Column) -> Column:
    """Aggregate: the worst light of a group; GREEN where there is none."""
    severity = F.when(status == RED, 2).when(status == AMBAR, 1).otherwise(0)
    top = F.max(severity)
    return F.when(top == 2, RED).when(top == 1, AMBAR).otherwise(GREEN)


def overall_status(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(*RUN).agg(worst(F.col("aggregate_status")).alias("overall_status"))


def latest_run_status(log: DataFrame) -> DataFrame:
    """Status of the newest run per (model, date)."""
    return log.groupBy(*RUN).agg(F.max_by("status", F.struct("run_date", "status")).alias("run_status"))


def recipients(runs: DataFrame, contacts: DataFrame, red_list: DataFrame) -> DataFrame:
    """Who hears about each run. ``runs``: RUN + has_red, has_ambar, missing_data.

    To: newest contacts whose flag fits. Bcc: the active red list without To, when red or
    missing. With nobody in To, Bcc moves up. Contact lists per model are short by nature.
    """
    hit = (
        (F.col("missing_data") & F.col("notify_on_missing"))
        | (F.col("has_red") & F.col("notify_on_red"))
        | (F.col("has_ambar") & F.col("notify_on_ambar"))
    )
    to = (
        runs.join(contacts, "model_id")
        .where(hit)
        .groupBy(*RUN)
        .agg(F.sort_array(F.collect_set("contact_email")).alias("to_list"))
    )
    listed = red_list.where("is_active").agg(F.sort_array(F.collect_set("email")).alias("all_bcc"))
    empty = F.array().cast("array<string>")
    joined = runs.join(to, RUN, "left")
    to_list = F.coalesce("to_list", empty)
    bcc = F.when(
        F.col("has_red") | F.col("missing_data"), F.array_except(F.coalesce(listed.scalar(), empty), to_list)
    ).otherwise(empty)
    moved = F.size(to_list) == 0
    return joined.select(
        *RUN,
        F.concat_ws(", ", F.when(moved, bcc).otherwise(to_list)).alias("recipients_to"),
        F.concat_ws(", ", F.when(moved, empty).otherwise(bcc)).alias("recipients_bcc"),
    )


def digest_header(
    log: DataFrame, alerts: DataFrame, results: DataFrame, prefix: Column | str = "[MODELMON]"
) -> DataFrame:
    """One row per run to announce: SUCCESS runs with results, and MISSING_DATA runs."""
    latest = latest_run_status(log)
    measured = results.select(*RUN).distinct()
    succeeded = latest.where(F.col("run_status") == SUCCESS).join(measured, RUN, "left_semi")
    missing = latest.where(F.col("run_status") == MISSING_DATA)
    announced = succeeded.unionByName(missing).join(overall_status(alerts), RUN, "left")
    kind = F.when(F.col("run_status") == MISSING_DATA, MISSING_DATA).otherwise(F.coalesce("overall_status", F.lit(GREEN)))
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return announced.withColumn("alert_type", kind).select(
        *RUN,
        "alert_type",
        F.concat(
            F.concat_ws(" ", head, F.col("alert_type")), F.lit(" - "), F.col("model_id"), F.lit(" - "),
            F.col("information_date").cast("string"),
        ).alias("subject"),
    )


def digest_mail(header: DataFrame, addressed: DataFrame, execution_id: str = "") -> DataFrame:
    """Rows for ``email_log``: each announced run with its subject, type and recipients; runs without any get no row.

    ``header`` comes from ``digest_header``, ``addressed`` from ``recipients``. The id follows from run and execution, so a
    second attempt writes the same one.
    """
    found = header.join(addressed, RUN).where("recipients_to <> ''")
    email_id = F.sha2(F.concat_ws("|", F.lit(execution_id), "model_id", F.col("information_date").cast("string")), 256)
    return found.select(
        email_id.alias("email_id"), F.lit(execution_id).alias("execution_id"), "alert_type", "recipients_to", "recipients_bcc",
        "subject", F.lit("READY").alias("status"), F.lit(0).alias("retry_count"),
        F.col("information_date").cast("string").alias("information_date"), "model_id",
    )


def alert_digest(alerts: DataFrame, results: DataFrame) -> DataFrame:
    """Digest lines per run: type summary, red metrics, performance, target.

    One row per line (``section, item, metric_name, value, baseline, limit, status``): a digest
    of any length stays spread out.
    """
    types = alerts.select(
        *RUN, F.lit("types").alias("section"), F.col("var_type").alias("item"), F.lit("stress_ratio").alias("metric_name"),
        F.col("stress_ratio").alias("value"), F.lit(None).cast("double").alias("baseline_value"),
        F.lit(None).cast("double").alias("threshold_red"), F.col("aggregate_status").alias("status"),
    )
    section = F.array_compact(
        F.array(
            F.when(F.col("status") == RED, F.lit("red")),
            F.when(F.col("metric_name").isin(PERFORMANCE), F.lit("performance")),
            F.when(F.col("var_type") == "target", F.lit("target")),
        )
    )
    lines = results.select(
        *RUN, F.explode(section).alias("section"), F.col("variable").alias("item"), "metric_name",
        F.col("metric_value").alias("value"), "baseline_value", "threshold_red", "status",
    )
    return types.unionByName(lines)


def missing_days(log: DataFrame, today: Column) -> DataFrame:
    """MISSING_DATA rows per model over the last seven days."""
    recent = (F.col("information_date").cast("date") >= F.date_sub(today, 7)) & (F.col("status") == MISSING_DATA)
    return log.where(recent).groupBy("model_id").agg(F.count("*").alias("missing_days"))
