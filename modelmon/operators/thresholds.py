"""Which metrics run, which limits apply, and the light they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelmon.functions.columns import one_per_key
from modelmon.operators import registry

# Default limits (ambar, red); None = no limit at that level.
DEFAULT_THRESHOLDS = {
    "null_rate": (0.05, 0.10),
    "cardinality_ratio": (None, 0.95),
    "outlier_rate": (0.03, 0.06),
    "dominant_category_rate": (None, 0.90),
    "category_composition_drift": (0.10, 0.30),
    "median_shift": (0.10, 0.20),
    "population_variation": (0.15, 0.30),
    "completeness": (0.0001, 0.20),
    "psi_canonical": (0.10, 0.20),
    "psi_dynamic": (0.10, 0.20),
    "ks_vs_dev": (0.10, 0.20),
    "correlation_drift": (0.10, 0.20),
    "range_violation": (None, 1e-9),
    "entropy": (0.15, 0.30),
    "approval_rate": (0.10, 0.20),
    "tail_shift": (0.05, 0.10),
    "concentration_gini": (0.10, 0.20),
    "psi_approved": (0.10, 0.20),
    "psi_rejected": (0.10, 0.20),
    "auc": (None, None),
    "gini": (0.05, 0.10),
    "brier_score": (0.10, 0.20),
    "lift_top_decile": (0.10, 0.20),
    "calibration_slope": (0.10, 0.20),
    "ks_score_target": (0.05, 0.10),
    "event_rate": (0.20, 0.40),
    "psi_target": (0.05, 0.10),
}

# Metrics per variable type and data type ("*" = any data type).
METRIC_MATRIX = {
    ("raw,input,transformed,score,target", "*"): ["null_rate"],
    ("raw,input,transformed", "*"): ["cardinality_ratio", "population_variation", "completeness"],
    ("raw,input,transformed", "numeric"): ["outlier_rate", "psi_canonical", "psi_dynamic", "ks_vs_dev", "median_shift"],
    ("raw,input,transformed", "categorical"): [
        "dominant_category_rate", "category_composition_drift", "psi_canonical", "psi_dynamic",
    ],
    ("score", "*"): [
        "range_violation", "entropy", "approval_rate", "psi_canonical", "psi_dynamic", "tail_shift",
        "concentration_gini", "psi_approved", "psi_rejected", "population_variation",
    ],
    ("target", "*"): ["event_rate", "psi_target"],
}

# The lights, worst last.
NOT_APPLICABLE, GREEN, AMBAR, RED = "NOT_APPLICABLE", "GREEN", "AMBAR", "RED"

MANUAL_LIMITS = {
    "psi_canonical": ("psi_threshold_ambar", "psi_threshold_red"),
    "psi_target": ("psi_threshold_ambar", "psi_threshold_red"),
    "psi_dynamic": ("psi_variation_threshold_ambar", "psi_variation_threshold_red"),
}


def status_rule(value: Column, ambar: Column, red: Column) -> Column:
    """RED before AMBAR; a missing value counts as 0; no limit at all is NOT_APPLICABLE."""
    v = F.coalesce(value, F.lit(0.0))
    return (
        F.when(red.isNotNull() & (v >= red), RED)
        .when(ambar.isNotNull() & (v >= ambar), AMBAR)
        .when(ambar.isNotNull() | red.isNotNull(), GREEN)
        .otherwise(NOT_APPLICABLE)
    )


def default_thresholds(spark: SparkSession) -> DataFrame:
    rows = [(name, *limits) for name, limits in DEFAULT_THRESHOLDS.items()]
    return spark.createDataFrame(rows, "metric_name string, threshold_ambar double, threshold_red double")


def metric_matrix(spark: SparkSession) -> DataFrame:
    """One row per (var_type, data_type, metric_name) that runs."""
    kinds = ["numeric", "categorical", "binary"]
    rows = sorted(
        {
            (var_type, kind, name)
            for (var_types, data_type), names in METRIC_MATRIX.items()
            for var_type in var_types.split(",")
            for kind in (kinds if data_type == "*" else [data_type])
            for name in names
        }
    )
    return spark.createDataFrame(rows, "var_type string, data_type string, metric_name string")


def applicable_metrics(metadata: DataFrame) -> DataFrame:
    """Metadata rows with every metric that runs on them; unknown types get null_rate only."""
    matrix = metric_matrix(metadata.sparkSession)
    return metadata.join(matrix, ["var_type", "data_type"], "left").fillna("null_rate", ["metric_name"])


def resolve_thresholds(results: DataFrame, auto: DataFrame | None = None, manual: DataFrame | None = None) -> DataFrame:
    """Attach limits to metric rows: default, then trained, then manual PSI limits.

    ``auto`` and ``manual`` hold the latest rows per model. Metrics relative to a baseline
    lose their limits where no baseline was measured (their baseline value is null).
    """
    spark = results.sparkSession
    limits = results.join(
        default_thresholds(spark).withColumnsRenamed({"threshold_ambar": "_d_ambar", "threshold_red": "_d_red"}),
        "metric_name",
        "left",
    )
    ambar, red = [F.col("_d_ambar")], [F.col("_d_red")]
    if auto is not None:
        trained = auto.select(
            "model_id", "variable", "metric_name",
            F.col("threshold_ambar").cast("double").alias("_t_ambar"), F.col("threshold_red").cast("double").alias("_t_red"),
        )
        trained = one_per_key(trained, ["model_id", "variable", "metric_name"])
        limits = limits.join(trained, ["model_id", "variable", "metric_name"], "left")
        ambar.insert(0, F.col("_t_ambar"))
        red.insert(0, F.col("_t_red"))
    if manual is not None:
        names = sorted({c for pair in MANUAL_LIMITS.values() for c in pair})
        fixed = manual.select(
            "model_id", "variable", F.col("type").alias("var_type"),
            *[(F.col(c).cast("double") if c in manual.columns else F.lit(None).cast("double")).alias(c) for c in names],
        )
        fixed = one_per_key(fixed, ["model_id", "variable", "var_type"])
        limits = limits.join(fixed, ["model_id", "variable", "var_type"], "left")

        def chosen(level: int) -> Column:
            out = F.lit(None).cast("double")
            for metric, pair in MANUAL_LIMITS.items():
                out = F.when(F.col("metric_name") == metric, F.col(pair[level])).otherwise(out)
            return out

        ambar.insert(0, chosen(0))
        red.insert(0, chosen(1))
    relative = [m for m in registry.names() if registry.get(m).relative]
    dropped = F.col("metric_name").isin(relative) & F.col("baseline_value").isNull()
    return limits.select(
        *results.columns,
        F.when(~dropped, F.coalesce(*ambar)).alias("threshold_ambar"),
        F.when(~dropped, F.coalesce(*red)).alias("threshold_red"),
    )


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn(
        "status", status_rule(F.col("metric_value"), F.col("threshold_ambar"), F.col("threshold_red"))
    )
