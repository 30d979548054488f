"""Development artefacts measured on training observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from modelmon.functions.columns import KEYS, one_per_key, ratio
from modelmon.operators.observations import occurrences
from modelmon.operators.quality import outliers
from modelmon.operators.score import entropy

# Trained limits per metric, and policy defaults.
TRAINED_LIMITS = {
    "null_rate": (0.05, 0.10),
    "outlier_rate": (0.03, 0.06),
    "psi_canonical": (0.10, 0.20),
    "psi_dynamic": (0.10, 0.20),
    "entropy": (0.15, 0.30),
}
POLICY_TOP_N, POLICY_TOP_K = 50, 5


def auto_thresholds(rows: DataFrame, quartiles: DataFrame | None = None, numeric_types: DataFrame | None = None) -> DataFrame:
    """Trained limits with the value measured in development.

    ``rows`` are observations with side ``current``, or their counted values. With ``quartiles`` (KEYS + q1, q3) numeric
    variables get outlier_rate; score variables get entropy.
    """
    one = occurrences(rows)
    base = rows.groupBy(*KEYS).agg(
        F.sum(one).alias("n"), F.sum(F.when(F.col("value").isNull(), one).otherwise(0)).alias("nulls")
    )
    if quartiles is not None:
        wild = outliers(rows, quartiles).select(*KEYS, ratio(F.col("outliers_cur"), F.col("n_cur")).alias("outlier"))
        bands = entropy(rows.where(F.col("var_type") == "score")).select(*KEYS, "entropy_cur")
        base = base.join(wild, KEYS, "left").join(bands, KEYS, "left")
    else:
        base = base.withColumns({"outlier": F.lit(None).cast("double"), "entropy_cur": F.lit(None).cast("double")})
    measured = {
        "null_rate": ratio(F.col("nulls"), F.col("n")),
        "outlier_rate": F.col("outlier"),
        "psi_canonical": F.lit(0.0),
        "psi_dynamic": F.lit(0.0),
        "entropy": F.when(F.col("var_type") == "score", F.coalesce("entropy_cur", F.lit(0.0))),
    }
    if numeric_types is not None:
        base = base.join(numeric_types.withColumn("_numeric", F.lit(True)), ["model_id", "variable", "var_type"], "left")
        measured["outlier_rate"] = F.when(F.col("_numeric"), F.col("outlier"))
    entries = [
        F.when(
            value.isNotNull(),
            F.struct(
                F.lit(name).alias("metric_name"),
                F.lit(TRAINED_LIMITS[name][0]).alias("threshold_ambar"),
                F.lit(TRAINED_LIMITS[name][1]).alias("threshold_red"),
                value.cast("double").alias("baseline_value"),
            ),
        )
        for name, value in measured.items()
    ]
    return base.select(*KEYS, "n", F.explode(F.array_compact(F.array(*entries))).alias("t")).select(
        *KEYS, "t.*", F.lit(0.0).alias("baseline_std"), F.col("n").alias("sample_size_dev"),
        F.lit("auto").alias("calculation_method"),
    )


def with_policy(ranks: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """Category ranks with the policy of their variable (defaults 50 and 5)."""
    if policy is None:
        ranks = ranks.withColumns({c: F.lit(None).cast("int") for c in ("top_n_threshold", "critical_top_k")})
    else:
        fixed = one_per_key(policy.select("model_id", "variable", "top_n_threshold", "critical_top_k"), ["model_id", "variable"])
        ranks = ranks.join(fixed, ["model_id", "variable"], "left")
    return ranks.fillna({"top_n_threshold": POLICY_TOP_N, "critical_top_k": POLICY_TOP_K})

