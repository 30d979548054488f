"""Score-shape metrics. Observations are those of score variables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from modelmon.functions.columns import BASELINE, CURRENT, KEYS, is_baseline, is_current, ratio
from modelmon.functions.ordering import ordered_cross
from modelmon.operators.observations import is_counted, sizes, weighted, with_cutoff
from modelmon.operators.registry import Metric, register, register_family
from modelmon.operators.stability import stored_psi

TOP_ENTROPY_BIN = 9


def _has_base(value):
    return F.when(F.col("n_base") > 0, value)


def entropy(rows: DataFrame) -> DataFrame:
    """Entropy of ten score bands per side. A missing score falls in the top band."""
    band = F.least(F.floor(F.col("value") * 10), F.lit(TOP_ENTROPY_BIN).cast("long"))
    per_band = weighted(rows).groupBy(*KEYS, band.alias("band")).agg(F.sum("n_cur").alias("c"), F.sum("n_base").alias("b"))
    totals = per_band.groupBy(*KEYS).agg(F.sum("c").alias("n_cur"), F.sum("b").alias("n_base"))

    def term(count: str, total: str):
        p = F.col(count) / F.col(total)
        return F.sum(F.when(F.col(count) > 0, -p * F.ln(p)).otherwise(0.0))

    return (
        per_band.join(totals, KEYS)
        .groupBy(*KEYS)
        .agg(
            F.first("n_cur").alias("n_cur"),
            F.first("n_base").alias("n_base"),
            term("c", "n_cur").alias("entropy_cur"),
            term("b", "n_base").alias("entropy_base"),
        )
    )


def concentration(rows: DataFrame) -> DataFrame:
    """Concentration index of the score per side: 2*sum(rank*s)/(n*sum(s)) - (n+1)/n.

    Missing scores take the lowest ranks, as in an ascending sort.
    """
    if is_counted(rows):
        sides = [F.struct(F.lit(s).alias("side"), F.col(c).cast("double").alias("one")) for s, c in ((CURRENT, "n_cur"), (BASELINE, "n_base"))]
        weights = rows.select(*KEYS, "value", F.explode(F.array(*sides)).alias("s")).select(*KEYS, "value", "s.*").where("one > 0")
    else:
        weights = rows.withColumn("one", F.lit(1.0))
    weights = weights.withColumn("mass", F.coalesce(F.col("value"), F.lit(0.0)) * F.col("one"))
    missing = F.sum(F.when(F.col("value").isNull(), F.col("one")).otherwise(0.0))
    sized = weights.groupBy(*KEYS, "side").agg(F.sum("one").alias("n"), missing.alias("nulls"))
    ranked = ordered_cross(weights, [*KEYS, "side"], "value", "one", "mass")
    n, mass = F.col("n"), F.col("total_right")
    rank_sum = F.col("cross") + mass / 2 + F.col("nulls") * mass
    index = (
        F.when(mass.isNull() | (mass == 0) | (n < 2), 0.0)
        .otherwise(F.try_divide(2.0 * rank_sum, n * mass) - (n + 1.0) / n)
    )
    return (
        sized.join(ranked, [*KEYS, "side"], "left")
        .withColumn("index", index)
        .groupBy(*KEYS)
        .agg(
            F.sum(F.when(is_current(), n).otherwise(0.0)).alias("n_cur"),
            F.sum(F.when(is_baseline(), n).otherwise(0.0)).alias("n_base"),
            F.max(F.when(is_current(), F.col("index"))).alias("index_cur"),
            F.max(F.when(is_baseline(), F.col("index"))).alias("index_base"),
        )
    )


def split_at_cutoff(rows: DataFrame, cutoff: float | DataFrame = 0.5) -> tuple[DataFrame, DataFrame]:
    """(approved, rejected): score above the cutoff, score at or below it."""
    flagged = with_cutoff(rows, cutoff)
    approved = flagged.where(F.col("value") > F.col("cutoff")).drop("cutoff")
    rejected = flagged.where(F.col("value") <= F.col("cutoff")).drop("cutoff")
    return approved, rejected


def split_psi(
    rows: DataFrame, bins: DataFrame, cutoff: float | DataFrame = 0.5, expected: str = "dev"
) -> DataFrame:
    """PSI of the approved and the rejected part, in one pass over the bins.

    The part becomes a suffix of the variable while bins are counted. Variables without
    stored bins give no row.
    """
    part = F.when(F.col("value") > F.col("cutoff"), "approved").when(F.col("value") <= F.col("cutoff"), "rejected")
    parts = F.array(F.lit("approved"), F.lit("rejected"))
    tagged = (
        with_cutoff(rows, cutoff)
        .withColumn("part", part)
        .where(F.col("part").isNotNull())
        .withColumn("variable", F.concat_ws("\x1f", "variable", "part"))
        .drop("part", "cutoff")
    )
    split_bins = bins.withColumn("part", F.explode(parts)).withColumn(
        "variable", F.concat_ws("\x1f", "variable", "part")
    ).drop("part")
    found = stored_psi(tagged, split_bins, True, expected)
    named = found.withColumns(
        {"part": F.element_at(F.split("variable", "\x1f"), -1), "variable": F.split("variable", "\x1f")[0]}
    )
    per_part = named.groupBy(*KEYS).agg(
        F.max(F.when(F.col("part") == "approved", F.col("psi"))).alias("psi_approved"),
        F.max(F.when(F.col("part") == "rejected", F.col("psi"))).alias("psi_rejected"),
    )
    owner = ["model_id", "var_type", "variable"]
    return sizes(rows).join(bins.select(*owner).distinct(), owner, "left_semi").join(per_part, KEYS, "left")


register_family("entropy", entropy)
register_family("concentration", concentration)
register_family("split_psi", split_psi)

RANGE_VIOLATION = register(Metric(
    "range_violation", "counts", lambda: ratio(F.col("outside_cur"), F.col("n_cur"))
))
ENTROPY = register(Metric(
    "entropy", "entropy",
    lambda: F.when(F.col("n_base") == 0, F.col("entropy_cur"))
    .when(F.col("entropy_base") != 0, F.try_divide(F.abs(F.col("entropy_cur") - F.col("entropy_base")), "entropy_base"))
    .otherwise(0.0),
    lambda: _has_base(F.col("entropy_base")),
    relative=True,
))


def _approval(side: str):
    return ratio(F.col(f"approved_{side}"), F.col(f"n_{side}"))


APPROVAL_RATE = register(Metric(
    "approval_rate", "counts",
    lambda: F.when(F.col("n_base") == 0, _approval("cur"))
    .when(_approval("base") != 0, F.try_divide(F.abs(_approval("cur") - _approval("base")), _approval("base")))
    .when(_approval("cur") > 0, 1.0)
    .otherwise(0.0),
    lambda: _has_base(_approval("base")),
    relative=True,
))
TAIL_SHIFT = register(Metric(
    "tail_shift", "quantiles",
    lambda: F.abs(F.col("cur_p10") - F.col("base_p10")) + F.abs(F.col("cur_p90") - F.col("base_p90")),
    lambda: F.lit(0.0),
    needs_baseline=True,
))
CONCENTRATION_GINI = register(Metric(
    "concentration_gini", "concentration",
    lambda: F.when(
        (F.col("n_base") > 0) & (F.col("index_base") != 0),
        F.try_divide(F.abs(F.col("index_cur") - F.col("index_base")), F.abs("index_base")),
    ).otherwise(F.abs("index_cur")),
    lambda: _has_base(F.col("index_base")),
    needs_baseline=True,
    relative=True,
))
PSI_APPROVED = register(Metric(
    "psi_approved", "split_psi", lambda: F.col("psi_approved"), lambda: F.lit(0.0), needs_baseline=True
))
PSI_REJECTED = register(Metric(
    "psi_rejected", "split_psi", lambda: F.col("psi_rejected"), lambda: F.lit(0.0), needs_baseline=True
))
