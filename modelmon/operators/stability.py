"""Distribution-stability metrics and the shared quantile pass."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.columns import KEYS, first_rank_key, is_baseline, is_current, union_all
from modelmon.functions.ordering import Grid, cut_points, top_per_group
from modelmon.operators.bins import bin_counts, psi, psi_term
from modelmon.operators.observations import sizes, value_counts, weighted
from modelmon.operators.registry import Metric, register, register_family

DYNAMIC_BINS = 10
KS_STEPS = 20
KS_FLOOR = 1e-9
CORRELATION_FLOOR = 1e-9
PAIRS_PER_PASS = 200
PERCENTILES = [10, 20, 30, 40, 50, 60, 70, 80, 90]

_RANKS = {"cur": ["n_cur"], "base": ["n_base"], "pool": ["n_cur", "n_base"]}


def ks_gap(upto: list[str], sizes: list[str]) -> Column:
    """Gap between two empirical distributions at one pooled quantile point."""
    share = [F.col(u) / F.greatest(F.col(n), F.lit(1)) for u, n in zip(upto, sizes)]
    return F.abs(share[0] - share[1])


def quantiles(rows: DataFrame, n_bins: int = DYNAMIC_BINS) -> DataFrame:
    """Every quantile-based measure of numeric variables from one pass of order statistics.

    Percentiles of both sides, the 21 pooled points of the KS distance and the baseline bins of
    the dynamic PSI all share the same bucket counts.
    """
    fine = KS_STEPS if KS_STEPS % n_bins == 0 else KS_STEPS * n_bins
    grids = [Grid("cur", KS_STEPS), Grid("base", fine), Grid("pool", KS_STEPS)]
    cuts = cut_points(weighted(rows), KEYS, "value", ["n_cur", "n_base"], _RANKS, grids)

    def percentile(by: str, percent: int) -> Column:
        step = percent * (fine if by == "base" else KS_STEPS) // 100
        return F.max(F.when((F.col("by") == by) & (F.col("step") == step), F.col("cut"))).alias(f"{by}_p{percent}")

    every = fine // n_bins
    edge = (F.col("by") == "base") & (F.col("step") > 0) & (F.col("step") < fine) & (F.col("step") % every == 0)
    running = F.struct(F.col("step"), F.col("upto_n_cur").alias("c"), F.col("upto_n_base").alias("b"))
    measured = sizes(rows).join(cuts, KEYS, "left").groupBy(*KEYS).agg(
        F.first("n_cur").alias("n_cur"),
        F.first("n_base").alias("n_base"),
        F.max("total_n_cur").alias("valid_cur"),
        F.max("total_n_base").alias("valid_base"),
        F.greatest(
            F.lit(KS_FLOOR),
            F.max(F.when(F.col("by") == "pool", ks_gap(["upto_n_cur", "upto_n_base"], ["n_cur", "n_base"]))),
        ).alias("ks"),
        F.sort_array(F.collect_list(F.when(edge, running))).alias("edges"),
        *[percentile("cur", p) for p in [*PERCENTILES, 25, 75]],
        *[percentile("base", p) for p in (10, 50, 90)],
    )

    def term(upper: Column, lower: Column) -> Column:
        return psi_term(
            (upper["c"] - lower["c"]) / F.greatest(F.col("valid_cur"), F.lit(1)),
            (upper["b"] - lower["b"]) / F.greatest(F.col("valid_base"), F.lit(1)),
        )

    def end(step: int, c: Column, b: Column) -> Column:
        return F.struct(*[v.cast("long").alias(n) for n, v in (("step", F.lit(step)), ("c", c), ("b", b))])

    ends = F.concat(
        F.array(end(0, F.lit(0), F.lit(0))), F.col("edges"), F.array(end(fine, F.col("valid_cur"), F.col("valid_base")))
    )
    terms = F.zip_with(F.slice("ends", 2, n_bins), F.slice("ends", 1, n_bins), term)
    psi_value = F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
    return measured.withColumn("ends", ends).withColumn(
        "psi_dynamic", F.when(F.col("valid_base") > 0, psi_value).otherwise(0.0)
    ).drop("ends", "edges")


def quartiles(measured: DataFrame) -> DataFrame:
    return measured.select(*KEYS, F.col("cur_p25").alias("q1"), F.col("cur_p75").alias("q3"))


def dynamic_categories(rows: DataFrame, n_bins: int = DYNAMIC_BINS) -> DataFrame:
    """PSI over the most frequent baseline categories.

    A missing category takes its place among the bins, but no current row ever falls in it.
    """
    per_value = value_counts(rows)
    order = [first_rank_key(F.col("n_base"), F.col("value"))]
    top = top_per_group(per_value.where(F.col("n_base") > 0), KEYS, order, n_bins)
    binned = top.withColumn("n_cur", F.when(F.col("value").isNull(), 0).otherwise(F.col("n_cur")))
    return sizes(per_value).join(psi(binned, "n_cur", "n_base", name="psi_dynamic"), KEYS, "left")


def stored_psi(rows: DataFrame, bins: DataFrame, numeric: bool = True, expected: str = "dev") -> DataFrame:
    """PSI of the current side on stored bins.

    Expected shares come from ``count_dev`` where the bin has it, otherwise from the baseline
    rows; ``expected="baseline"`` always takes the baseline rows.
    """
    binned = bin_counts(rows, bins, numeric)
    base = F.col("n_base")
    binned = binned.withColumn("n_exp", F.coalesce(F.col("count_dev"), base) if expected == "dev" else base)
    return sizes(rows).join(psi(binned, "n_cur", "n_exp"), KEYS)


def canonical_psi(rows: DataFrame, bins: DataFrame | None, dynamic: DataFrame, numeric: bool = True) -> DataFrame:
    """PSI on stored bins, or on baseline bins (``dynamic``) for variables without any; without both it is 0."""
    own = dynamic.select(
        *KEYS, "n_base", F.when(F.col("n_base") > 0, F.coalesce("psi_dynamic", F.lit(0.0))).otherwise(0.0).alias("psi_canonical")
    )
    if bins is None:
        return own
    stored = stored_psi(rows, bins, numeric).select(*KEYS, "n_base", F.col("psi").alias("psi_canonical"))
    owner = ["model_id", "var_type", "variable"]
    return stored.unionByName(own.join(bins.select(*owner).distinct(), owner, "left_anti"))


def _correlation(a: str, b: str) -> Column:
    """Pearson correlation; null (not an error) where a column is constant."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation(
    wide: DataFrame, columns: list[str], keys: list[str] = KEYS, own: dict[str, list[str]] | None = None
) -> DataFrame:
    """Strongest absolute correlation between any two columns, per side.

    Missing values enter as zero. Pairs are computed many to a pass, never one job each. ``own`` names the columns of each
    model where several models share the frame: only pairs that some model owns are computed, and a model's result
    comes from its own pairs.
    """
    pairs = list(combinations(columns, 2))
    owners: dict[tuple[str, str], list[str]] = {}
    if own is not None:
        for model, mine in own.items():
            for pair in combinations(sorted(set(mine), key=columns.index), 2):
                owners.setdefault(pair, []).append(model)
            # A column that a model uses under two names goes with itself.
            if len(set(mine)) < len(mine):
                owners.setdefault((doubled := next(c for c in mine if mine.count(c) > 1), doubled), []).append(model)
        pairs = sorted(owners, key=lambda p: (columns.index(p[0]), columns.index(p[1])))
    shared = own is not None and len(own) > 1
    filled = wide.select(*keys, "side", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    passes = []
    for start in range(0, len(pairs), PAIRS_PER_PASS):
        chunk = pairs[start : start + PAIRS_PER_PASS]
        found = filled.groupBy(*keys, "side").agg(
            *[_correlation(a, b).alias(f"c{i}") for i, (a, b) in enumerate(chunk)], F.count("*").alias("n")
        )
        strengths = []
        for i, pair in enumerate(chunk):
            strength = F.coalesce(F.abs(F.col(f"c{i}")), F.lit(0.0))
            if shared and len(owners[pair]) < len(own):
                strength = F.when(F.col("model_id").isin(owners[pair]), strength).otherwise(0.0)
            strengths.append(strength)
        passes.append(
            found.select(*keys, "side", "n", F.greatest(F.lit(CORRELATION_FLOOR), *strengths).alias("strongest"))
        )
    return (
        union_all(passes)
        .groupBy(*keys)
        .agg(
            F.max(F.when(is_current(), F.col("strongest"))).alias("corr_cur"),
            F.max(F.when(is_baseline(), F.col("strongest"))).alias("corr_base"),
            F.max(F.when(is_current(), F.col("n")).otherwise(0)).alias("n_cur"),
            F.max(F.when(is_baseline(), F.col("n")).otherwise(0)).alias("n_base"),
        )
    )


register_family("quantiles", quantiles)
register_family("dynamic_categories", dynamic_categories)
register_family("canonical", canonical_psi)
register_family("correlation", correlation)

PSI_CANONICAL = register(Metric(
    "psi_canonical", "canonical", lambda: F.col("psi_canonical"), lambda: F.lit(0.0)
))
PSI_DYNAMIC = register(Metric(
    "psi_dynamic", "quantiles", lambda: F.coalesce("psi_dynamic", F.lit(0.0)), lambda: F.lit(0.0), needs_baseline=True
))
KS_VS_DEV = register(Metric(
    "ks_vs_dev", "quantiles", lambda: F.col("ks"), lambda: F.lit(0.0), needs_baseline=True
))
CORRELATION_DRIFT = register(Metric(
    "correlation_drift", "correlation",
    lambda: F.when(F.col("n_base") > 0, F.abs(F.col("corr_cur") - F.col("corr_base"))).otherwise(F.col("corr_cur")),
    lambda: F.col("corr_base"),
    relative=True,
))
