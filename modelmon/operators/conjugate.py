"""Score-versus-outcome metrics on joined pairs: KEYS + side, score, target, tie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.columns import KEYS, clean_double, is_baseline, is_current
from modelmon.functions.ordering import Grid, Rank, cut_points, ordered_cross
from modelmon.functions.sizes import bounded, reliable
from modelmon.operators.registry import Metric, register, register_family
from modelmon.operators.stability import KS_FLOOR, KS_STEPS, ks_gap

# How score-target results are named in the result tables.
SCORE_VARIABLE, SCORE_TYPE = "__SCORE__", "conjugate"
SIDE_KEYS = [*KEYS, "side"]


def tie_order(key_columns: list[str]) -> Column:
    """A number that orders rows with equal scores the same way on every run."""
    return F.shiftright(F.xxhash64(*key_columns), 11).cast("double")


def join_pairs(scores: DataFrame, targets: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of score and target on their shared keys and date."""
    shared = [c for c in on if c in scores.columns and c in targets.columns]
    if not shared:
        raise ValueError("no common join keys between score and target")
    return scores.join(targets, shared, "inner")


def as_pairs(joined: DataFrame, tie: Column) -> DataFrame:
    """Name a joined frame (model_id, information_date, side, score, target) as pairs."""
    return joined.select(
        "model_id",
        "information_date",
        F.lit(SCORE_TYPE).alias("var_type"),
        F.lit(SCORE_VARIABLE).alias("variable"),
        "side",
        clean_double(F.col("score")).alias("score"),
        clean_double(F.col("target")).alias("target"),
        tie.alias("tie"),
    )


def _by_side(per_side: DataFrame, measures: list[str]) -> DataFrame:
    """(KEYS, side) rows -> one row per key with ``_cur`` / ``_base`` columns."""
    columns = []
    for m in ["n", *measures]:
        columns.append(F.max(F.when(is_current(), F.col(m))).alias(f"{m}_cur"))
        columns.append(F.max(F.when(is_baseline(), F.col(m))).alias(f"{m}_base"))
    return (
        per_side.groupBy(*KEYS).agg(*columns).fillna(0, ["n_cur", "n_base"]).where(F.col("n_cur") > 0)
    )


def roc(pairs: DataFrame) -> DataFrame:
    """Area under the ROC curve per side by rank sums; equal scores count one half."""
    valid = pairs.where(F.col("score").isNotNull() & F.col("target").isNotNull()).withColumns(
        {"positive": (F.col("target") > 0.5).cast("double"), "negative": (F.col("target") <= 0.5).cast("double")}
    )
    ranked = ordered_cross(valid, SIDE_KEYS, "score", "negative", "positive")
    area = (
        F.when(F.col("total_right") == 0, 0.0)
        .when(F.col("total_left") == 0, 1.0)
        .otherwise(F.try_divide("cross", F.col("total_left") * F.col("total_right")))
    )
    return _by_side(ranked.withColumns({"auc": area, "n": F.col("total_left") + F.col("total_right")}), ["auc"])


def fit(pairs: DataFrame) -> DataFrame:
    """Squared error and calibration slope per side: one plain aggregation."""
    both = F.col("score").isNotNull() & F.col("target").isNotNull()
    slope = F.regr_slope(F.col("target"), F.col("score"))
    per_side = pairs.groupBy(*SIDE_KEYS).agg(
        F.count("*").alias("n"),
        F.avg(F.pow(F.col("score") - F.col("target"), F.lit(2.0))).alias("brier"),
        F.when(F.count_if(both) < 2, 1.0).otherwise(F.coalesce(slope, F.lit(0.0))).alias("slope"),
    )
    return _by_side(per_side, ["brier", "slope"])


def top_tile(pairs: DataFrame) -> DataFrame:
    """The best of ten equal tiles per side: its rows, known outcomes and events, and the rest.

    The first tile holds ceil(n/10) rows, best score first and missing scores last. Rows that
    tie at its border enter in tie order, found by a second order statistic over the tied rows
    only, so no group is ever sorted as a whole.
    """
    low = F.lit(float("-inf"))
    rows = pairs.select(
        *SIDE_KEYS,
        F.coalesce("score", low).alias("score"),
        "tie",
        F.lit(1).cast("long").alias("n"),
        F.coalesce("target", F.lit(0.0)).alias("events"),
        F.col("target").isNotNull().cast("long").alias("known"),
    )
    weights = ["n", "events", "known"]
    top_border = Rank("n", lambda total: F.call_function("div", total * 9, F.lit(10)) + 1)
    border = cut_points(rows, SIDE_KEYS, "score", weights, {"n": ["n"]}, [top_border])
    border = reliable(
        border.select(
            *SIDE_KEYS,
            F.col("cut").alias("border"),
            F.col("total_n").alias("all_n"),
            "total_events",
            "total_known",
            (F.call_function("div", F.col("total_n") + 9, F.lit(10)) - (F.col("total_n") - F.col("upto_n"))).alias("need"),
            (F.col("total_events") - F.col("upto_events")).alias("events_above"),
            (F.col("total_known") - F.col("upto_known")).alias("known_above"),
        )
    )
    edge = bounded(border.select(*SIDE_KEYS, F.col("border").alias("score"), "need"))
    tied = rows.join(edge, [*SIDE_KEYS, "score"])
    last_in = Rank("n", lambda total: F.least(F.col("need"), total))
    taken = cut_points(tied, [*SIDE_KEYS, "need"], "tie", weights, {"n": ["n"]}, [last_in])
    # Rows that share the last tie value (never, with unique keys) enter by their share.
    short = (F.col("need") - (F.col("upto_n") - F.col("at_n"))) / F.col("at_n")
    taken = taken.select(
        *SIDE_KEYS,
        (F.col("upto_events") - F.col("at_events") + F.col("at_events") * short).alias("events_tied"),
        (F.col("upto_known") - F.col("at_known") + F.col("at_known") * short).alias("known_tied"),
    )
    return border.join(taken, SIDE_KEYS).select(
        *SIDE_KEYS, F.col("all_n").alias("n"), "total_events", "total_known",
        F.call_function("div", F.col("all_n") + 9, F.lit(10)).alias("tile_rows"),
        (F.col("events_above") + F.col("events_tied")).alias("tile_events"),
        (F.col("known_above") + F.col("known_tied")).alias("tile_known"),
    )


def lift(pairs: DataFrame) -> DataFrame:
    """Event rate of the best tenth over the overall rate, per side."""
    overall = F.try_divide("total_events", "total_known")
    top = F.try_divide("tile_events", "tile_known")
    value = F.when(overall != 0, F.try_divide(top, overall)).otherwise(0.0)
    return _by_side(top_tile(pairs).withColumn("lift", value), ["lift"])


def separation(pairs: DataFrame) -> DataFrame:
    """KS distance between the scores of the two outcomes, per side."""
    rows = pairs.where(F.col("target").isin(0.0, 1.0)).select(
        *SIDE_KEYS,
        F.col("score").alias("value"),
        (F.col("target") == 0).cast("long").alias("n_0"),
        (F.col("target") == 1).cast("long").alias("n_1"),
    )
    cuts = cut_points(rows, SIDE_KEYS, "value", ["n_0", "n_1"], {"pool": ["n_0", "n_1"]}, [Grid("pool", KS_STEPS)])
    sizes = rows.groupBy(*SIDE_KEYS).agg(F.sum("n_0").alias("n_0"), F.sum("n_1").alias("n_1"))
    per_side = sizes.join(cuts, SIDE_KEYS, "left").groupBy(*SIDE_KEYS).agg(
        F.first(F.col("n_0") + F.col("n_1")).alias("n"),
        F.greatest(F.lit(KS_FLOOR), F.max(ks_gap(["upto_n_0", "upto_n_1"], ["n_0", "n_1"]))).alias("ks"),
    )
    return _by_side(per_side, ["ks"])


register_family("roc", roc)
register_family("fit", fit)
register_family("lift", lift)
register_family("separation", separation)


def _has_base(value):
    return F.when(F.col("n_base") > 0, value)


def _drop(current: Column, base: Column) -> Column:
    """Relative loss against the baseline; the value itself without one."""
    return (
        F.when(F.col("n_base") == 0, current)
        .when(base != 0, F.try_divide(base - current, base))
        .otherwise(0.0)
    )


def _gini(side: str) -> Column:
    return 2.0 * F.col(f"auc_{side}") - 1.0


AUC = register(Metric("auc", "roc", lambda: F.col("auc_cur"), lambda: _has_base(F.col("auc_base"))))
GINI = register(Metric(
    "gini", "roc", lambda: _drop(_gini("cur"), _gini("base")), lambda: _has_base(_gini("base")), relative=True
))
BRIER_SCORE = register(Metric(
    "brier_score", "fit",
    lambda: F.when(F.col("n_base") == 0, F.col("brier_cur"))
    .when(F.coalesce("brier_base", F.lit(0.0)) != 0, F.try_divide(F.col("brier_cur") - F.col("brier_base"), "brier_base"))
    .otherwise(0.0),
    lambda: _has_base(F.col("brier_base")),
    relative=True,
))
LIFT_TOP_DECILE = register(Metric(
    "lift_top_decile", "lift",
    lambda: _drop(F.col("lift_cur"), F.col("lift_base")),
    lambda: _has_base(F.col("lift_base")),
    relative=True,
))
CALIBRATION_SLOPE = register(Metric(
    "calibration_slope", "fit",
    lambda: F.when(
        (F.col("n_base") > 0) & (F.col("slope_base") != 0),
        F.try_divide(F.abs(F.col("slope_cur") - F.col("slope_base")), F.abs("slope_base")),
    ).otherwise(F.abs(F.col("slope_cur") - 1.0)),
    lambda: _has_base(F.col("slope_base")),
    relative=True,
))
KS_SCORE_TARGET = register(Metric(
    "ks_score_target", "separation",
    lambda: F.when(
        (F.col("n_base") > 0) & (F.col("ks_base") != 0),
        F.try_divide(F.abs(F.col("ks_cur") - F.col("ks_base")), "ks_base"),
    ).otherwise(F.col("ks_cur")),
    lambda: _has_base(F.col("ks_base")),
))
