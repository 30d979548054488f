"""Exact order statistics that no single task has to hold.

``percentile`` and an un-split ``row_number`` both bring a whole group to one task. Here a
value's magnitude gives it an order-preserving bucket that depends on nothing but the value:

    coarse bucket   4096 per factor of e   (about 57,000 for six decades)
    fine bucket     2**20 per coarse bucket
    distinct values at most about 2**20 per fine bucket

Buckets are counted with map-side combine, so a hot variable or a hot value costs one row per
task, and every window below runs inside one bucket, never over a whole group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from modelmon.functions.sizes import fits, reliable

FINE_PER_E = float(2**32)
COARSE_SHIFT = 20
# ln of the smallest positive double is -744.4; the shift keeps every magnitude positive.
MAGNITUDE_SHIFT = 746.0


@dataclass(frozen=True)
class Grid:
    """The quantiles 0, 1/steps, ... 1 of a rank: row ceil(i * n / steps), at least row 1."""

    by: str
    steps: int

    def hits(self, before: Column, own: Column, total: Column) -> Column:
        """Steps whose row lies among the ``own`` rows that follow ``before`` rows."""
        low = F.call_function("div", before * self.steps, total)
        high = F.call_function("div", (before + own) * self.steps, total)
        inner = F.when(high > low, F.sequence(low + 1, high)).otherwise(F.array().cast("array<bigint>"))
        steps = F.when(before == 0, F.concat(F.array(F.lit(0).cast("long")), inner)).otherwise(inner)

        def hit(i: Column) -> Column:
            rank = F.call_function("div", i * total + (self.steps - 1), F.lit(self.steps))
            return F.struct(
                F.lit(self.by).alias("by"), i.alias("step"), F.greatest(rank, F.lit(1).cast("long")).alias("rank")
            )

        found = (own > 0) & ((high > low) | (before == 0))
        return F.when(found, F.transform(steps, hit)).otherwise(F.array().cast(HITS))


@dataclass(frozen=True)
class Rank:
    """One row of a rank, given as a function of the total."""

    by: str
    rank: Callable[[Column], Column]

    def hits(self, before: Column, own: Column, total: Column) -> Column:
        k = self.rank(total).cast("long")
        hit = F.struct(F.lit(self.by).alias("by"), F.lit(0).cast("long").alias("step"), k.alias("rank"))
        return F.when((k > before) & (k <= before + own), F.array(hit)).otherwise(F.array().cast(HITS))


HITS = "array<struct<by:string,step:bigint,rank:bigint>>"


def fine_bucket(value: Column) -> Column:
    magnitude = F.floor((F.ln(F.abs(value)) + MAGNITUDE_SHIFT) * FINE_PER_E).cast("long")
    return F.when(value == 0, F.lit(0)).when(value > 0, magnitude).otherwise(-magnitude)


def coarse_bucket(fine: Column) -> Column:
    return F.shiftright(fine, COARSE_SHIFT)


def _selective(keys: list[str]) -> list[str]:
    """Keys with the date first: rows are told apart by the first sort column, most cheaply."""
    return sorted(keys, key=lambda k: k != "information_date")


def _sums(columns: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _before(columns: list[str], window) -> list[Column]:
    return [F.coalesce(F.sum(c).over(window), F.lit(0)).alias(f"before_{c}") for c in columns]


def cut_points(
    rows: DataFrame,
    keys: list[str],
    value: str,
    weights: list[str],
    ranks: dict[str, list[str]],
    targets: list[Grid | Rank],
) -> DataFrame:
    """Values at given ranks, with the running totals of every weight up to each of them.

    ``rows`` holds ``keys``, a numeric ``value`` (nulls are skipped) and whole-number
    ``weights``. ``ranks`` names the weights a rank counts (``{"pool": ["n_cur", "n_base"]}``);
    a target is a :class:`Grid` or a :class:`Rank` on one of them. Returns one row per key and
    reached target: ``by, step, cut, upto_<weight>, at_<weight>, total_<weight>``.

    Two scans: one counts coarse buckets, the other keeps only the buckets that hold a target.
    Those buckets are broadcast if their counted number allows it, so only their rows are
    shuffled and sorted; otherwise rows are combined by value before they meet the buckets.
    Both small intermediate frames are fixed in the shared folder.
    """
    coded = rows.where(F.col(value).isNotNull()).withColumn("_fine", fine_bucket(F.col(value)))
    coded = coded.withColumn("_coarse", coarse_bucket(F.col("_fine")))

    in_order = W.partitionBy(*_selective(keys)).orderBy("_coarse").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*_selective(keys))
    histogram = (
        coded.groupBy(*keys, "_coarse")
        .agg(*_sums(weights))
        .select(
            "*",
            *_before(weights, in_order),
            *[F.sum(w).over(whole).alias(f"total_{w}") for w in weights],
        )
    )

    def summed(prefix: str, by: str) -> Column:
        return sum((F.col(f"{prefix}{w}") for w in ranks[by][1:]), F.col(f"{prefix}{ranks[by][0]}"))

    hits = [t.hits(summed("before_", t.by), summed("", t.by), summed("total_", t.by)) for t in targets]
    chosen = histogram.withColumn("_hits", F.concat(*hits)).where(F.size("_hits") > 0)
    chosen = reliable(
        chosen.select(
            *keys, "_coarse", "_hits", *[f"before_{w}" for w in weights], *[f"total_{w}" for w in weights]
        )
    )

    wanted, on = chosen.select(*keys, "_coarse"), [*keys, "_coarse"]
    by_value = [*on, "_fine", value]
    if fits(wanted):
        leaf = coded.join(F.broadcast(wanted), on, "left_semi").groupBy(*by_value).agg(*_sums(weights))
    else:
        leaf = coded.groupBy(*by_value).agg(*_sums(weights)).join(wanted, on, "left_semi")
    leaf = reliable(leaf)
    return _descend(leaf, chosen, keys, value, weights, ranks)


def _descend(leaf, chosen, keys, value, weights, ranks) -> DataFrame:
    """Coarse hits -> fine hits -> the value itself."""

    def reached(running: str) -> Column:
        """True where the rank falls on this row; ``running`` prefixes the totals before it."""
        test = F.lit(False)
        for by, parts in ranks.items():
            low = sum((F.col(f"{running}{w}") for w in parts[1:]), F.col(f"{running}{parts[0]}"))
            own = sum((F.col(w) for w in parts[1:]), F.col(parts[0]))
            test = F.when(F.col("by") == by, (F.col("rank") > low) & (F.col("rank") <= low + own)).otherwise(test)
        return test

    in_coarse = W.partitionBy("_coarse", *keys).orderBy("_fine").rowsBetween(W.unboundedPreceding, -1)
    fine = (
        leaf.groupBy(*keys, "_coarse", "_fine")
        .agg(*_sums(weights))
        .select(*keys, "_coarse", "_fine", *weights, *[c.alias(f"in_{w}") for w, c in zip(weights, _before(weights, in_coarse))])
        .join(chosen.select("*", F.explode("_hits").alias("_hit")).drop("_hits"), [*keys, "_coarse"])
        .select(
            *keys, "_fine", "_hit.by", "_hit.step", "_hit.rank", *weights,
            *[(F.col(f"before_{w}") + F.col(f"in_{w}")).alias(f"low_{w}") for w in weights],
            *[f"total_{w}" for w in weights],
        )
        .where(reached("low_"))
        .drop(*weights)
    )
    in_fine = W.partitionBy("_fine", *keys).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        leaf.select(*keys, "_fine", value, *weights, *[c.alias(f"in_{w}") for w, c in zip(weights, _before(weights, in_fine))])
        .join(fine, [*keys, "_fine"])
        .withColumns({f"low_{w}": F.col(f"low_{w}") + F.col(f"in_{w}") for w in weights})
        .where(reached("low_"))
        .select(
            *keys, "by", "step", F.col(value).alias("cut"),
            *[(F.col(f"low_{w}") + F.col(w)).alias(f"upto_{w}") for w in weights],
            *[F.col(w).alias(f"at_{w}") for w in weights],
            *[f"total_{w}" for w in weights],
        )
    )


def ordered_cross(rows: DataFrame, keys: list[str], value: str, left: str, right: str) -> DataFrame:
    """Per key: sum over values of right * (left before the value + half of left at it).

    With left = negatives and right = positives this is the rank-sum behind the ROC area;
    with left = count and right = value mass it is the numerator of a concentration index.
    Partial results of neighbouring buckets merge in order, so each level only sees one row
    per bucket of the level below. Returns ``keys, total_left, total_right, cross``.
    """
    coded = rows.where(F.col(value).isNotNull()).withColumn("_fine", fine_bucket(F.col(value)))
    coded = coded.withColumn("_coarse", coarse_bucket(F.col("_fine")))
    state = coded.groupBy(*keys, "_coarse", "_fine", value).agg(
        F.sum(left).cast("double").alias("l"), F.sum(right).cast("double").alias("r")
    )
    state = state.withColumn("x", F.col("l") * F.col("r") / 2)
    for group, order in (
        (["_fine", "_coarse", *keys], value),
        (["_coarse", *keys], "_fine"),
        (_selective(keys), "_coarse"),
    ):
        window = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        earlier = F.coalesce(F.sum("l").over(window), F.lit(0.0))
        state = (
            state.withColumn("x", F.col("x") + F.col("r") * earlier)
            .groupBy(*group)
            .agg(F.sum("l").alias("l"), F.sum("r").alias("r"), F.sum("x").alias("x"))
        )
    return state.select(
        *keys, F.col("l").alias("total_left"), F.col("r").alias("total_right"), F.col("x").alias("cross")
    )


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], limit: int, rank: str = "rank") -> DataFrame:
    """First ``limit`` rows of every group.

    The literal bound lets Spark cut each task's share to ``limit`` rows per group before the
    shuffle, so a group with very many members stays cheap.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= limit)
