"""Everything plain aggregates can say, from one wide aggregate per source.

A source is grouped by run and side with its columns side by side; only the finished row, one per run and side, is taken
apart into variables. Rows are never multiplied by the number of variables. Very wide sources are taken some columns at a
time: a columnar scan then reads each column once all the same, and the aggregate stays small enough to be compiled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.columns import KEYS, clean_double, is_baseline, is_current, union_all
from modelmon.plans.feeds import Feed, Feeds

RUN_SIDE = ["model_id", "information_date", "side"]
# Columns of one aggregate.
COLUMNS_PER_PASS = 12
MOMENTS = ["mean", "std", "low", "high"]
# What a side is counted by, and what of it is kept.
COUNTS = ["n", "known", "outside", "approved"]


def _cell(column: str, numeric: bool, cutoff: Column) -> Column:
    """All measures of one column as a struct."""
    value = F.col(column)
    number = value if numeric else F.lit(None).cast("double")
    measures = {
        "n": F.count("*"), "known": F.count(value),
        "outside": F.count_if((number < 0.0) | (number > 1.0)), "approved": F.count_if(number > cutoff),
        "mean": F.avg(number), "std": F.stddev_samp(number), "low": F.min(number), "high": F.max(number),
    }
    return F.struct(*[c.alias(n) for n, c in measures.items()])


def _source(feeds: Feeds, feed: Feed, dates: DataFrame, literals: dict, cutoffs: DataFrame) -> list[DataFrame]:
    """(RUN_SIDE, var_type, variable, measures) frames of one source."""
    entries = [(*e, numeric) for numeric in (True, False) for e in feed.entries(numeric)]
    columns = sorted({(column, numeric) for column, _, _, numeric in entries})
    out = []
    for at in range(0, len(columns), COLUMNS_PER_PASS):
        mine = columns[at : at + COLUMNS_PER_PASS]
        alias = {c: f"_v{i}" for i, c in enumerate(mine)}
        rows = feeds.columns(feed, dates, literals, alias).join(cutoffs, "model_id", "left")
        cutoff = F.coalesce("cutoff", F.lit(0.5))
        per_side = rows.groupBy(*RUN_SIDE).agg(*[_cell(a, c[1], cutoff).alias(a) for c, a in alias.items()])
        cells = F.array(*[
            F.struct(F.lit(kind).alias("var_type"), F.lit(variable).alias("variable"), F.col(alias[column, numeric]).alias("m"))
            for column, variable, kind, numeric in entries if (column, numeric) in alias
        ])
        long = per_side.select(*RUN_SIDE, F.explode(cells).alias("c")).select(*RUN_SIDE, "c.var_type", "c.variable", "c.m.*")
        out.append(feeds.owned(feed, long))
    return out


def measures(feeds: Feeds, dates: DataFrame, literals: dict) -> DataFrame:
    """KEYS with the counts of both sides and the current side's mean, deviation and range; one row per measured variable."""
    parts = [part for feed in feeds.feeds for part in _source(feeds, feed, dates, literals, feeds.cutoffs())]
    # A column of a source that is read in several forms comes in several parts.
    per_side = union_all(parts)

    def side(name: str, is_side: Column, suffix: str) -> Column:
        found = F.max(F.when(is_side, F.col(name)))
        return (F.coalesce(found, F.lit(0)) if name in COUNTS else found).alias(f"{name}_{suffix}")

    sides = [side(c, s, x) for c in [*COUNTS, *MOMENTS] for s, x in ((is_current(), "cur"), (is_baseline(), "base"))]
    both = per_side.groupBy(*KEYS).agg(*sides)
    return both.withColumns({f"null_{x}": F.col(f"n_{x}") - F.col(f"known_{x}") for x in ("cur", "base")})
