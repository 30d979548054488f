"""Exact order statistics against brute force, and their independence of partitioning."""

import math
import random

import pytest
from pyspark.sql import functions as F

from modelmon.functions.ordering import Grid, Rank, cut_points, fine_bucket, ordered_cross, top_per_group


def values(seed):
    r = random.Random(seed)
    pool = [0.0, -0.0, 1e-300, -1e-300, 1e300, -5.5, 5.5, math.inf, -math.inf, 7.0]
    near = [1e9 + i * 1e-6 for i in range(40)]  # all in one coarse bucket
    return [r.choice(pool + near + [r.gauss(0, 1), r.lognormvariate(0, 4), round(r.random(), 1)]) for _ in range(400)]


@pytest.fixture(scope="module")
def sample(spark):
    rows = [("a" if i % 3 else "b", v, i % 2) for i, v in enumerate(values(1))] + [("a", None, 1), ("c", None, 0)]
    return rows, spark.createDataFrame(rows, "k string, value double, cur int").coalesce(2)


def test_bucket_keeps_order(spark):
    vs = sorted(v for v in values(2))
    got = [r.b for r in spark.createDataFrame([(v,) for v in vs], "v double").coalesce(1).select(fine_bucket(F.col("v")).alias("b")).collect()]
    assert got == sorted(got)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_cut_points(spark, sample, partitions):
    rows, df = sample
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        weighted = df.select("k", "value", F.col("cur").cast("long").alias("c"), (1 - F.col("cur")).cast("long").alias("b"))
        found = cut_points(weighted, ["k"], "value", ["c", "b"], {"c": ["c"], "p": ["c", "b"]}, [Grid("c", 20), Grid("p", 20)]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {(r.k, r.by, r.step): r for r in found}
    assert not [k for k in got if k[0] == "c"]  # nothing but nulls: no cut
    for key in "ab":
        own = [(v, c) for k, v, c in rows if k == key and v is not None]
        for by, members in (("c", [v for v, c in own if c]), ("p", [v for v, _ in own])):
            members.sort()
            for i in range(21):
                cut = members[max(-(-i * len(members) // 20), 1) - 1]
                r = got[key, by, i]
                assert r.cut == cut
                assert r.upto_c == sum(1 for v, c in own if c and v <= cut)
                assert r.total_b == sum(1 for v, c in own if not c)


def test_single_rank(sample):
    rows, df = sample
    found = cut_points(df.withColumn("n", F.lit(1).cast("long")), ["k"], "value", ["n"], {"n": ["n"]}, [Rank("n", lambda total: total - 2)])
    for r in found.collect():
        assert r.cut == sorted(v for k, v, _ in rows if k == r.k and v is not None)[-3]


def test_ordered_cross(sample):
    rows, df = sample
    ranked = df.select("k", "value", F.col("cur").cast("double").alias("p"), (1.0 - F.col("cur")).alias("n"))
    got = {r.k: r for r in ordered_cross(ranked, ["k"], "value", "n", "p").collect()}
    flipped = {r.k: r for r in ordered_cross(ranked.withColumn("value", -F.col("value")), ["k"], "value", "n", "p").collect()}
    for key in "ab":
        own = [(v, c) for k, v, c in rows if k == key and v is not None]
        want = sum((1.0 if n < p else 0.5 if n == p else 0.0) for p, cp in own if cp for n, cn in own if not cn)
        assert got[key].cross == pytest.approx(want)
        assert got[key].cross + flipped[key].cross == pytest.approx(got[key].total_left * got[key].total_right)


def test_top_per_group_cuts_before_the_shuffle(spark, sample):
    _, df = sample
    top = top_per_group(df, ["k"], [F.desc("value")], 2)
    assert top.count() == 5
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
