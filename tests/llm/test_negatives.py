"""Hard negatives against plain integer arithmetic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelmon.llm import negatives


def plain(rows, every=50, positives=5, count=3):
    good = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(256 * x) for x in v], label))
    score = lambda a, b: sum(x * y for x, y in zip(a[1], b[1]))
    key = lambda s, r: (-s, r[0] is None, r[0] or 0)
    out = []
    for n, a in enumerate(good):
        if a[0] is None or a[0] % every:
            continue
        own = sorted(((score(a, r), r) for m, r in enumerate(good) if m != n and r[2] == a[2]), key=lambda x: key(*x))[:positives]
        others = sorted(((score(a, r), r) for r in good if r[2] != a[2]), key=lambda x: key(*x))
        for p, r in own:
            fit = [(s, o) for s, o in others if 50 * p <= 100 * s <= 95 * p][:count]
            out += [(a[0], r[0], k, o[0], p, s) for k, (s, o) in enumerate(fit, 1)]
    return out


def rows(seed, n, size, spread):
    rng = random.Random(seed)
    base = [[rng.uniform(0.1, 1) for _ in range(size)] for _ in range(4)]
    out = []
    for i in range(n):
        v = [x + rng.gauss(0, spread) for x in rng.choice(base)] if rng.random() < 0.7 else list(base[0])
        out.append((i, v, rng.randrange(4)))
    return out


def cases(size):
    found = rows(1, 260, size, 0.3)
    found += [(None, found[0][1], 1), (None, found[0][1], 2), (400, None, 1), (450, [0.5] * size, None), (500, [], 1), (550, [0.5, -0.25, 1.0], 2)]
    found += [(600, [float("nan")] * size, 1), (601, [float("inf")] + [0.1] * (size - 1), 2), (602, [None] + [0.1] * (size - 1), 2), (650, [0.0] * size, 0)]
    found += [(700, [-x for x in found[0][1]], 3), (-50, found[3][1], 3), (750, [x * 90 for x in found[5][1]], 5), (300, found[7][1], 2), (300, found[7][1], 2)]
    return found


@pytest.mark.parametrize(("size", "part", "block"), [(64, 1 << 16, 32), (13, 40, 3), (8, 100, 1)])
def test_equals_plain(spark, monkeypatch, size, part, block):
    monkeypatch.setattr(negatives, "PART_ROWS", part)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", block)
    monkeypatch.setattr(negatives, "LOOK_ROWS", 17)
    given = cases(size)
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int").withColumn("score", F.lit(1)).withColumn("row", F.lit("x"))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    found = sorted(map(tuple, negatives.hard_negatives(df.repartition(5)).collect()), key=key)
    assert found == sorted(plain(given), key=key) and len(found) > 20


def test_equal_vectors(spark):
    given = [(i, [0.5, 0.5], 0) for i in range(0, 60)] + [(i, [0.4, 0.4], 1) for i in range(60, 130)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, negatives.hard_negatives(df).collect())) == sorted(plain(given))


def test_large_numbers(spark):
    given = [(0, [3e6, 1.0], 0), (1, [2e6, -1.5], 0), (2, [1.5e6, 2.0], 1), (3, [4e9, 0.0], 1), (4, [1e5, -7.5], 0)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, negatives.hard_negatives(df).collect())) == sorted(plain(given))


def test_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for low, high, size in ((-256, 257, 64), (-1, 1, 3), (0, 1, 9), (-(2**40), 2**40, 10), (-5, -4, 16)):
        a, b = rng.integers(low, high, (7, size)), rng.integers(low, high, (30, size))
        bits = int(max(np.abs(a).max(), np.abs(b).max())).bit_length() + 1
        back = negatives.unpack_planes(negatives.pack(a, bits))
        assert (back[:, :size] == a).all() and not back[:, size:].any()
        with np.errstate(over="ignore"):
            assert (negatives.scores(negatives.pack(b, bits), negatives.tables(back)) == b @ a.T).all()


def test_bounds():
    for p in (0, 1, 2, 99, 100, 101, 12345, -1, -2, -77, 10**17 + 7):
        low, high = (int(x[0]) for x in negatives.between(np.array([p], np.int64)))
        near = range(min(low, high) - 3, min(low, high) + 4) if p > 10**6 else range(-abs(p) - 5, abs(p) + 6)
        assert all((50 * p <= 100 * n <= 95 * p) == (low <= n <= high) for n in near)


def test_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(empty).collect() == []
    alone = spark.createDataFrame([(0, [0.5], 1), (50, None, None)], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(alone).collect() == []
