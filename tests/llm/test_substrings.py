"""Repeated passages against a plain dictionary of windows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelmon.llm import substrings
from tests.llm.test_llm import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    """(doc_id, text) rows to (doc_id, kept text, n_words, n_removed) rows."""
    place = lambda i, s: (i is None, i or 0, s)
    first, out = {}, Counter()
    found = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in found:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, place(i, s)), place(i, s))
    for i, words in found:
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < place(i, s):
                gone.update(range(s, s + window))
        out[i, " ".join(w for k, w in enumerate(words) if k not in gone), len(words), len(gone)] += 1
    return out


def cases():
    rng = random.Random(5)
    shared = prose(1, 45)
    rows = [
        (10, prose(2, 300)), (11, prose(2, 300)), (12, prose(3, 40) + "\n" + shared + "\t" + prose(4, 30)), (3, shared), (4, shared + " " + shared),
        (5, "a " * 70), (6, "x y " * 40), (7, None), (8, ""), (9, " \x0b\x0c "), (None, shared), (None, prose(6, 50) + " " + shared),
        (13, prose(2, 19)), (14, " ".join(prose(2, 300).split()[100:120])), (15, " ".join(prose(2, 300).split()[100:119])),
        (16, prose(9, 20000)), (17, prose(9, 20000)[5000:40000]), (18, "Ünï çode x " * 30), (18, "Ünï çode x " * 30), (19, "Ünï çode x " * 30),
    ]
    for i in range(100, 160):
        cut = rng.randrange(260)
        rows.append((i, " ".join(prose(2, 300).split()[cut : cut + rng.randrange(60)]) + " " + prose(i, rng.randrange(50))))
    rows += [(i, "the same text stands in a third of all rows " * 4) for i in range(200, 240)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("window", "chars"), [(20, 8_000_000), (20, 9_000), (7, 9_000), (48, 3_000), (1, 20_000)])
def test_equals_plain(spark, monkeypatch, window, chars):
    monkeypatch.setattr(substrings, "PART_CHARS", chars)
    rows = cases()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash")).withColumn("hash", F.lit(1)).repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # runs of equal hashes cross batches
    try:
        found = Counter(map(tuple, substrings.dedup(docs, window).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found == plain(rows, window)


def test_levels():
    assert [substrings.lengths(n) for n in (1, 7, 16, 20, 40, 64)] == [[1], [7], [8, 16], [10, 20], [10, 20, 40], [8, 16, 32, 64]]
    words = np.arange(1, 60, dtype=np.uint64)
    for size in (1, 2, 3, 7, 10, 20, 59, 60):
        h = substrings.run_hashes(words, size)
        assert len(h) == max(0, 60 - size) and len(set(h.tolist())) == len(h)
        twice = substrings.run_hashes(np.concatenate([words, words]), size)
        assert (twice[: len(h)] == h).all() and (len(h) == 0 or (twice[-len(h) :] == h).all())


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert substrings.dedup(empty).collect() == []
    nothing = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert [tuple(r) for r in substrings.dedup(nothing).collect()] == [(None, "", 0, 0)]
    with pytest.raises(ValueError):
        substrings.dedup(empty, 0)
