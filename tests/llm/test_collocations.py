"""Phrase collocations against plain counting of everything."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelmon.llm import collocations


def plain(rows, top):
    out = []
    by = {}
    for text, lang in rows:
        by.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in by.items():
        f, n = Counter(), 0
        for text in texts:
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for k in range(1, 5):
                    f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        good = [p for p, a in f.items() if len(p) > 1 and a >= 30]
        most = Counter()
        for p in good:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], f[p])
        found = []
        for p in good:
            score, k = min((2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * most[p] < 80 * f[p]:
                found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ünï", "É", "a b", "THE", "the", "x y"]
    fixed_phrases = ["new york city hall", "New York", "san  francisco", "a b a b", "red\tgreen blue", "über den É", "of the the the the"]
    rows = []
    for i in range(900):
        parts = []
        for _ in range(rng.randrange(1, 25)):
            parts.append(rng.choice(fixed_phrases) if rng.random() < 0.3 else vocab[min(int(rng.expovariate(0.08)), 65)])
            parts.append(rng.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", "!", ";x "]))
        rows.append(("".join(parts), rng.choice(["en", "en", "en", "de", None])))
    rows += [(None, "en"), ("", "de"), (" .. ", "fr"), ("one two", "it"), ("und words", "und")] + [("same row again and again here.", "en")] * 40
    rows.append(("long text of words " * 3000, "de"))
    return rows


@pytest.mark.parametrize(("top", "frontier", "chunk", "bits"), [(2000, 4000, 4_000_000, 1 << 26), (12, 8, 500, 1 << 26), (30, 5, 3000, 128), (5, 1, 4000, 1 << 12)])
def test_equals_plain(spark, monkeypatch, top, frontier, chunk, bits):
    monkeypatch.setattr(collocations, "FRONTIER", frontier)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(collocations, "FILTER_BITS", bits)
    rows = corpus()
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("phrase", F.lit("clash")).withColumn("n", F.lit(1)).repartition(3)
    assert sorted(map(tuple, collocations.collocations(docs, top).collect())) == plain(rows, top)


def test_bounds_hold():
    rng = random.Random(1)
    for _ in range(1000):
        a = rng.randrange(30, 100)
        p = a + rng.randrange(50)
        first, rest = p + rng.randrange(200), a + rng.randrange(300)
        assert 2000000 * a // (first + rest) <= 2000000 * p // (first + p)


def test_large_counts(spark):
    big = 9 * 10**17
    known = spark.createDataFrame([("en", "a", big), ("en", "b", 2 * big)], "lang string, phrase string, n long")
    row = collocations.scored(spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, n long"), known).first()
    assert (row.a, row.l, row.r, row.score) == (big, big, 2 * big, 2000000 // 3)


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    found = collocations.collocations(empty)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.collect() == []


def test_filter_keeps_members(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 16)
    words = [f"wörd{i} x{i} {i}" for i in range(300)]
    keep = collocations.phrase_filter(spark.createDataFrame([(w,) for w in words], "phrase string"), 3)
    chunk = collocations.Chunk()
    h = {w: np.array([collocations.xxhash.xxh64_intdigest(p.encode(), 42) for p in w.split()], np.uint64) for w in words}
    assert all(keep(np.array([v[0] ^ collocations._turn(v[1:2], 17)[0] ^ collocations._turn(v[2:], 31)[0]]))[0] for v in h.values())
    assert 0 < int(np.bitwise_count(keep.bits).sum()) <= 300 and chunk.size == 0
