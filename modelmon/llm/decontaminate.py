"""Benchmark decontamination: a BM25 inverted index of test items, queried by every training passage.

Items are cut into parts of at most ``PART`` tokens; a part is a document of the index and its postings carry the share
of the part's own BM25 score that a term gives, so a passage that holds every term of a part scores 1, whatever the part.
A passage is ``2 * PART`` tokens and starts every ``PART``, so any run of ``PART`` tokens lies whole in one of them. Every
passage of every text is queried for all parts with a score of ``THRESHOLD`` or more:

* first over all passages of a batch at once: a part cannot reach the threshold without some of the terms that carry most
  of its score, so the postings of those terms alone, added up per half passage and part, bound every part's score, and
  passages in which no part's bound is high enough hold no pivot and end here;
* then block-max WAND over the postings: cursors in order of part, the pivot where the sum of term bounds reaches the
  threshold, block maxima checked before any score is added up.

A part found makes its item a candidate, which stands if the item's question and answer are there as runs of ``RUN``
tokens. The index is broadcast a shard at a time: a shard holds items of at most ``SHARD_CHARS`` characters, so a large
benchmark means more passes and not a larger broadcast.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from modelmon.llm.common import BATCH_ROWS, fixed

K1, B = 1.2, 0.75
PART = 64
THRESHOLD = 0.5
# Score a part may draw from its common terms; the bound over its other terms must make up the rest.
COMMON_SHARE = 0.25
BLOCK = 32
RUN = 5
MIN_QUESTION = 0.6
MIN_ANSWER = 0.5
MIN_BOTH = 0.8
SHARD_CHARS = 16_000_000
_TOKEN = re.compile(r"[^\W_]+")
_SENTENCE_END = re.compile(r"(?<=[.?!])\s+|\n+")
_EPS = 1e-9


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """The tokens of an item's question and answer: its last sentence is the answer; a single sentence is all question."""
    sentences = [t for t in (tokens(s) for s in _SENTENCE_END.split(text or "")) if t]
    if len(sentences) < 2:
        return sum(sentences, []), []
    return sum(sentences[:-1], []), sentences[-1]


class Index:
    """Postings over the parts of some items, with term and block bounds."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_parts: int, mean: float) -> None:
        self.items = [(key, *question_and_answer(text)) for key, text in items]
        self.vocabulary: dict[str, int] = {}
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        needed: dict[int, list[tuple[int, float]]] = defaultdict(list)
        self.part_item: list[int] = []
        self.item_ids = []
        for number, (_, question, answer) in enumerate(self.items):
            both = question + answer
            ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in both]
            self.item_ids.append((ids[: len(question)], ids[len(question) :]))
            for at in range(0, len(both), PART):
                part, part_ids = both[at : at + PART], ids[at : at + PART]
                counts = Counter(part_ids)
                names = dict(zip(part_ids, part))
                norm = K1 * (1 - B + B * len(part) / mean)
                impact = {
                    t: math.log(1 + (n_parts - df[names[t]] + 0.5) / (df[names[t]] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                    for t, tf in counts.items()
                }
                whole_score = sum(impact.values())
                me = len(self.part_item)
                self.part_item.append(number)
                rest = 1.0
                for t, x in sorted(impact.items(), key=lambda e: -e[1]):
                    share = x / whole_score
                    postings[t].append((me, share))
                    if rest > COMMON_SHARE:
                        needed[t].append((me, share))
                    rest -= share
        self.parts = {t: [p for p, _ in some] for t, some in postings.items()}
        self.shares = {t: [x for _, x in some] for t, some in postings.items()}
        self.block_max = {t: [max(x[i : i + BLOCK]) for i in range(0, len(x), BLOCK)] for t, x in self.shares.items()}
        self.bound = {t: max(x) for t, x in self.block_max.items()}
        # The postings without those of a part's common terms, by term: a slice of two arrays.
        self.needed_size = np.array([len(needed[t]) for t in range(len(self.vocabulary))] + [0], np.int64)
        self.needed_start = np.cumsum(self.needed_size) - self.needed_size
        flat = [p for t in range(len(self.vocabulary)) for p in needed[t]]
        self.needed_part = np.array([p for p, _ in flat], np.int64)
        self.needed_share = np.array([x for _, x in flat])

    def search(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """(part, score) of all parts that score ``threshold`` or more for a set of terms, by block-max WAND."""
        least = threshold - _EPS
        # A cursor: current part, term, place.
        cursors = [[self.parts[t][0], t, 0] for t in terms]
        found = []
        while True:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += self.bound[c[1]]
                if total >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            part = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == part:
                pivot += 1
            head = cursors[: pivot + 1]
            bound, block_end = 0.0, None
            for c in head:
                at = bisect_left(self.parts[c[1]], part, c[2])
                block = at // BLOCK
                if block < len(self.block_max[c[1]]):
                    bound += self.block_max[c[1]][block]
                    last = self.parts[c[1]][min(len(self.parts[c[1]]), (block + 1) * BLOCK) - 1]
                    block_end = last if block_end is None else min(block_end, last)
            if bound < least:
                target = max(part, block_end if block_end is not None else part) + 1
                if pivot + 1 < len(cursors):
                    target = max(part + 1, min(target, cursors[pivot + 1][0]))
            else:
                target = part
                if cursors[0][0] == part:
                    score = sum(self.shares[c[1]][c[2]] for c in head)
                    if score >= least:
                        found.append((part, score))
                    target = part + 1
            kept = cursors[pivot + 1 :]
            for c in head:
                at = bisect_left(self.parts[c[1]], target, c[2])
                if at < len(self.parts[c[1]]):
                    kept.append([self.parts[c[1]][at], c[1], at])
            cursors = kept

    def overlaps(self, item: int, region: list[int]) -> tuple[float, float, float]:
        """The shares of the runs of an item's question, answer and both that the region holds (an empty answer: 1)."""
        question, answer = self.item_ids[item]

        def share(wanted: list[int]) -> float:
            n = min(RUN, len(wanted))
            if not n:
                return 1.0
            runs = set(zip(*(wanted[i:] for i in range(n))))
            return len(runs & set(zip(*(region[i:] for i in range(n))))) / len(runs)

        return share(question), share(answer), share(question + answer)

    def _passages(self, flat: np.ndarray, chunk: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The passages (by their first chunk) in which some part's bound allows the threshold."""
        least, n_parts = THRESHOLD - COMMON_SHARE - _EPS, len(self.part_item)
        useful = self.needed_size[flat] > 0
        base = len(self.needed_size)
        pairs = np.unique(chunk[useful] * base + flat[useful])
        size = self.needed_size[pairs % base]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(self.needed_start[pairs % base], size) + inside
        keys, where = np.unique(np.repeat(pairs // base, size) * n_parts + self.needed_part[at], return_inverse=True)
        if not len(keys):
            return keys
        bound = np.bincount(where, self.needed_share[at])
        own = keys // n_parts
        after = np.minimum(np.searchsorted(keys, keys + n_parts), len(keys) - 1)
        joined = (keys[after] == keys + n_parts) & (owner[own] == owner[np.minimum(own + 1, len(owner) - 1)])
        here = own[bound + np.where(joined, bound[after], 0.0) >= least]
        # A part whose bound is in the second half of a passage alone.
        ahead = own[(bound >= least) & (own > 0)] - 1
        return np.unique(np.concatenate([here, ahead[owner[ahead] == owner[ahead + 1]]]))

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text number, item, score, question overlap, answer overlap) of the verified items in the texts."""
        unknown = len(self.vocabulary)
        look = _Numbers(self.vocabulary, unknown).__getitem__
        ids = [np.fromiter(map(look, tokens(t)), np.int32) for t in texts]
        sizes = np.array([len(x) for x in ids], np.int64)
        chunks = -(-sizes // PART)
        first_chunk = np.cumsum(chunks) - chunks
        if not sizes.sum():
            return
        flat = np.concatenate(ids)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        chunk = np.repeat(first_chunk, sizes) + place // PART
        owner = np.repeat(np.arange(len(texts)), chunks)
        passages = self._passages(flat, chunk, owner)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for c in passages:
            text = int(owner[c])
            start = int(c - first_chunk[text]) * PART
            passage = np.unique(ids[text][start : start + 2 * PART])
            for part, score in self.search([int(t) for t in passage if t != unknown]):
                item = self.part_item[part]
                # Room for the whole item on either side of the passage.
                room = sum(map(len, self.item_ids[item]))
                region = ids[text][max(0, start - room) : start + 2 * PART + room].tolist()
                question, answer, all_of_it = self.overlaps(item, region)
                if question >= MIN_QUESTION and answer >= MIN_ANSWER or all_of_it >= MIN_BOTH:
                    key = (text, item)
                    best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, question, answer))
        for (text, item), found in sorted(best.items()):
            yield text, item, *found


class _Numbers(dict):
    def __init__(self, known: dict[str, int], other: int) -> None:
        super().__init__(known)
        self.other = other

    def __missing__(self, key: str) -> int:
        return self.other


def _part_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, part number in item, size) for every distinct term of every part; a part without terms gives none."""
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            both = sum(question_and_answer(text), [])
            for at in range(0, len(both), PART):
                part = both[at : at + PART]
                rows += [(t, int(i == 0), len(part) if i == 0 else 0) for i, t in enumerate(dict.fromkeys(part))]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["term", "parts", "size"]
        )


def _shards(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes over all items, a bounded number of characters each; document frequencies are those of the whole benchmark."""
    items = fixed(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL"),
        "items",
    )
    terms = fixed(items.select("text").mapInArrow(_part_terms, "term string, parts long, size long"), "terms")
    n_parts, size = terms.agg(F.sum("parts"), F.sum("size")).first()
    if not n_parts:
        return
    df = fixed(terms.groupBy("term").agg(F.count("*").alias("df")), "df")
    chars = items.agg(F.sum(F.length("text"))).first()[0]
    shards = -(-chars // SHARD_CHARS)
    for k in range(shards):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k)
        rows = sorted(((r.item_id, r.text) for r in mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        words = mine.select("text").mapInArrow(_part_terms, "term string, parts long, size long").select("term").distinct()
        yield Index(rows, {r.term: r.df for r in df.join(words, "term").collect()}, n_parts, size / n_parts)


def leaks(texts: DataFrame, keys: list[str], benchmark: DataFrame) -> DataFrame:
    """(keys..., item_id, score, question_overlap, answer_overlap): a written table of the items found in each text."""
    source = texts.select(*keys, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keys)
    schema = f"{kinds}, item_id long, score double, question_overlap double, answer_overlap double"
    spark, found = source.sparkSession, []
    for index in _shards(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                hits = list(index.scan(batch.column("text").to_pylist()))
                if hits:
                    at = pa.array([h[0] for h in hits])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(k).take(at) for k in keys),
                            pa.array([index.items[h[1]][0] for h in hits], pa.int64()),
                            *(pa.array([h[i] for h in hits], pa.float64()) for i in (2, 3, 4)),
                        ],
                        names=[*keys, "item_id", "score", "question_overlap", "answer_overlap"],
                    )

        found.append(fixed(source.mapInArrow(run, schema), "leaks"))
        shared.destroy()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) and benchmark item (item_id, text) verified in it, with its best score.

    Null and empty texts hold nothing, null and empty items are found nowhere, equal items are found each under its own id.
    Repeated rows come out repeated; empty tables give an empty one; further columns are ignored.
    """
    return leaks(docs, ["doc_id"], benchmark).select(
        "doc_id", "item_id", *[F.round(c, 6).alias(c) for c in ("score", "question_overlap", "answer_overlap")]
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, with their own columns: a filter, without any shuffle."""
    for index in _shards(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    part = batch.slice(at, BATCH_ROWS)
                    clean = np.ones(part.num_rows, bool)
                    clean[[h[0] for h in shared.value.scan(part.column("text").cast(pa.string()).to_pylist())]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
