"""Repeated passages: level-wise doubling of word windows over documents dealt to parts.

A window of ``window`` words holds shorter runs, and the run with the smallest hash among them stands for it. Two equal
windows choose equal runs at the same place, so a window can only be repeated if its chosen run is chosen at two places.
The first level counts the chosen runs of ``lengths(window)[0]`` words of all windows; only windows whose run is repeated go
on to runs of twice that length, and so on; the last length is the window itself. No repeated window is lost on the way.

Documents are dealt to parts of about ``PART_CHARS`` characters. What leaves a part is one row per hash, however often the
part holds it, so a passage that a third of all documents share costs one row per part. What comes back to a part are the
hashes that go on. The dealt texts are shuffled once: the passes are one plan, and Spark reuses the exchange.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

WINDOW = 20
# A part's texts are held by one task at a time: about so many characters, some hundred bytes of memory a word.
PART_CHARS = 8_000_000
# Runs are at least so long on the first level where the window can be halved so far; shorter ones are repeated anywhere.
LEAST_RUN = 8
SEEDS = (42, 7)
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def lengths(window: int) -> list[int]:
    """The lengths of the levels: the window halved while it stays even and long enough, shortest first."""
    out = [window]
    while out[0] % 2 == 0 and out[0] // 2 >= LEAST_RUN:
        out.insert(0, out[0] // 2)
    return out


def _mix(a: np.ndarray, b: np.ndarray, odd: int) -> np.ndarray:
    out = (a ^ (a >> np.uint64(29))) * np.uint64(odd) + (b ^ (b >> np.uint64(32))) * np.uint64(_ODD[2])
    return out ^ (out >> np.uint64(31))


def run_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The hash of every run of ``size`` words, by doubling: a run of 2n words is two runs of n."""
    out, n = words, 1
    for bit in bin(size)[3:]:
        if len(out) <= n:
            return np.empty(0, np.uint64)
        out, n = _mix(out[:-n], out[n:], _ODD[seed]), 2 * n
        if bit == "1":
            if len(words) <= n:
                return np.empty(0, np.uint64)
            out, n = _mix(out[: len(words) - n], words[n:], _ODD[seed]), n + 1
    return out[: max(0, len(words) - size + 1)]


def _slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``width`` neighbours."""
    out, n = values, 1
    while 2 * n <= width:
        out, n = pick(out[:-n], out[n:]), 2 * n
    rest = width - n
    return pick(out[:-rest], out[rest:]) if rest else out


class Part:
    """The words of a part's texts in one row, and what its windows hold."""

    def __init__(self, texts: list[bytes | None], window: int):
        self.window = window
        self.words = [(t or b"").split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.sizes)
        digest = xxhash.xxh64_intdigest
        self.hashed = np.fromiter((digest(w, SEEDS[0]) for found in self.words for w in found), np.uint64, int(self.sizes.sum()))
        # Of every word: how many words its text has from there on.
        self.left = np.repeat(self.ends, self.sizes) - np.arange(len(self.hashed))

    def runs(self, size: int, seed: int = 0) -> np.ndarray:
        return run_hashes(self.hashed, size, seed)

    def inside(self, size: int) -> np.ndarray:
        """Which runs lie in one text."""
        return self.left[: max(0, len(self.hashed) - size + 1)] >= size

    def chosen(self, size: int) -> np.ndarray:
        """For every window the smallest hash of its runs of ``size`` words (no sense for windows across texts)."""
        runs = self.runs(size)
        return _slide(runs, self.window - size + 1, np.minimum) if len(self.hashed) >= self.window else runs[:0]

    def seeds(self, size: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen runs of the windows in ``alive``, each once, and whether it is chosen at several places."""
        least = self.chosen(size)
        # A run is chosen if a living window that holds it has its hash as the smallest one.
        width = self.window - size
        low = np.concatenate([np.zeros(width, np.uint64), np.where(alive, least, np.uint64(0)), np.zeros(width, np.uint64)])
        runs = self.runs(size)
        places = _slide(low, width + 1, np.maximum) == runs
        values, counts = np.unique(runs[places], return_counts=True)
        return values, counts > 1

    def windows(self) -> np.ndarray:
        return self.inside(self.window)

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text number, first word's number in its text) of windows."""
        text = np.searchsorted(self.ends, at, side="right")
        return text, at - (self.ends - self.sizes)[text]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _known(values: np.ndarray, sorted_list: np.ndarray) -> np.ndarray:
    if not len(sorted_list):
        return np.zeros(len(values), bool)
    return sorted_list[np.minimum(np.searchsorted(sorted_list, values), len(sorted_list) - 1)] == values


def _texts(table: pa.Table) -> list[bytes | None]:
    return table.column("text").cast(pa.binary()).to_pylist()


def _unsigned(table: pa.Table, name: str) -> np.ndarray:
    return np.ascontiguousarray(table.column(name).to_numpy()).view(np.uint64)


def _level(size: int, before: int | None, window: int):
    """(part, docs, hashes that go on from the level before) -> (hash, part, many): the chosen runs of this level."""

    def run(key, docs: pa.Table, went_on: pa.Table | None) -> pa.Table:
        part = Part(_texts(docs), window)
        alive = part.windows()
        if before is not None and len(alive):
            alive &= _known(part.chosen(before), np.unique(_unsigned(went_on, "hash")))
        values, many = part.seeds(size, alive) if len(alive) else (np.empty(0, np.uint64), np.empty(0, bool))
        return pa.table({"hash": _signed(values), "part": pa.array(np.full(len(values), key[0].as_py(), np.int32)), "many": pa.array(many)})

    return run


def _going_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, hash) of hashes with several places; rows (hash, part, many) come sorted by hash. One row is carried on."""
    last = None  # hash, part, whether it was given out
    for batch in batches:
        if not batch.num_rows:
            continue
        h, part = (batch.column(c).to_numpy() for c in ("hash", "part"))
        many = batch.column("many").to_numpy(zero_copy_only=False)
        same = h[1:] == h[:-1]
        out = many | np.concatenate([[last is not None and last[0] == h[0]], same]) | np.concatenate([same, [False]])
        if last is not None and last[0] == h[0] and not last[2]:
            yield pa.RecordBatch.from_arrays([pa.array([last[1]], pa.int32()), pa.array([last[0]], pa.int64())], names=["part", "hash"])
        yield pa.RecordBatch.from_arrays([pa.array(part[out]), pa.array(h[out])], names=["part", "hash"])
        last = (int(h[-1]), int(part[-1]), bool(out[-1]))


def _candidates(before: int | None, window: int):
    """(part, docs, hashes that go on) -> the whole windows that are left: one row a hash, at its first place in the part."""

    def run(key, docs: pa.Table, went_on: pa.Table | None) -> pa.Table:
        part = Part(_texts(docs), window)
        alive = part.windows()
        if before is not None and len(alive):
            alive &= _known(part.chosen(before), np.unique(_unsigned(went_on, "hash")))
        at = np.nonzero(alive)[0]
        text, start = part.place(at)
        ids = docs.column("doc_id")
        missing = ids.is_null().to_numpy()[text] if len(at) else np.empty(0, bool)
        doc = ids.fill_null(0).to_numpy()[text] if len(at) else np.empty(0, np.int64)
        h, other = part.runs(window)[at], (part.runs(window, 1)[at] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((start, doc, missing, other, h))
        h, other, doc, missing, start = (x[order] for x in (h, other, doc, missing, start))
        first = np.nonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (other[1:] != other[:-1])]))[0] if len(h) else order
        n = np.diff(np.append(first, len(h)))
        return pa.table({
            "hash": _signed(h[first]), "other": pa.array(other[first].view(np.int32)), "missing": pa.array(missing[first]), "doc": pa.array(doc[first]),
            "start": pa.array(start[first].astype(np.int32)), "part": pa.array(np.full(len(first), key[0].as_py(), np.int32)), "many": pa.array(n > 1),
        })

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each part must know of its windows; rows come sorted by hash, other, missing, doc, start.

    A part that does not hold a window's first place removes all its places (``first`` is false); one that does, and has
    the window several times, removes all but the first. Windows are told apart by 96 bits of hash here; inside a part, which
    looks its few million windows up in its own list, 64 bits do.
    """
    names = ("hash", "other", "missing", "doc", "start")
    lead = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if lead is not None:
            now = [np.concatenate([[a], x]).astype(x.dtype) for a, x in zip(lead, now)]
        new = np.concatenate([[True], (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])])
        at = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        first = np.logical_and.reduce([x == x[at] for x in now[2:]])
        lead = [x[at[-1]] for x in now]
        skip = len(new) - batch.num_rows
        first = first[skip:]
        out = ~first | batch.column("many").to_numpy(zero_copy_only=False)
        missing, doc, start = (np.where(first, x[skip:], 0).astype(x.dtype)[out] for x in now[2:])
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(pa.array(out)) for c in ("part", "hash")] + [pa.array(x) for x in (missing, doc, start, first[out])],
            names=["part", "hash", "missing", "doc", "start", "first"],
        )


def _removed(window: int):
    """(part, docs, what it must know) -> (doc_id, text, n_words, n_removed)."""

    def run(key, docs: pa.Table, known: pa.Table) -> pa.Table:
        part = Part(_texts(docs), window)
        listed = _unsigned(known, "hash")
        gone = np.zeros(len(part.hashed), bool)
        if len(listed) and len(gone) >= window:
            order = np.argsort(listed)
            h = part.runs(window)
            to = order[np.minimum(np.searchsorted(listed, h, sorter=order), len(order) - 1)]
            at = np.nonzero(part.windows() & (listed[to] == h))[0]
            to = to[at]
            text, start = part.place(at)
            ids = docs.column("doc_id")
            here = (known.column("missing").to_numpy()[to] == ids.is_null().to_numpy()[text]) & (known.column("doc").to_numpy()[to] == ids.fill_null(0).to_numpy()[text])
            here &= known.column("start").to_numpy()[to] == start
            at = at[~(known.column("first").to_numpy()[to] & here)]
            cover = np.zeros(len(gone) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + window, -1)
            gone = np.cumsum(cover)[:-1] > 0
        texts, counts, begin = [], [], 0
        for found in part.words:
            mine = gone[begin : begin + len(found)]
            begin += len(found)
            n = int(mine.sum())
            counts.append(n)
            texts.append(b" ".join(found if not n else [w for w, g in zip(found, mine.tolist()) if not g]))
        return pa.table({
            "doc_id": docs.column("doc_id"), "text": pa.array(texts, pa.binary()).cast(pa.string()),
            "n_words": pa.array(part.sizes), "n_removed": pa.array(counts, pa.int64()),
        })

    return run


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_words, n_removed): every row of ``docs`` (doc_id, text) without its repeated passages.

    A word goes if a window of ``window`` words covers it whose words also start at an earlier place, that is in a smaller
    doc_id or earlier in the same one. ``text`` is the kept words, joined by one space. Null and empty texts have no words.
    Null doc_ids come after all others and are one document. Rows of equal doc_id are one document too: repeated rows
    have the same places and do not remove each other's words. Texts shorter than a window stay. Extra columns go.
    An empty table gives an empty one.
    """
    if window < 1:
        raise ValueError("a window needs a word")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(chars / PART_CHARS))
    dealt = source.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))

    def with_list(run, went_on: DataFrame | None, schema: str) -> DataFrame:
        if went_on is None:
            return dealt.groupBy("part").applyInArrow(lambda key, table: run(key, table, None), schema)
        return dealt.groupBy("part").cogroup(went_on.groupBy("part")).applyInArrow(run, schema)

    went_on, before = None, None
    for size in lengths(window)[:-1]:
        found = with_list(_level(size, before, window), went_on, "hash long, part int, many boolean")
        went_on = found.repartition("hash").sortWithinPartitions("hash").mapInArrow(_going_on, "part int, hash long")
        before = size
    found = with_list(
        _candidates(before, window), went_on, "hash long, other int, missing boolean, doc long, start int, part int, many boolean"
    )
    known = found.repartition("hash").sortWithinPartitions("hash", "other", "missing", "doc", "start").mapInArrow(
        _repeated, "part int, hash long, missing boolean, doc long, start int, first boolean"
    )
    return with_list(_removed(window), known, "doc_id long, text string, n_words long, n_removed long")
