"""Phrases whose words stand together more often than apart, by best-first growth with bounds from prefix counts.

A phrase of ``a`` occurrences scores ``SCALE * a / (l + r)`` at its weakest cut into a first part (``l``) and a rest (``r``).
Whatever a phrase p is grown into has at most f(p) occurrences, its first word stays f(first) and the rest is at least as
frequent as the whole: so ``SCALE * f(p) / (f(first) + f(p))`` bounds the scores of p and of all that p is grown into.

Words and pairs are counted first. Then the pairs whose bound reaches a limit are expanded: one scan counts the triples,
another the quadruples that hold an expanded pair. That gives true scores and containers of every phrase that can score the
limit or more. A language with enough surviving phrases at or above its limit is settled, as nothing below the limit can
matter; for the others the limit falls, in the end to zero, where everything is expanded.

Counting scans combine within a task and send one row per phrase. What a scan may leave out is told by bit filters of a
fixed size: a wrong bit costs a count that is not needed and never a result, as every phrase counted is counted in full.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from modelmon.llm.common import fixed

SCALE = 2_000_000
LEAST = 30
TOP = 2000
# A phrase goes if a longer one that holds it has at least so many hundredths of its occurrences.
INSIDE = 80
NO_LANGUAGE = "und"
# Pairs per language whose scores set the first limit; four times as many on each further round.
FRONTIER = 2 * TOP
# Words of a task counted at once, and the bits of a filter (8 MB).
CHUNK_WORDS = 4_000_000
FILTER_BITS = 1 << 26
SEED = 42
# A phrase's hash is its words' hashes, turned by so many bits.
TURNS = (0, 17, 31)
BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text in lower case (A-Z only), with ``.`` where a piece ends."""
    return BREAK.sub(b" . ", (text or b"").lower()).split()


def _turn(h: np.ndarray, by: int) -> np.ndarray:
    return (h << np.uint64(by)) | (h >> np.uint64(64 - by)) if by else h


class Filter:
    """A set of hashes in a fixed number of bits: never denies a member."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = (h >> np.uint64(6)) & np.uint64(len(self.bits) - 1)
        return (self.bits[at] >> (h & np.uint64(63))) & np.uint64(1) > 0


def _hash(words: Column, size: int) -> Column:
    out = None
    for k in range(size):
        h = F.xxhash64(words[k])
        if TURNS[k]:
            h = F.shiftleft(h, TURNS[k]).bitwiseOR(F.shiftrightunsigned(h, 64 - TURNS[k]))
        out = h if out is None else out.bitwiseXOR(h)
    return out


def phrase_filter(phrases: DataFrame, size: int) -> Filter:
    """The filter of ``phrase`` (of ``size`` words). At most FILTER_BITS / 64 rows reach the driver."""
    slots = FILTER_BITS // 64
    bits = (
        phrases.select(_hash(F.split("phrase", " "), size).alias("h"))
        .select(F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(slots - 1)).alias("slot"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
        .groupBy("slot").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    out = np.zeros(slots, np.uint64)
    out[bits["slot"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64).view(np.uint64)
    return Filter(out)


class Chunk:
    """Words of some texts as numbers of this chunk, by language; number 0 is a piece's end."""

    def __init__(self):
        self.ids: dict[bytes, int] = {b".": 0}
        self.rows: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, text: bytes | None) -> None:
        ids, found = self.ids, tokens(text)
        row = np.zeros(len(found) + 1, np.int32)
        row[:-1] = [ids.setdefault(w, len(ids)) for w in found]
        self.rows.setdefault(lang, []).append(row)
        self.size += len(row)

    def counts(self, size: int, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, n) of the phrases whose starts ``wanted(numbers, word hashes)`` tells; words also with phrase null, for all."""
        words = list(self.ids)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
        for lang, rows in self.rows.items():
            x = np.concatenate(rows)
            at = np.nonzero(wanted(x, hashes))[0]
            code = x[at].astype(np.int64)
            for k in range(1, size):
                if k > 1:
                    code = np.unique(code, return_inverse=True)[1]
                code = code << 32 | x[at + k]
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            begin = at[first]
            found = [b" ".join([words[i] for i in row]) for row in np.stack([x[begin + k] for k in range(size)], axis=1).tolist()]
            total = [int((x > 0).sum())] if size == 1 else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(found) + len(total)), pa.string()), pa.array(found + [None] * len(total), pa.binary()).cast(pa.string()), pa.array(np.append(n, total).astype(np.int64))],
                names=["lang", "phrase", "n"],
            )


def wanted_words(x, hashes):
    return x > 0


def wanted_pairs(frequent: Filter):
    def run(x, hashes):
        often = frequent(hashes)
        often[0] = False
        mine = often[x]
        return mine[:-1] & mine[1:]

    return run


def _pairs(x: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the pair from every word on, and whether it lies in a piece."""
    h = hashes[x]
    return h[:-1] ^ _turn(h[1:], TURNS[1]), (x[:-1] > 0) & (x[1:] > 0)


def wanted_triples(pairs: Filter, expanded: Filter, seconds: Filter):
    """Triples of frequent pairs that hold an expanded pair, or that can be the rest of a quadruple that starts with one."""

    def run(x, hashes):
        h, inside = _pairs(x, hashes)
        good = inside & pairs(h)
        grown = good & expanded(h)
        return good[:-1] & good[1:] & (grown[:-1] | grown[1:] | seconds(hashes)[x][:-2])

    return run


def wanted_quadruples(pairs: Filter, expanded: Filter, triples: Filter):
    """Quadruples that hold an expanded pair and whose triples are frequent, as far as these were counted."""

    def run(x, hashes):
        h, inside = _pairs(x, hashes)
        good = inside & pairs(h)
        grown = good & expanded(h)
        three = good[:-1] & good[1:] & triples(h[:-1] ^ _turn(hashes[x], TURNS[2])[2:])
        a, b, c = grown[:-2], grown[1:-1], grown[2:]
        return good[:-2] & three[1:] & (a | b | c) & (three[:-1] | ~(a | b))

    return run


def _count(docs: DataFrame, size: int, make: Callable, filters: list[Filter]) -> DataFrame:
    """(lang, phrase, n): wanted phrases of ``size`` words with LEAST or more occurrences; for words also the totals (phrase null)."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast([f.bits for f in filters])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = make(*map(Filter, shared.value)) if shared.value else make
        chunk = Chunk()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                chunk.add(lang, text)
                if chunk.size >= CHUNK_WORDS:
                    yield from chunk.counts(size, wanted)
                    chunk = Chunk()
        yield from chunk.counts(size, wanted)

    found = docs.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    out = fixed(found.where((F.col("n") >= LEAST) | F.col("phrase").isNull()), f"phrases-{size}")
    shared.destroy()
    return out


def _ratio(a: str, b: str) -> Column:
    """SCALE * a / b, floored, in decimals of 38 digits."""
    return F.expr(f"(cast({SCALE} as decimal(10,0)) * cast({a} as decimal(20,0))) div cast({b} as decimal(21,0))")


def scored(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of (lang, phrase, n): the weakest cut, of equal ones the first; parts are looked up in ``known``."""
    words = F.split("phrase", " ")
    cut = phrases.select("lang", "phrase", F.col("n").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("left"), F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("rest")
    )
    whole = (
        cut.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
        .join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
        .withColumn("score", _ratio("a", "l + r"))
    )
    weakest = whole.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("m"))
    return weakest.select("lang", "phrase", "m.a", "m.l", "m.r", "m.score")


def _limits(pairs: DataFrame, number: int) -> DataFrame:
    """(lang, least): a limit that about ``number`` pairs of a language score; 0 if it has no more. A thousand rows a language are ranked."""
    steps = pairs.groupBy("lang", F.expr("score div 1000").alias("step")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("lang").orderBy(F.desc("step")))
    return steps.select("lang", "step", upto.alias("upto")).groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("upto") > number, F.col("step") * 1000)), F.lit(0)).alias("least")
    )


def _containers(longer: DataFrame) -> DataFrame:
    """(lang, phrase, most): the most occurrences of a counted phrase that holds this one."""
    w = F.split("phrase", " ")
    parts = F.flatten(
        F.transform(F.sequence(F.lit(2), F.size(w) - 1), lambda n: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " ")))
    )
    return longer.select("lang", F.explode(parts).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to 4 words of ``docs`` (text, lang).

    Order: score, then occurrences ``a``, both descending, then the phrase in byte order. ``n`` counts the language's words.
    Candidates have 30 or more occurrences; one goes if a longer candidate that holds it has 80 hundredths of its occurrences.
    Null texts are empty, a null language is ``und``. Repeated rows count as often as they stand. Ties are all compared, so
    the last rank is the same on every run. Texts of any length are read whole; extra columns are ignored. A language
    without a candidate has no row, an empty table gives an empty one.
    """
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col("text").cast("string").alias("text"))
    words = _count(source, 1, wanted_words, [])
    totals = words.where("phrase IS NULL").select("lang", F.col("n").alias("words"))
    words = words.where("phrase IS NOT NULL")
    pairs = _count(source, 2, wanted_pairs, [phrase_filter(words, 1)])
    first = words.select("lang", F.col("phrase").alias("first"), F.col("n").alias("head"))
    pairs_scored = fixed(
        scored(pairs, words).withColumn("first", F.split("phrase", " ")[0]).join(first, ["lang", "first"]).withColumn("bound", _ratio("a", "head + a")).drop("first", "head"),
        "pairs",
    )
    pair_filter = phrase_filter(pairs, 2)
    left, done, number = pairs_scored, None, FRONTIER
    while True:
        limits = fixed(_limits(left, number), "limits")
        expanded = fixed(left.join(limits, "lang").where("bound >= least"), "expanded")
        grown = phrase_filter(expanded, 2)
        seconds = phrase_filter(expanded.select(F.split("phrase", " ")[1].alias("phrase")).distinct(), 1)
        three = _count(source, 3, wanted_triples, [pair_filter, grown, seconds])
        four = _count(source, 4, wanted_quadruples, [pair_filter, grown, phrase_filter(three, 3)])
        # All parts of phrases that start with an expanded pair are known; others can only be containers.
        head = F.array_join(F.slice(F.split("phrase", " "), 1, 2), " ")
        longer = three.unionByName(four).withColumn("head", head).join(
            expanded.select("lang", F.col("phrase").alias("head"), "least"), ["lang", "head"]
        )
        candidates = scored(longer, words.unionByName(pairs).unionByName(three)).join(limits, "lang").unionByName(
            expanded.select("lang", "phrase", "a", "l", "r", "score", "least")
        ).where("score >= least")
        kept = candidates.join(_containers(three.unionByName(four)), ["lang", "phrase"], "left").where(
            f"most IS NULL OR 100 * most < {INSIDE} * a"
        )
        kept = fixed(kept.drop("most"), "survivors")
        enough = kept.groupBy("lang").count().where(F.col("count") >= top).select("lang")
        settled = fixed(limits.where("least = 0").select("lang").unionByName(enough).distinct(), "settled")
        now = kept.join(settled, "lang", "left_semi")
        done = now if done is None else done.unionByName(now)
        left = left.join(settled, "lang", "left_anti")
        if left.isEmpty():
            break
        number *= 4
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return done.withColumn("rank", rank).where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score"
    )
