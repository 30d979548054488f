"""Near copies by SimHash, checked by the Jaccard similarity of word shingles: every pair at or above the limit is found.

Operator 3 comes first: the fingerprint of every text and the classes that ``simhash.classes`` makes of them. Each set of a
class is compared with the class's first one, so a link holds by the sets and never by the fingerprints alone. Fingerprints of
similar texts often differ in more bits than the operator allows, so an exact search finds the pairs that its classes leave
apart, and looks at no others.

A text is the set of the hashes of its ``SHINGLE``-word runs (lower case). Two sets with similarity ``SIMILARITY`` or more
share one of their first ``n - ceil(SIMILARITY * n) + 1`` members in any order that is the same for all texts (prefix
filter), so each text is filed under those members only. The order puts the members that many texts hold last; which ones
these are is only estimated, as the order changes the cost and never the result. Texts that share a key and whose sizes and
places in the order leave the similarity possible are candidates, and each candidate is verified on the whole sets.

A key that a family of near copies holds gives a star first (each member with the first one, unless the classes have joined
them). What classes and stars left apart is compared within the key by sketches: parities of ``SKETCH`` classes of members, of
which two sets differ in at most as many as they have members that only one of them holds. In rounds, each set asks for the
nearest set of another class only, so a family grows together by as many rows as it has sets; all remaining pairs that their
sketches leave possible are asked for last, when few are left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from modelmon.functions.sizes import bounded
from modelmon.llm import simhash
from modelmon.llm.common import fixed, numbered, passing_tables, unpack
from modelmon.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
# Hashes gathered before common ones are counted, the count that makes one common there, and how many are told or kept.
COUNTED = 1 << 22
COMMON_FROM = 4
TOLD, KEPT = 20_000, 1_000_000
# Rows of an Arrow batch that holds two sets a row.
PAIR_ROWS = 64
# Bits of a sketch, and pairs of a key that are compared at once.
SKETCH, COMPARED = 1024, 1 << 14
# Nearest sets are asked for again while a round links more than this share of the sets; it changes the cost, never the result.
AGAIN = 0.25
_ODD = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 17)]


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a UTF-8 text's shingles; a text with fewer words is one shingle, one without words has none."""
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(found) < size:
        return np.array([digest(b" ".join(found), SEED)], np.uint64)
    words = np.fromiter((digest(w, SEED) for w in found), np.uint64, len(found))
    n = len(found) - size + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(_ODD[1]) + words[k : k + n] * np.uint64(_ODD[0])
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def least_shared(n: int | np.ndarray, m: int | np.ndarray, similarity: float):
    """Members that sets of n and m members must share at least."""
    return np.ceil(similarity / (1 + similarity) * (n + m) - 1e-9)


def prefix(members: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first members in the common order of which similar sets must share one."""
    n = len(members)
    if not n:
        return members
    times = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, members), len(common) - 1)
        times = np.where(common[at] == members, counts[at], 0)
    order = np.lexsort((members, times))
    return members[order[: n - math.ceil(similarity * n - 1e-9) + 1]]


def possible(n: np.ndarray, place: np.ndarray, m: np.ndarray, other: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs (n members, shared one at place; m, other) can be similar if this is the first member that they share."""
    return np.minimum(n - place, m - other) >= least_shared(n, m, similarity)


def sketch(members: np.ndarray) -> bytes:
    """For each class of the members modulo ``SKETCH`` whether their number is odd."""
    odd = np.bincount((members % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _hashed(table: DataFrame, size: int) -> DataFrame:
    """(row, doc_id, same, fp, bits) per row and, in rows without these, (h, c): hashes that many texts hold and about how often.

    Equal sets have equal ``same``, and all texts without words have zero; ``fp`` is the fingerprint of operator 3, ``bits`` the sketch. Exact copies in a task count once for ``c``.
    """
    source = table.select("row", F.col("d.doc_id").alias("doc_id"), F.col("d.text").cast("string").alias("text"))
    kinds = {c: source.schema[c].dataType.simpleString() for c in ("row", "doc_id")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, seen, types = [], 0, set(), None
        names, lists = ["row", "doc_id", "same", "fp", "bits", "h", "c"], pa.list_(pa.int64())

        def told() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = np.nonzero(counts >= COMMON_FROM)[0]
            often = often[np.argsort(-counts[often], kind="stable")[:TOLD]]
            both = [pa.array([x], lists) for x in (values[often].view(np.int64), counts[often].astype(np.int64))]
            return pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in types), *both], names=names)

        for batch in batches:
            types = [*(batch.column(c).type for c in ("row", "doc_id")), pa.int64(), pa.int64(), pa.binary()]
            same, prints, bits = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                members = shingles(text, size)
                same.append(_name(members))
                prints.append(simhash.fingerprint(text))
                bits.append(sketch(members))
                if same[-1] not in seen:
                    seen.add(same[-1])
                    held.append(members)
                    n += len(members)
            nothing = pa.nulls(batch.num_rows, lists)
            both = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (same, prints)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *both, pa.array(bits, pa.binary()), nothing, nothing], names=names)
            if n >= COUNTED:
                yield told()
                held, n = [], 0
        if n:
            yield told()

    return fixed(source.mapInArrow(run, f"row {kinds['row']}, doc_id {kinds['doc_id']}, same long, fp long, bits binary, h array<long>, c array<long>"), "hashed")


def _common(hashed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that most texts hold, sorted, and about how often."""
    found = hashed.where("h IS NOT NULL").select(F.explode(F.arrays_zip("h", "c")).alias("x")).select("x.h", "x.c")
    top = found.groupBy("h").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "h").limit(KEPT).toPandas()
    values, counts = top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    order = np.argsort(values)
    return values[order], counts[order]


def _name(members: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(members.tobytes(), SEED) if len(members) else 0


def _filed(table: DataFrame, common: tuple[np.ndarray, np.ndarray], size: int, similarity: float) -> DataFrame:
    """(key, same, n, place): each set under its prefix; of exact copies within a task only the first is filed."""
    shared = table.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = shared.value
        seen = set()
        for batch in batches:
            keys, names, sizes, places = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                if (copy := xxhash.xxh64_intdigest(text or b"")) in seen:
                    continue
                seen.add(copy)
                members = shingles(text, size)
                first = prefix(members, common, counts, similarity)
                keys.append(first)
                names.append(np.full(len(first), _name(members), np.uint64))
                sizes.append(np.full(len(first), len(members), np.int32))
                places.append(np.arange(len(first), dtype=np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.concatenate(x).view(np.int64)) for x in (keys, names)), *(pa.array(np.concatenate(x)) for x in (sizes, places))],
                    names=["key", "same", "n", "place"],
                )

    source = table.select(F.col("d.text").cast("string").alias("text"))
    return source.mapInArrow(run, "key long, same long, n int, place int")


def _under_first(similarity: float):
    """Each set of a key but the first, with that first one as ``lead`` where the two can be similar, else null.

    Rows come sorted by key and set. Repeated rows go, and so do keys that one set holds alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, same, n, place = (batch.column(c).to_numpy() for c in ("key", "same", "n", "place"))
            if carried is not None:
                # The first of the running key, then the row before this batch.
                key, same, n, place = (np.concatenate([[a, b], x]) for a, b, x in zip(*carried, (key, same, n, place)))
            new = np.concatenate([[True], key[1:] != key[:-1]])
            lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            out = np.concatenate([[False], (key[1:] == key[:-1]) & (same[1:] != same[:-1])])
            if carried is not None:
                out[:2] = False
            at, to = np.nonzero(out)[0], lead[out]
            unlike = ~possible(n[at], place[at], n[to], place[to], similarity)
            columns = [pa.array(x[at]) for x in (key, same, n, place)] + [pa.array(same[to], mask=unlike)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "same", "n", "place", "lead"])
            carried = [[x[lead[-1]] for x in (key, same, n, place)], [x[-1] for x in (key, same, n, place)]]

    return run


def _by_key(columns: list[str], work):
    """``work`` on the arrays of each key that more than one row has; rows come sorted by key. Only the last key is carried on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None

        def each(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key = rows[0]
            start = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
            size = np.diff(np.append(start, len(key)))
            for s, k in zip(start[size > 1], size[size > 1]):
                yield from work(*(x[s : s + k] for x in rows))

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [_array(batch.column(c)) for c in columns]
            if kept is not None:
                now = [np.concatenate([x, y]) for x, y in zip(kept, now)]
            other = np.nonzero(now[0] != now[0][-1])[0]
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from each([x[:cut] for x in now])
            kept = [x[cut:].copy() for x in now]
        if kept is not None:
            yield from each(kept)

    return run


def _array(column: pa.Array) -> np.ndarray:
    if pa.types.is_integer(column.type):
        return column.to_numpy()
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _possible_pairs(n: np.ndarray, place: np.ndarray, root: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (both ways round) of the sets of a key that can be similar and have different roots; all of one set at once."""
    if (root == root[0]).all():
        return
    step = max(1, COMPARED // len(n))
    for s in range(0, len(n), step):
        e = s + step
        ok = (root[s:e, None] != root) & possible(n[s:e, None], place[s:e, None], n, place, similarity)
        at, to = np.nonzero(ok)
        if len(at):
            yield at + s, to


def _open(similarity: float):
    """The sets of each key that can be similar to a set of it with another root."""

    def work(key, same, n, place, root) -> Iterator[pa.RecordBatch]:
        some = [np.unique(at) for at, _ in _possible_pairs(n, place, root, similarity)]
        if some:
            at = np.concatenate(some)
            yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (key, same, n, place)], names=["key", "same", "n", "place"])

    return _by_key(["key", "same", "n", "place", "root"], work)


def _apart(similarity: float, nearest: bool):
    """Pairs of the sets of a key that have different roots and can be similar by their sketches.

    ``nearest``: of each set's pairs only the one whose sketches differ least.
    """

    def work(key, same, n, place, root, bits) -> Iterator[pa.RecordBatch]:
        for at, to in _possible_pairs(n, place, root, similarity):
            if not nearest:
                at, to = at[at < to], to[at < to]
            differ = np.concatenate(
                [np.bitwise_count(bits[at[i : i + COMPARED]] ^ bits[to[i : i + COMPARED]]).sum(axis=1, dtype=np.int64) for i in range(0, len(at), COMPARED)]
                or [np.empty(0, np.int64)]
            )
            both = n[at].astype(np.int64) + n[to]
            good = np.nonzero(differ <= both - 2 * least_shared(n[at].astype(np.int64), n[to], similarity))[0]
            if nearest:
                good = good[np.lexsort((same[to[good]], differ[good] / both[good], at[good]))]
                good = good[np.unique(at[good], return_index=True)[1]]
            if len(good):
                a, b = same[at[good]], same[to[good]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return _by_key(["key", "same", "n", "place", "root", "bits"], work)


def _verified(pairs: DataFrame, table: DataFrame, first: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar.

    Texts move and not sets: they are shorter and compress. Rows come by ``a``, so its set is made once.
    """
    pairs = fixed(pairs.distinct(), "candidates")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, None
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            left, right = (batch.column(c).cast(pa.binary()) for c in ("x", "y"))
            for i, a in enumerate(batch.column("a").to_pylist()):
                if a != last:
                    last, x = a, shingles(left[i].as_py(), size)
                y = shingles(right[i].as_py(), size)
                good[i] = len(np.intersect1d(x, y, assume_unique=True)) >= least_shared(len(x), len(y), similarity)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    asked = pairs.select(F.col("a").alias("same")).unionByName(pairs.select(F.col("b").alias("same"))).distinct()
    rows = bounded(fixed(first.join(asked, "same").select("same", F.col("first.row").alias("row")), "asked"))
    texts = table.select("row", F.col("d.text").cast("string").alias("text")).join(rows, "row").select("same", "text")
    both = pairs.join(texts.toDF("b", "y"), "b").join(texts.toDF("a", "x"), "a").select("a", "b", "x", "y")
    return fixed(both.mapInArrow(check, "a long, b long"), "similar", PAIR_ROWS)


def keep_one(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, stored: bool = False) -> DataFrame:
    """The rows of ``docs`` with one row of each class left: that with the smallest doc_id (ties: any one of equal ids).

    A class is what chains of pairs with a Jaccard similarity of ``similarity`` or more over ``size``-word shingles join.
    Texts without words are one class. A null doc_id stays only if its class has no other. ``stored``: see ``numbered``.
    """
    table = numbered(docs, stored)
    with passing_tables(docs.sparkSession):
        dropped = fixed(_dropped(table, size, similarity), "copies", lasting=True)
    return unpack(table.join(bounded(dropped), "row", "left_anti"), docs.columns)


def _proposed(named: DataFrame) -> DataFrame:
    """(a, b): each set of a class of operator 3 with the class's first set."""
    classes = simhash.classes(named.select("doc_id", "fp")).select("fp", "root")
    sets = fixed(named.select("same", "fp").distinct().join(classes, "fp").select("same", "root").distinct(), "classes")
    several = sets.groupBy("root").agg(F.min("same").alias("a"), F.count("*").alias("n")).where("n > 1")
    return sets.join(bounded(fixed(several.select("root", "a"), "several")), "root").where("same != a").select("a", F.col("same").alias("b"))


def _rooted(sets: DataFrame, roots: DataFrame) -> DataFrame:
    return sets.join(roots, "same", "left").withColumn("root", F.coalesce("root", "same"))


def _sorted_by_key(sets: DataFrame) -> DataFrame:
    return sets.repartition("key").sortWithinPartitions("key")


def _dropped(table: DataFrame, size: int, similarity: float) -> DataFrame:
    """The rows (row) of which a class of near copies has a better one."""
    hashed = _hashed(table, size)
    named = hashed.where("same IS NOT NULL").select("row", "doc_id", "same", "fp")
    # Equal sets are combined before any join, so a text that a third of the rows hold is one row of it.
    first = fixed(named.groupBy("same").agg(F.min(F.struct(F.isnull("doc_id").alias("n"), "doc_id", "row")).alias("first")), "first")
    filed = _filed(table, _common(hashed), size, similarity).repartition("key").sortWithinPartitions("key", "same")
    under = fixed(filed.mapInArrow(_under_first(similarity), "key long, same long, n int, place int, lead long"), "keys", 1 << 16)
    links = _verified(_proposed(named), table, first, size, similarity)
    roots = bounded(components(links))
    stars = under.where("lead IS NOT NULL").select(F.col("lead").alias("a"), F.col("same").alias("b")).distinct()
    stars = stars.join(roots.toDF("a", "x"), "a", "left").join(roots.toDF("b", "y"), "b", "left")
    stars = stars.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")
    links = links.unionByName(_verified(stars, table, first, size, similarity))
    # What classes and stars left apart.
    roots = components(links).withColumnRenamed("node", "same")
    rest = _sorted_by_key(_rooted(under.select("key", "same", "n", "place"), roots)).mapInArrow(_open(similarity), "key long, same long, n int, place int")
    rest = fixed(rest, "open", 1 << 16)
    asked = bounded(fixed(first.join(rest.select("same").distinct(), "same").select(F.col("first.row").alias("row")), "asked"))
    sketches = fixed(hashed.join(asked, "row").select("same", "bits"), "sketches")
    left, sets = rest.join(sketches, "same"), sketches.count()
    for nearest in (True, False):
        again = True
        while again:
            pairs = _sorted_by_key(_rooted(left, roots)).mapInArrow(_apart(similarity, nearest), "a long, b long")
            found = _verified(pairs, table, first, size, similarity)
            links = links.unionByName(found)
            roots = components(links).withColumnRenamed("node", "same")
            again = nearest and found.count() > AGAIN * sets
    kept = fixed(
        first.join(roots, "same", "left").groupBy(F.coalesce("root", "same").alias("root")).agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("row")),
        "kept",
    )
    return named.select("row").join(kept, "row", "left_anti")
