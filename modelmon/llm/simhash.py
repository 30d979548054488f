"""Near copies by SimHash: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint has eight blocks of eight bits. Two fingerprints at ``DISTANCE`` (2) or fewer differing bits differ in at
most two blocks, so they agree on all bits outside some pair of blocks: each fingerprint is filed under the 28 keys that
leave out one pair. A key fixes 48 bits, so a bucket of distinct fingerprints holds 65,536 of them at the very most,
whatever the table. Exact copies are folded into one fingerprint before any of this, and a bucket gives at most one link
per member (to the lowest member it reaches), never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from modelmon.llm.common import fixed, unpack, whole
from modelmon.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCK_BITS = 8
BLOCKS = 64 // BLOCK_BITS
# Shingles whose bits are counted at once (64 bytes each).
COUNT_ROWS = 1 << 15
# Up to this size a bucket's members are compared directly, beyond it by looking up each member's neighbours.
DIRECT = 256


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text: bit i is set if it is set in over half the shingle hashes. No words: 0."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    if len(found) < size:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    digest = xxhash.xxh64_intdigest
    shingles = zip(*(found[i:] for i in range(size)))
    hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), COUNT_ROWS):
        part = hashes[at : at + COUNT_ROWS]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(keys_and_text: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., fp): the fingerprint of the column ``text`` of each row, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            values = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(values)], names=[*keys, "fp"])

    source = keys_and_text.select(*keys, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keys)
    return source.mapInArrow(run, f"{kinds}, fp long")


def _block_keys(fp: Column) -> Column:
    keys = []
    for n, pair in enumerate(combinations(range(BLOCKS), DISTANCE)):
        left_out = sum(((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * b) for b in pair)
        kept = ~left_out & ((1 << 64) - 1)
        signed = kept - (1 << 64) if kept >> 63 else kept
        keys.append(F.struct(F.lit(n).alias("blocks"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("bits")))
    return F.array(*keys)


def _reach(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the members (sorted, distinct, unsigned) within DISTANCE bits of each other."""
    if len(members) <= DIRECT:
        near = np.bitwise_count(members[:, None] ^ members[None, :]) <= DISTANCE
        return np.nonzero(np.triu(near, 1))
    free = int(np.bitwise_or.reduce(members ^ members[0]))
    bits = [np.uint64(1 << i) for i in range(64) if free >> i & 1]
    left, right = [], []
    for size in range(1, DISTANCE + 1):
        for some in combinations(bits, size):
            wanted = members ^ np.bitwise_or.reduce(np.array(some, dtype=np.uint64))
            at = np.minimum(np.searchsorted(members, wanted), len(members) - 1)
            hit = np.nonzero(members[at] == wanted)[0]
            left.append(hit)
            right.append(at[hit])
    return np.concatenate(left), np.concatenate(right)


def bucket_links(members: np.ndarray) -> np.ndarray:
    """(lowest reachable member, member) for the members of one bucket that are linked: at most one link a member."""
    i, j = _reach(members)
    label = np.arange(len(members))
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.nonzero(label != np.arange(len(members)))[0]
    return np.column_stack([members[label[moved]], members[moved]])


def _scan_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal (blocks, bits); rows come sorted by blocks, bits, fp. Only the last run is carried on."""
    kept: list[np.ndarray] | None = None

    def links(b: np.ndarray, k: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        start = np.nonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (k[1:] != k[:-1])]))[0]
        size = np.diff(np.append(start, len(b)))
        unsigned = fp.view(np.uint64)
        two = start[size == 2]
        two = two[np.bitwise_count(unsigned[two] ^ unsigned[two + 1]) <= DISTANCE]
        out = [np.column_stack([unsigned[two], unsigned[two + 1]])]
        for s, n in zip(start[size > 2], size[size > 2]):
            out.append(bucket_links(np.sort(unsigned[s : s + n])))
        pairs = np.concatenate(out)
        if not len(pairs):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, c]).view(np.int64)) for c in (0, 1)], names=["a", "b"]
        )

    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("blocks", "bits", "fp")]
        if not len(now[0]):
            continue
        if kept is not None:
            now = [np.concatenate([x, y]) for x, y in zip(kept, now)]
        b, k, _ = now
        other = np.nonzero((b != b[-1]) | (k != k[-1]))[0]
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut and (found := links(*(x[:cut] for x in now))) is not None:
            yield found
        kept = [x[cut:].copy() for x in now]
    if kept is not None and (found := links(*kept)) is not None:
        yield found


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect every two of the distinct fingerprints ``fp`` within DISTANCE bits, each verified."""
    filed = distinct.select("fp", F.explode(_block_keys(F.col("fp"))).alias("k")).select("k.blocks", "k.bits", "fp")
    return (
        filed.repartition("blocks", "bits").sortWithinPartitions("blocks", "bits", "fp").mapInArrow(_scan_buckets, "a long, b long")
    )


def classes(hashed: DataFrame) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of (doc_id, fp): the class and its smallest doc_id (nulls ignored)."""
    distinct = fixed(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(distinct)).withColumnRenamed("node", "fp")
    rooted = fixed(distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs`` (doc_id, text).

    Links join fingerprints at 2 or fewer differing bits; component_id is the smallest doc_id reachable.
    Null, empty and blank texts have fingerprint zero and link like any other. Repeated rows come out repeated. A null
    doc_id keeps its row and never is a component's smallest id unless the class has no other. Extra columns are ignored.
    """
    hashed = fixed(fingerprints(docs.select("doc_id", "text"), ["doc_id"]), "hashed")
    return hashed.join(classes(hashed), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row of each class left: that with the smallest doc_id (ties: any one of equal ids)."""
    table = whole(docs)
    hashed = fixed(
        fingerprints(table.select("row", F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text")), ["row", "doc_id"]), "hashed"
    )
    # Equal fingerprints are combined before the join, so a text that a third of the rows hold is one row of it.
    first = hashed.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("n"), "doc_id", "row")).alias("first"))
    kept = (
        first.join(classes(hashed).select("fp", "root"), "fp")
        .groupBy("root").agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("row"))
    )
    return unpack(table.join(kept, "row", "left_semi"), docs.columns)
