"""Hard negatives by exact integer scores, computed the Four-Russians way.

Components become whole numbers, and a row is packed as bit planes: one byte for eight dimensions of one bit. For an anchor
and a group of eight dimensions a table of 256 sums holds what every byte of such a plane adds, so a score is, plane by
plane from the sign down, twice what was there plus one looked-up sum per group. Nothing is estimated.

Rows are dealt to parts of a bounded size and every anchor visits every part: a part's packed rows come first and stay,
anchors stream past in blocks. A part answers with its best few rows per anchor, so what is gathered for an anchor is a few
rows per part. Anchors are a fixed share of the table, and only their packed form is copied to the parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from modelmon.llm.common import fixed

SCALE = 256
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 50, 95
# Rows of a part, and anchors scored at once: 65,536 x 32 scores are 16 MB.
PART_ROWS = 1 << 16
ANCHOR_ROWS = 32
# Rows looked up at once.
LOOK_ROWS = 4096
GROUP = 8
# Whole numbers beyond this do not fit the planes.
LARGEST = float(1 << 62)
_OUT = np.iinfo(np.int64).min


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """(rows, planes, groups) bytes of whole numbers (rows, dimensions), lowest plane first, the last one the sign."""
    rows, size = values.shape
    groups = max(1, math.ceil(size / GROUP))
    padded = np.zeros((rows, groups * GROUP), np.int64)
    padded[:, :size] = values
    planes = [np.packbits(((padded >> b) & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(bits)]
    return np.stack(planes, axis=1) if planes else np.zeros((rows, 0, groups), np.uint8)


def unpack_planes(planes: np.ndarray) -> np.ndarray:
    """The whole numbers (rows, dimensions) of (rows, planes, groups) bytes."""
    ones = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weights = np.array([1 << b for b in range(planes.shape[1] - 1)] + [-(1 << (planes.shape[1] - 1))], np.int64)
    return np.einsum("rbd,b->rd", ones, weights)


def tables(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for every byte of a group the sum of the anchor's numbers at its one bits."""
    count, size = anchors.shape
    out = np.zeros((size // GROUP, 1 << GROUP, count), np.int64)
    for j in range(GROUP):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + anchors.T.reshape(-1, GROUP, 1, count)[:, j]
    small = np.abs(anchors).max(initial=0) < (1 << 30) // max(1, size)
    return out.astype(np.int32) if small else out


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors): the inner products. Sums wrap at 64 bits, so a score that fits a long is right."""
    rows, bits, groups = planes.shape
    out = np.empty((rows, sums.shape[2]), np.int64)
    for at in range(0, rows, LOOK_ROWS):
        part = planes[at : at + LOOK_ROWS]
        total = out[at : at + LOOK_ROWS]
        total[:] = 0
        for b in range(bits - 1, -1, -1):
            plane = sums[0][part[:, b, 0]]
            for g in range(1, groups):
                plane += sums[g][part[:, b, g]]
            if b == bits - 1:
                np.negative(plane, out=total)
            else:
                total <<= 1
                total += plane
    return out


def best(found: np.ndarray, tie: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each column's ``number`` highest scores, equal ones by the smaller tie; _OUT never counts."""
    rows = len(found)
    cut = np.partition(found, rows - number, axis=0)[rows - number] if rows > number else np.full(found.shape[1], _OUT)
    row, column = np.nonzero((found >= cut) & (found > _OUT))
    order = np.lexsort((tie[row], -found[row, column], column))
    row, column = row[order], column[order]
    begin = np.searchsorted(column, np.arange(found.shape[1]))
    keep = np.arange(len(column)) - begin[column] < number
    return row[keep], column[keep]


def between(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the highest score of a negative; nothing lies between them where the positive's score is below zero."""
    hundreds, rest = positive // 100, positive % 100
    return hundreds * LEAST - (-rest * LEAST) // 100, hundreds * MOST + rest * MOST // 100


class Part:
    """A part's rows: sorted by label, and how they rank in ties."""

    def __init__(self, batches: list[pa.RecordBatch], groups: int):
        table = pa.Table.from_batches(batches)
        self.row = table.column("row").to_numpy()
        self.label = table.column("label").to_numpy()
        ids = table.column("vec_id")
        self.missing = ids.is_null().to_numpy()
        self.ids = ids.fill_null(0).to_numpy()
        self.tie = np.empty(len(self.row), np.int64)
        self.tie[np.lexsort((self.row, self.ids, self.missing))] = np.arange(len(self.row))
        self.planes = planes_of(table.column("planes"), groups)

    def of(self, label: int) -> slice:
        return slice(*(int(np.searchsorted(self.label, label, side=s)) for s in ("left", "right")))


def planes_of(column: pa.ChunkedArray, groups: int) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.uint8).reshape(len(data), -1, groups)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(part, kind, rows) as long as both stay; rows come sorted by part and kind."""
    for batch in batches:
        part, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
        cuts = np.nonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1]))[0] + 1
        for a, b in zip([0, *cuts], [*cuts, len(part)]):
            if b > a:
                yield int(part[a]), int(kind[a]), batch.slice(a, b - a)


def _visits(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[tuple[Part, pa.RecordBatch, np.ndarray]]:
    """(part, anchors of one label, their tables); a part's own rows are held while its anchors pass."""
    held, number, part = [], None, None
    for now, kind, rows in _segments(batches):
        if now != number:
            held, number, part = [], now, None
        if kind == 0:
            held.append(rows)
            continue
        if part is None:
            if not held:
                continue
            part, held = Part(held, groups), []
        label = rows.column("label").to_numpy()
        cuts = np.nonzero(label[1:] != label[:-1])[0] + 1
        for a, b in zip([0, *cuts], [*cuts, len(label)]):
            for at in range(a, b, ANCHOR_ROWS):
                block = rows.slice(at, min(ANCHOR_ROWS, b - at))
                yield part, block, tables(unpack_planes(planes_of(pa.chunked_array([block.column("planes")]), groups)))


def _ids(part: Part, at: np.ndarray) -> pa.Array:
    return pa.array(part.ids[at], pa.int64(), mask=part.missing[at])


def _positives(groups: int, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block, sums in _visits(batches, groups):
            same = part.of(block.column("label")[0].as_py())
            anchor = block.column("row").to_numpy()
            found = scores(part.planes[same], sums)
            found[part.row[same][:, None] == anchor] = _OUT
            if not len(found):
                continue
            row, column = best(found, part.tie[same], number)
            at = row + same.start
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[column]), block.column("vec_id").take(pa.array(column)), _ids(part, at), pa.array(part.row[at]), pa.array(found[row, column])],
                names=["anchor", "anchor_id", "id", "row", "score"],
            )

    return run


def _negatives(groups: int, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block, sums in _visits(batches, groups):
            same = part.of(block.column("label")[0].as_py())
            other = np.concatenate([np.arange(same.start), np.arange(same.stop, len(part.row))])
            if not len(other):
                continue
            anchor = block.column("row").to_numpy()
            found = np.concatenate([scores(part.planes[: same.start], sums), scores(part.planes[same.stop :], sums)])
            wanted = block.column("scores").to_pylist()
            for slot in range(max(map(len, wanted))):
                have = np.array([c for c, s in enumerate(wanted) if len(s) > slot])
                low, high = between(np.array([wanted[c][slot] for c in have], np.int64))
                mine = found[:, have]
                row, column = best(np.where((mine >= low) & (mine <= high), mine, _OUT), part.tie[other], number)
                at = other[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[have[column]]), pa.array(np.full(len(row), slot + 1, np.int32)), _ids(part, at), pa.array(part.row[at]), pa.array(mine[row, column])],
                    names=["anchor", "slot", "id", "row", "score"],
                )

    return run


def _packed(size: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            lens = np.diff(vectors.offsets.to_numpy())
            values = np.zeros((batch.num_rows, size), np.int64)
            flat = vectors.flatten().to_numpy()
            values[np.arange(size) < lens[:, None]] = np.floor(SCALE * flat).astype(np.int64)
            planes = pack(values, bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "vec_id", "label")] + [pa.array([p.tobytes() for p in planes], pa.binary())],
                names=["row", "vec_id", "label", "planes"],
            )

    return run


def _first(found: DataFrame, keys: list[str], number: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.isnull("id"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= number)


def whole_vectors(vector: Column) -> Column:
    """Whether a vector (array of doubles) is there and has no null, endless or overlong component."""
    limit = LARGEST / SCALE
    inside = (F.coalesce(F.array_max(vector), F.lit(0.0)) < limit) & (F.coalesce(F.array_min(vector), F.lit(0.0)) > -limit)
    return vector.isNotNull() & (F.size(F.array_compact(vector)) == F.size(vector)) & inside


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, embedding, label).

    Components are floor(256 x) of doubles; a score is the inner product. Anchors are the rows whose vec_id is divisible by
    ``every``. An anchor's positives are its ``positives`` best other rows of its label; for each, the ``negatives`` best rows of
    other labels between LEAST and MOST hundredths of its score are given (fewer, if there are fewer). Ties: the smaller
    vec_id, then any fixed order of equal rows; null vec_ids come last and are no anchors. Repeated rows are rows of
    their own: each may be an anchor, a positive of the other, and a negative. Rows with a null label, a null vector or a
    null or non-finite component take no part, nor do components of 2^54 or more. Shorter vectors end in zeros, empty ones
    score zero. Scores beyond a long wrap. Extra columns are ignored, an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    source = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    ).where(F.col("label").isNotNull() & whole_vectors(F.col("vector")))
    most = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
    size, largest = source.agg(F.max(F.size("vector")), F.max(most)).first()
    size, bits = max(1, size or 1), math.ceil(SCALE * (largest or 0.0)).bit_length() + 1
    groups = math.ceil(size / GROUP)
    packed = fixed(
        source.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector").mapInArrow(
            _packed(size, bits), "row long, vec_id long, label long, planes binary"
        ),
        "packed", 1 << 14,
    )
    parts = max(2 * spark.sparkContext.defaultParallelism, math.ceil(packed.count() / PART_ROWS))
    members = packed.select(F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "*")
    anchors = packed.where(F.col("vec_id") % every == 0)

    def visits(those: DataFrame, run, schema: str) -> DataFrame:
        to = those.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("kind", F.lit(1))
        stream = members.withColumn("scores", F.lit(None).cast("array<long>")).unionByName(to.select(*members.columns, "scores"))
        dealt = stream.repartition(parts, "part").sortWithinPartitions("part", "kind", "label", "row")
        return dealt.mapInArrow(run, schema)

    own = visits(
        anchors.withColumn("scores", F.lit(None).cast("array<long>")), _positives(groups, positives), "anchor long, anchor_id long, id long, row long, score long"
    )
    found = fixed(_first(own, ["anchor"], positives).drop("row"), "positives")
    wanted = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("s")).select(
        F.col("anchor").alias("row"), F.col("s.score").alias("scores")
    )
    others = visits(anchors.join(wanted, "row"), _negatives(groups, negatives), "anchor long, slot int, id long, row long, score long")
    given = _first(others, ["anchor", "slot"], negatives)
    return given.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        found.select("anchor", F.col("rank").alias("slot"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        ["anchor", "slot"],
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
