"""Token ids as Simple-8b words in binary files, and back.

File: 64-bit little-endian words only. A file is a run of segments, each followed by one zero word (``GAP``); a segment is

    magic | partition | number in partition | documents D | ids N | blocks B | words W
    doc_id x D | (doc_id is null) x D | ids per document x D | first word of each block x B | W words

Ids of a segment are cut into blocks of ``BLOCK`` ids, and a block starts a new word, so that any block can be decoded
without the ones before it. The top four bits of a word are its selector:

    1..15  60 payload bits hold COUNTS[s] ids of WIDTHS[s] bits, lowest first (the last word of a block may hold fewer)
    0      escape: the next word is one id of up to 64 bits

Partitions are ranges of doc_id in ascending order and file names follow the partition number, so files, segments and
documents are all in ascending order of doc_id.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from modelmon.llm.common import arrow_rows, fixed, folder

# Fixed values of the format: ids per word and bits per id, by selector.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 60], dtype=np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0], dtype=np.int64)
# Selectors in the order they are tried: most ids first.
TRIED = (15, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14)
MAGIC = 0x31423853444B4F54
GAP = "\0" * 8
HEAD = 7
BLOCK = 1024
SEGMENT_IDS = 1 << 20
# Segments of one file: a file is read as a whole, so it stays a few hundred MB whatever a partition holds.
FILE_SEGMENTS = 64
END_ID = 2
# Different pieces of text whose ids a Python worker remembers; when half of them are new, the older half goes.
REMEMBERED = 700_000
# Characters that the pre-tokenizer parts from the letters in front of them.
CLOSING = ".,!?;:*#$%&"
# Pieces encoded in one call.
JOINED = 500

_INSIDE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")
# Words of Latin letters: one piece of the pre-tokenizer each, with a space in front or without.
_LATIN = re.compile(r"\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
_worker: dict = {}


_SHORT_BITS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits each unsigned 64-bit value needs."""
    out = _SHORT_BITS[values & np.uint64(0xFFFF)]
    for part in (16, 32, 48):
        high = values >> np.uint64(part)
        if not high.any():
            break
        out = np.where(high > 0, part + _SHORT_BITS[high & np.uint64(0xFFFF)], out).astype(np.uint8)
    return out


def _choices(bits: np.ndarray) -> np.ndarray:
    """The selector with most ids at each place of a (blocks, block) table of bits; zeros follow the end of a block."""
    blocks, size = bits.shape
    wide = {1: np.zeros((blocks, size + 120), np.uint8)}
    wide[1][:, :size] = bits
    # The most bits among n ids from each place, each from two shorter runs.
    for n, (x, y) in {2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1), 6: (4, 2), 7: (4, 3), 8: (4, 4), 10: (8, 2), 12: (8, 4), 15: (8, 7), 20: (10, 10), 30: (15, 15), 60: (30, 30)}.items():
        wide[n] = wide[x].copy()
        np.maximum(wide[x][:, :-x], wide[y][:, x:], out=wide[n][:, :-x])
    chosen = np.zeros((blocks, size), np.uint8)
    # Fewest ids first, so that a selector with more ids overwrites one with fewer.
    for s in reversed(TRIED):
        np.copyto(chosen, np.uint8(s), where=wide[int(COUNTS[s])][:, :size] <= WIDTHS[s])
    return chosen


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) for unsigned 64-bit values. All blocks advance together, one word a step."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts = np.arange(0, n, block)
    ends = np.minimum(starts + block, n)
    bits = np.zeros(len(starts) * block, np.uint8)
    bits[:n] = _bits(values)
    choice = _choices(bits.reshape(len(starts), block)).reshape(-1)
    step = np.maximum(COUNTS, 1)
    cursor, rest, places = starts, ends, []
    while len(cursor):
        places.append(cursor)
        cursor = cursor + step[choice[cursor]]
        more = cursor < rest
        cursor, rest = cursor[more], rest[more]
    first = np.sort(np.concatenate(places))
    selector = choice[first]
    taken = np.diff(np.append(first, n))
    shift = (np.arange(n) - np.repeat(first, taken)) * np.repeat(WIDTHS[selector], taken)
    payload = np.bitwise_or.reduceat(values << shift.astype(np.uint64), first)
    escaped = selector == 0
    size = np.where(escaped, 2, 1)
    slot = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[slot] = selector.astype(np.uint64) << np.uint64(60) | np.where(escaped, np.uint64(0), payload)
    words[slot[escaped] + 1] = values[first[escaped]]
    return words, slot[np.searchsorted(first, starts)]


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n values of packed words; ``offsets`` are the first words of the blocks. All words are decoded together."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    # A raw word after an escape is data, whatever its top bits: follow the escapes of each block.
    raw = np.zeros(len(words), bool)
    zero = np.nonzero(selector == 0)[0]
    if len(zero):
        first = set(offsets.tolist())
        for i in zero:
            if not (raw[i] and i not in first):
                raw[i + 1] = True
    head = np.nonzero(~raw)[0]
    count = np.where(selector[head] == 0, 1, COUNTS[selector[head]])
    owner = np.searchsorted(offsets, head, side="right") - 1
    before = np.cumsum(count) - count
    at = before - before[np.searchsorted(head, offsets)][owner] + owner * block
    end = np.minimum((owner + 1) * block, n)
    for s in range(15):
        mine = np.nonzero(selector[head] == s)[0]
        if not len(mine):
            continue
        if s == 0:
            out[at[mine]] = words[head[mine] + 1]
            continue
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(COUNTS[s]):
            has = mine[at[mine] + k < end[mine]]
            out[at[has] + k] = words[head[has]] >> np.uint64(k * WIDTHS[s]) & mask
    return out


def segment(partition: int, number: int, doc_ids: list, ids: list[np.ndarray]) -> bytes:
    values = np.concatenate(ids) if ids else np.zeros(0, np.uint64)
    words, offsets = pack(values)
    head = [MAGIC, partition, number, len(ids), len(values), len(offsets), len(words)]
    parts = [
        np.array(head, "<i8"), np.array([i or 0 for i in doc_ids], "<i8"), np.array([i is None for i in doc_ids], "<i8"),
        np.array([len(x) for x in ids], "<i8"), offsets.astype("<i8"), words.astype("<u8"),
    ]
    return b"".join(p.tobytes() for p in parts)


def segments(content: bytes) -> Iterator[tuple[int, int, list, list[np.ndarray]]]:
    """(partition, number, doc_ids, ids of each document) of each segment of a file."""
    data, at = np.frombuffer(content, "<i8"), 0
    while at < len(data):
        magic, partition, number, docs, n, blocks, size = (int(x) for x in data[at : at + HEAD])
        if magic != MAGIC:
            raise ValueError("not a token file")
        cut = np.cumsum([at + HEAD, docs, docs, docs, blocks, size])
        values = unpack(data[cut[4] : cut[5]].view("<u8"), data[cut[3] : cut[4]], n)
        doc_ids = [None if null else int(i) for i, null in zip(data[cut[0] : cut[1]], data[cut[1] : cut[2]])]
        yield partition, number, doc_ids, np.split(values, np.cumsum(data[cut[2] : cut[3]])[:-1]) if docs else []
        at = int(cut[5]) + 1


class Encoder:
    """Encodes whole texts with the library; equal to one call per text, but each different piece is encoded once.

    The library's byte-level pre-tokenizer always ends a piece before a single space or line end between two other
    characters, and between letters and closing punctuation, so texts may be cut there. ``rows`` maps a piece to its ids:
    with the space in front of it, or with the line end that the piece then starts with. A text with white space beside
    white space or at an end is cut by the slower, exact pattern, and so is every text if the vocabulary's pre-tokenizer
    does not keep line ends apart. A word of Latin letters is one piece of the pre-tokenizer, so it goes straight to the
    library's model, in the letters that the pre-tokenizer shows bytes as, if probes say that this gives the same ids.
    ``before`` holds the pieces of the time before ``rows`` was full.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        ids = self._ids
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {c: shown(chr(c))[0][0] for c in range(0xC0, 0x250)}
        self.space = shown(" ")[0][0]
        probes = ["a", "Zebra", "internationalisation", "stra\u00dfe", "\u00dcbergr\u00f6\u00dfe", "\u0141\u00f3d\u017a", "s" * 40]
        self.words = self.tokenizer.normalizer is None and all(
            self._word(p) == ids(p) and self._word(p, self.space) == ids(" " + p) for p in probes
        )
        self.line_end = ids("\n")
        self.lines = len(self.line_end) == 4 and all(ids(f"{x}\n{y}") == ids(x) + self.line_end + ids(y) for x in ("a", "a.", "1", ")") for y in ("a", ".", "1"))
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.rows) > REMEMBERED // 2:
            self.rows, self.before = {}, self.rows
        if len(self.heads) > REMEMBERED // 2:
            self.heads = {}
        if len(self.tails) > REMEMBERED // 10:
            self.tails = {}
        cut = [text.replace("\n", " \n").split(" ") if self._tight(text) else _INSIDE_SPACE.split(text) for text in texts]
        heads = list({c[0] for c in cut}.difference(self.heads))
        for head, encoding in zip(heads, self.tokenizer.encode_batch_fast(heads, add_special_tokens=False)):
            self.heads[head] = np.array(encoding.ids, "<u4").tobytes()
        first = [self.heads[c.pop(0)] for c in cut]
        self._learn(set().union(*cut).difference(self.rows))
        look = self.rows.__getitem__
        return [np.frombuffer(head + b"".join(map(look, c)), "<u4") for head, c in zip(first, cut)]

    def _tight(self, text: str) -> bool:
        """Only single spaces and line ends, each between two other characters; asked once per text."""
        flat = text.replace("\n", " ")
        return self.lines and flat[:1] != " " != flat[-1:] and "  " not in flat and not _OTHER_SPACE.search(text)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str, ahead: str = "") -> bytes:
        """Ids of a word of Latin letters; ``ahead`` is nothing or a space as the pre-tokenizer shows it."""
        found = [t.id for t in self.model.tokenize(ahead + (word if word.isascii() else word.translate(self.shown)))]
        return struct.pack(f"<{len(found)}I", *found)

    def _learn(self, pieces: set[str]) -> None:
        rows, before = self.rows, self.before
        stems, plain = {}, set()
        for p in pieces:
            if (known := before.get(p)) is not None:
                rows[p] = known
                continue
            stem = p.rstrip(CLOSING)
            if len(stem) < len(p) and stem.removeprefix("\n").isalpha():
                stems[p] = stem
                if stem not in rows:
                    plain.add(stem)
            else:
                plain.add(p)
        if self.words:
            latin, word, space, other = _LATIN.fullmatch, self._word, self.space, set()
            for p in plain:
                if not latin(p) or p[0] == "\n" and not self.lines:
                    other.add(p)
                elif p[0] == "\n":
                    rows[p] = self.line_end + word(p[1:])
                else:
                    rows[p] = word(p, space)
            plain = other
        if self.lines:
            self._learn_lines([p for p in plain if "\n" not in p], " ", b"")
            self._learn_lines([p for p in plain if p[0] == "\n" and "\n" not in p[1:]], "", self.line_end)
        rest = [p for p in plain if p not in rows]
        for p, encoding in zip(rest, self.tokenizer.encode_batch_fast([" " + p for p in rest], add_special_tokens=False)):
            rows[p] = np.array(encoding.ids, "<u4").tobytes()
        for p, stem in stems.items():
            tail = p[len(stem) :]
            if tail not in self.tails:
                self.tails[tail] = self._ids(tail)
            rows[p] = rows[stem] + self.tails[tail]

    def _learn_lines(self, pieces: list[str], ahead: str, ids_ahead: bytes) -> None:
        """Encode many pieces in one call, a line each; a line end is a token of its own beside what is no line end."""
        for at in range(0, len(pieces), JOINED):
            part = pieces[at : at + JOINED]
            text = "\n".join(ahead + p.removeprefix("\n") for p in part)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            stops = np.append(np.nonzero(ids == np.frombuffer(self.line_end, "<u4"))[0], len(ids)).tolist()
            if len(stops) != len(part):
                raise ValueError("the tokenizer does not keep line ends apart")
            data, start = ids.tobytes(), 0
            for p, stop in zip(part, stops):
                self.rows[p] = ids_ahead + data[4 * start : 4 * stop]
                start = stop + 1


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if _worker.get("path") != path:
        _worker.update(path=path, encoder=Encoder(path))
    return _worker["encoder"]


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, parts: int | None = None) -> None:
    """Encode (doc_id, text) and write token files under ``path`` (any file system Spark can write).

    Null and empty texts are written as the end id alone; equal doc_ids follow the order of their texts; null doc_ids come
    first; further columns are ignored. An empty table gives files without a segment.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, partition, number = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        doc_ids, ids, held = [], [], 0
        end = np.array([END_ID], "<u4")

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([segment(partition, number, doc_ids, ids)], pa.binary())], names=["segment"])

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for key, found in zip(keys, encode(batch.column("text").to_pylist())):
                doc_ids.append(key)
                ids.append(np.concatenate([found, end]))
                held += len(ids[-1])
                if held >= SEGMENT_IDS:
                    yield flush()
                    doc_ids, ids, held, number = [], [], 0, number + 1
        if ids:
            yield flush()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = texts.repartitionByRange(parts, "doc_id", "text").sortWithinPartitions("doc_id", "text")
    # The text sink writes a string's bytes as they are, and its line separator is the zero word between segments.
    binary = ordered.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value"))
    with arrow_rows(spark):
        binary.write.option("lineSep", GAP).option("maxRecordsPerFile", FILE_SEGMENTS).text(path)


def _read(spark: SparkSession, path: str, columns: str, make) -> DataFrame:
    """One row per document of the files under ``path``; run it with one row (a whole file) per Arrow batch."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for part, number, doc_ids, ids in segments(content.as_buffer()):
                    yield pa.RecordBatch.from_arrays(make(part, number, doc_ids, ids), names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, columns)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) per document of the files under ``path``; ids are little-endian unsigned 32-bit integers."""

    def make(part: int, number: int, doc_ids: list, ids: list[np.ndarray]) -> list[pa.Array]:
        return [pa.array(doc_ids, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]

    return fixed(_read(spark, path, "doc_id long, ids binary", make), "ids", rows=1)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, read from the files: start counts the ids of all documents before."""

    def make(part: int, number: int, doc_ids: list, ids: list[np.ndarray]) -> list[pa.Array]:
        sizes = np.array([len(x) for x in ids], np.int64)
        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        columns = [[part] * len(ids), [number] * len(ids), doc_ids, np.cumsum(sizes) - sizes, sizes, crc]
        return [pa.array(c, pa.int64()) for c in columns]

    columns = "part long, segment long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    rows = fixed(_read(spark, path, columns, make), "digests", rows=1)
    # One row per segment of about a million ids, then one per file: running sums over few rows.
    sizes = rows.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n"))
    files = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before_file"))
    starts = sizes.select(
        "part", "segment", (F.sum("n").over(W.partitionBy("part").orderBy("segment")) - F.col("n")).alias("before")
    ).join(files, "part")
    return rows.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("before_file") + F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_table(docs: DataFrame, tokenizer_path: str, parts: int | None = None) -> DataFrame:
    """Write the documents' ids to token files in the shared folder, read them back, and give their digest columns."""
    path = folder(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, path, parts)
    return digests(docs.sparkSession, path)
