"""What the text operators share: a fixed table in the shared folder, bounded Arrow batches, words."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelmon.functions.sizes import shared_folder

# A word of the data contract: a run of anything but the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Rows of one Arrow batch: long texts come a few hundred at a time, so a Python worker's memory does not follow the table.
BATCH_ROWS = 512


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Inside the block, jobs hand Python at most so many rows at a time. Run the job inside it; the setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables fixed inside the block are deleted at its end, however that comes, unless they are fixed as lasting.

    Shuffle files of jobs in the block go as soon as their job has ended: what it made is a table by then.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    mark = _PASSING.set([])
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        for path in _PASSING.get():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _PASSING.reset(mark)


def fixed(df: DataFrame, name: str, rows: int = BATCH_ROWS, lasting: bool = False) -> DataFrame:
    """The frame as a written table in the shared folder: computed once, and safe from lost executors.

    Python stages in it get at most ``rows`` rows in an Arrow batch. A lasting table outlives ``passing_tables``.
    """
    path = folder(df.sparkSession, name)
    if _PASSING.get() is not None and not lasting:
        _PASSING.get().append(path)
    with arrow_rows(df.sparkSession, rows):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(docs: DataFrame) -> DataFrame:
    """(row, d): every input row as one struct, so that no added column can clash with the input's own names.

    ``row`` is unique, and stable because the table is written.
    """
    return fixed(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[docs[c] for c in docs.columns]).alias("d")), "whole")


def numbered(docs: DataFrame, stored: bool) -> DataFrame:
    """As ``whole``, without a copy where ``stored`` says that docs is a plain read of Parquet files.

    A row is then told by its file (a 64-bit hash of the path) and its place in it, which no later read changes.
    """
    if stored:
        try:
            place = docs.metadataColumn("_metadata")
            row = F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("place"))
            return docs.select(row.alias("row"), F.struct(*[docs[c] for c in docs.columns]).alias("d"))
        except AnalysisException:
            pass  # not a read of files: the rows are written
    return whole(docs)


def unpack(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("d")[c].alias(c) for c in columns])


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")
