"""Fixing small shared frames, and broadcasting only what was counted."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession, functions as F

# A broadcast side may hold this many rows (a few tens of megabytes at the widths used here).
BROADCAST_ROWS = 200_000
# Independent jobs submitted side by side.
PARALLEL_JOBS = 6


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the cluster names in ``spark.checkpoint.dir``.

    Only where nothing is set and everything runs on one machine (master ``local``) a temporary folder is taken;
    elsewhere executors would not see each other's files, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="modelmon-shared-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


# The folder of the run at hand; threads of ``side_by_side`` see that of the thread which started them.
_RUN_FOLDER: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def run_tables(spark: SparkSession) -> Iterator[str]:
    """Inside the block, fixed tables go to one folder of their own, which is deleted at its end, however that comes.

    Nothing read from such a table may leave the block. A block inside another has its own folder.
    """
    folder = f"{shared_folder(spark)}/fixed/run-{uuid.uuid4().hex}"
    mark = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(mark)
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def reliable(df: DataFrame) -> DataFrame:
    """Fix a frame as a table in the shared folder: computed once, safe from lost executors.

    Read back as a table it has a true size, so Spark chooses joins by it.
    """
    folder = _RUN_FOLDER.get() or f"{shared_folder(df.sparkSession)}/fixed"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame marked for broadcast if it holds few enough rows; otherwise as it is."""
    return F.broadcast(df) if fits(df, rows) else df


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The frame dealt over all tasks by its keys, however few tasks it was read in; Spark does not gather the tasks again."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def all_reliable(makers: list[Callable[[], DataFrame | None]]) -> list[DataFrame | None]:
    """Build and fix several independent frames, a few jobs at a time."""

    def fixed(make: Callable[[], DataFrame | None]) -> DataFrame | None:
        df = make()
        return None if df is None else reliable(df)

    return side_by_side([lambda make=make: fixed(make) for make in makers])


def side_by_side(work: list[Callable]) -> list:
    """What independent pieces of work give, a few at a time, in their order."""
    contexts = [copy_context() for _ in work]
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        return list(pool.map(lambda context, job: context.run(job), contexts, work))
