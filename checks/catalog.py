"""Every operator as a query over the given tables, with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelmon.functions.sizes import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given tables of one scale, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def check(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL where there is one."""

    def keep(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def prepare(spark: SparkSession) -> None:
    """Name the checkpoint folder of the session where it has none yet (see ``shared_folder``)."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch(tables: Tables, name: str) -> str:
    """A fresh folder for one query's written data."""
    import uuid

    from modelmon.sources.sinks import scratch_dir

    return f"{scratch_dir(tables.spark)}/checks/{name}-{uuid.uuid4().hex}"


def r6(column: Column | str, places: int = 6) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), places) + F.lit(0.0)


def iso(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def month(column: str) -> Column:
    return F.trunc(column, "month")
