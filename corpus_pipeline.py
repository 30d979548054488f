"""The corpus pipeline: quality rules, near copies, benchmark leaks, mixture, token files.

Every stage takes (spark, docs, sf_dir) and gives a frame; ``run`` writes each to the shared folder and reads it again as
the next one's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modelmon.llm import decontaminate, mixing, quality, queries, shingles, simple8b
from modelmon.llm.common import arrow_rows, folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the quality rules reject go."""
    return quality.keep_good(docs, stored=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each class of near copies the document with the smallest doc_id stays.

    The classes of the fingerprints are checked on whole sets (5-word Jaccard 0.8 or more), which also find near copies whose
    fingerprints are further apart.
    """
    return shingles.keep_one(docs, stored=True)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each source's share of the token budget, one epoch."""
    return mixing.take(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token files of what is left, read back as one row per document."""
    return simple8b.token_table(docs, queries.tokenizer_path(queries.TOKENIZER))


STAGES = [
    ("quality rules", keep_good),
    ("near copies", drop_near_copies),
    ("benchmark leaks", drop_leaks),
    ("mixture", mix_sources),
    ("token files", write_token_files),
]

# Fingerprints, the index search and the tokenizer are beyond SQL: tests compare run() with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = folder(spark, f"stage-{name.replace(' ', '-')}")
        kept = stage(spark, docs, sf_dir)
        with arrow_rows(spark):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
