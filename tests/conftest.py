import os
import tempfile

import pytest
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("modelmon-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="modelmon-wh-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="modelmon-ck-"))
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


CUR, BASE = "2025-01-01", "2025-01-02"
AGES = [25.0, 30.0, 35.0, 40.0, 45.0, None, 1000.0, 28.0, 32.0, 29.0]
AGES_BASE = [22.0, 27.0, 33.0, 38.0, 41.0, 44.0, 29.0, 31.0, 36.0, 39.0]
SCORES = [0.95, 0.85, 0.75, 0.65, 0.55, 0.45, 0.35, 0.25, 1.5, -0.2]
SCORES_BASE = [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05]
TARGETS = [1, 0, 1, 0, 0, 0, 1, 0, 1, 0]


@pytest.fixture(scope="session")
def frames(spark):
    """The ten-row frames whose metric values are known by hand."""
    ids = range(1, 11)

    def make(date, values, name, dtype):
        return spark.createDataFrame(
            [(i, date, *(v if isinstance(v, tuple) else (v,))) for i, v in zip(ids, values)],
            f"customer_id long, information_date string, {name if ' ' in name else name + ' ' + dtype}",
        ).coalesce(1)

    raw = make(CUR, list(zip(AGES, "ABAABACCBB")), "age double, category string", "")
    raw_base = make(BASE, list(zip(AGES_BASE, "CCCCCBBBAA")), "age double, category string", "")
    score, score_base = make(CUR, SCORES, "score", "double"), make(BASE, SCORES_BASE, "score", "double")
    target, target_base = make(CUR, TARGETS, "target", "long"), make(BASE, TARGETS, "target", "long")
    join = lambda s, t: s.select("customer_id", "score").join(t.select("customer_id", "target"), "customer_id")
    return {
        "raw": raw, "raw_base": raw_base, "score": score, "score_base": score_base,
        "target": target, "target_base": target_base,
        "joined": join(score, target), "joined_base": join(score_base, target_base),
    }
