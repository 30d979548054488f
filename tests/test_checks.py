"""Every registered query against its SQL on the given tables, and the plans they must not have."""

import glob
import math
import os

import duckdb
import pytest

from checks import all_checks
from checks.catalog import Tables

CATALOG = all_checks()
HEAVY = {"run_metrics", "run_model_date", "train_model"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else repr(float(value))
    return str(value)


def sorted_rows(rows):
    return sorted(tuple(plain(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(set(CATALOG.ORACLE)))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = CATALOG.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    relation = duck.execute(CATALOG.ORACLE[name])
    order = [d[0] for d in relation.description]
    assert sorted(order) == columns
    expected = [[row[order.index(c)] for c in columns] for row in relation.fetchall()]
    assert sorted_rows([[row[c] for c in columns] for row in df.collect()]) == sorted_rows(expected)


def test_every_query_is_named_in_the_catalog():
    assert set(CATALOG.ORACLE) | HEAVY == set(CATALOG.QUERIES)


def test_no_unbounded_plans(spark, sf_dir):
    from checks import data
    from modelmon.operators import conjugate, quality, score, stability

    tables = Tables(spark, sf_dir)
    rows, texts = data.numbers(tables), data.texts(tables)
    frames = [
        quality.counts(rows), quality.distinct(rows), quality.categories(texts), stability.dynamic_categories(texts),
        score.entropy(rows), score.concentration(rows), conjugate.roc(data.pairs(tables)), conjugate.fit(data.pairs(tables)),
    ]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SinglePartition" not in plan
        assert "ArrowEval" not in plan and "PythonUDF" not in plan
