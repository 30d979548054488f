"""Values counted by date, and rows joined once, give what rows read for every run and side give."""

from pyspark.sql import functions as F

from modelmon.functions.columns import KEYS, smallest_per_key
from modelmon.operators.observations import merged, value_counts
from modelmon.plans.monitor import Monitor
from tests.conftest import BASE, CUR
from tests.test_monitor import MODEL, config_tables, many_models


def rows_of(df):
    return sorted(df.collect(), key=str)


def feeds_of(spark, frames, names):
    monitor = Monitor(spark, many_models(config_tables(spark, frames), spark, frames, names))
    asked = spark.createDataFrame([(n, d) for n in names for d in (CUR, BASE)], "model_id string, information_date string")
    dates, lagged = monitor.resolved(asked)
    return monitor, dates, lagged, monitor.feeds.read_dates(dates)


def test_counts_by_date_serve_all_runs_and_sides(spark, frames):
    monitor, dates, _, literals = feeds_of(spark, frames, ["A", "B"])
    for numeric in (True, False):
        counted = monitor.feeds.date_counts(literals, numeric)
        serving, once = monitor.feeds.serving(dates, numeric)
        served = monitor.feeds.served(counted, serving)
        columns = [*KEYS, "value", "n_cur", "n_base"]
        assert once and rows_of(merged(served).select(*columns)) == rows_of(value_counts(monitor.feeds.observations(dates, literals, numeric)).select(*columns))
    # Ten rows of three numeric columns on two days: two models, two runs and two sides count them once.
    assert monitor.feeds.date_counts(literals, True).agg(F.sum("n")).first()[0] == 2 * 3 * 10


def test_several_dates_of_a_side_are_merged(spark, frames):
    monitor, dates, _, literals = feeds_of(spark, frames, [MODEL])
    both = dates.withColumns({"information_date": F.lit(BASE), "side": F.lit("current")}).distinct()
    serving, once = monitor.feeds.serving(both, True)
    assert not once
    counts = monitor._counted(both, literals)
    assert counts.groupBy(*KEYS, "value").count().where("count > 1").isEmpty()
    assert counts.agg(F.sum("n_cur")).first()[0] == 2 * 4 * 10  # the age goes under two names


def test_pairs_are_joined_once_for_models_runs_and_sides(spark, frames):
    monitor, dates, lagged, literals = feeds_of(spark, frames, ["A", "B"])
    pairs = monitor.pairs(dates, lagged, literals)
    found = {(r.model_id, r.information_date, r.side): (r.n, r.events) for r in pairs.groupBy("model_id", "information_date", "side").agg(F.count("*").alias("n"), F.sum("target").alias("events")).collect()}
    assert found == {(m, d, s): (10, 4.0) for m in ("A", "B") for d, s in ((CUR, "current"), (BASE, "current"), (BASE, "baseline"))}
    read = monitor._meeting([(f, dates.where(F.col("source_table") == f.source_table)) for f in monitor.feeds.feeds[:2]], ["A", "B"])
    # The day before the first one is asked of the sources, too, but holds nothing.
    assert read.count() == 8 and read.select("_meet").distinct().count() == 3


def test_smallest_number_of_a_key(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, -1.0), (2, 5.0), (2, None), (None, 3.0), (None, 4.0)], "k int, x double")
    found = {r.k: (r.x, r.gone) for r in smallest_per_key(rows, ["k"], ["x"], "gone").collect()}
    assert found == {1: (-1.0, 1), 2: (None, 1), None: (3.0, 1)}
    plan = smallest_per_key(rows, ["k"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
