"""Training and backfill on the ten-row frames."""

import pytest
from pyspark.sql import functions as F

from modelmon.operators import bins, development
from modelmon.operators.observations import value_counts
from modelmon.plans.backfill import backfill, date_window
from modelmon.plans.training import train_models
from tests.conftest import BASE, CUR
from tests.test_monitor import MODEL, config_tables


@pytest.fixture(scope="module")
def trained(spark, frames, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("train"))
    paths = train_models(spark, config_tables(spark, frames), CUR, out, "exec-t")
    return {t: spark.read.parquet(p) for t, p in paths.items()}


def test_bins(trained):
    rows = trained["csi_psi_table"].collect()
    age = sorted((r for r in rows if r.variable == "age"), key=lambda r: r.bin)
    assert len(age) == 10 and age[0].lb == float("-inf") and age[-1].ub == float("inf")
    assert sum(r.count_dev for r in age) == 10  # trained on the day that has no missing age
    assert all(a.ub == b.lb for a, b in zip(age, age[1:]))
    category = sorted((r for r in rows if r.variable == "category"), key=lambda r: r.bin)
    assert [(r.category_value, r.count_dev) for r in category] == [("C", 5), ("B", 3), ("A", 2)]
    assert {r.woe for r in rows} == {0.0}


def test_ranks_and_limits(trained):
    ranks = {r.category_value: r for r in trained["category_baseline_rank"].collect()}
    assert [ranks[c].rank_dev for c in "CBA"] == [1, 2, 3] and ranks["C"].freq_dev == pytest.approx(0.5)
    assert ranks["C"].top_n_threshold == 2 and ranks["C"].critical_top_k == 5
    limits = {(r.variable, r.metric_name): r for r in trained["metric_threshold_auto"].collect()}
    assert ("age", "outlier_rate") in limits and ("category", "outlier_rate") not in limits
    assert limits["score", "entropy"].baseline_value == pytest.approx(2.302585, abs=0.3)
    assert ("age", "entropy") not in limits and limits["age", "null_rate"].sample_size_dev == 10


def test_backfill_skips_finished_dates(spark, frames, tmp_path):
    config = config_tables(spark, frames)
    log = spark.createDataFrame([(MODEL, CUR, "SUCCESS")], "model_id string, information_date string, status string")
    window = (F.lit(CUR).cast("date"), F.lit(BASE).cast("date"))
    done = backfill(spark, config, [MODEL], window, str(tmp_path), "bf", log)
    assert [r.information_date for r in done.collect()] == [BASE]
    results = spark.read.parquet(f"{tmp_path}/metric_result")
    assert results.where("variable = 'age' and metric_name = 'null_rate'").count() == 1
    first, last = date_window("2025-03-31", 1, "months")
    assert spark.range(1).select(first, last).first()[0].isoformat() == "2025-02-28"
    with pytest.raises(ValueError):
        date_window("2025-03-31", 0)


DDL = "model_id string, information_date string, var_type string, variable string, side string, value"


def ordered(df):
    return sorted(df.collect(), key=str)


def test_training_operators_take_counted_values(spark):
    made = [("m", "d", "raw", "v", "current", x) for x in [1.0] * 7 + [2.0, 3.0, 3.0, 50.0, None, None]]
    numbers = spark.createDataFrame(made, f"{DDL} double")
    assert ordered(bins.numeric_bins(value_counts(numbers))) == ordered(bins.numeric_bins(numbers))
    quartiles = spark.createDataFrame([("m", "d", "raw", "v", 1.0, 3.0)], "model_id string, information_date string, var_type string, variable string, q1 double, q3 double")
    limits = development.auto_thresholds(numbers, quartiles)
    assert ordered(development.auto_thresholds(value_counts(numbers), quartiles)) == ordered(limits)
    texts = spark.createDataFrame([(*r[:5], x) for r, x in zip(made, "aaabbcaac")] + [(*made[0][:5], None)], f"{DDL} string")
    for operator in (bins.categorical_bins, bins.category_rank, development.auto_thresholds):
        assert ordered(operator(value_counts(texts))) == ordered(operator(texts))
