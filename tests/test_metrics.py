"""The 27 metrics on the ten-row frames, against values known by hand."""

import math

import pytest
from pyspark.sql import functions as F

from modelmon.operators import registry
from modelmon.operators.availability import LATE, NO_DATA, UPDATED, data_availability
from modelmon.operators.direct import calculate

LIMITS = {"threshold_ambar": 0.05, "threshold_red": 0.10}


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def run(frames, name, cur, base=None, thresholds=None, **params):
    return one(calculate(name, frames[cur], frames[base] if base else None, thresholds or {}, **params))


def test_all_metrics_registered():
    assert len(registry.names()) == 27
    with pytest.raises(KeyError):
        registry.get("no_such_metric")


def test_null_rate(frames):
    r = run(frames, "null_rate", "raw", "raw_base", LIMITS, variable="age")
    assert r.metric_value == pytest.approx(0.10) and r.status == "RED" and r.baseline_value == 0.0


def test_cardinality(frames):
    r = run(frames, "cardinality_ratio", "raw", None, {"threshold_red": 0.95}, variable="age")
    assert r.metric_value == pytest.approx(0.90) and r.status == "GREEN" and r.baseline_value is None


def test_outliers(frames):
    r = run(frames, "outlier_rate", "raw", None, {"threshold_ambar": 0.03, "threshold_red": 0.06}, variable="age")
    assert r.metric_value == pytest.approx(0.10) and r.status == "RED"


def test_dominant_category(frames):
    r = run(frames, "dominant_category_rate", "raw", None, {"threshold_red": 0.9}, variable="category", data_type="categorical")
    assert r.metric_value == pytest.approx(0.40) and r.status == "GREEN"


def test_composition_drift(frames):
    r = run(
        frames, "category_composition_drift", "raw", "raw_base", {"threshold_ambar": 0.1, "threshold_red": 0.3},
        variable="category", data_type="categorical", top_n=2,
    )
    assert r.metric_value == pytest.approx(2 / 3) and r.status == "RED" and r.baseline_value == pytest.approx(1 / 3)


def test_population_variation(frames):
    limits = {"threshold_ambar": 0.15, "threshold_red": 0.30}
    assert run(frames, "population_variation", "raw", "raw_base", limits, variable="age").metric_value == 0.0
    two = frames["raw"].limit(2)
    r = one(calculate("population_variation", two, frames["raw_base"], limits, variable="age"))
    assert r.metric_value == pytest.approx(4.0) and r.status == "RED" and r.baseline_value == 10.0


def test_completeness(frames):
    full = run(frames, "completeness", "raw", None, {"threshold_red": 0.2}, variable="age",
               expected_dates=["2025-01-01"], date_column="information_date")
    half = run(frames, "completeness", "raw", None, {"threshold_red": 0.2}, variable="age",
               expected_dates=["2025-01-01", "2025-01-09"], date_column="information_date")
    none = run(frames, "completeness", "raw", None, {"threshold_red": 0.2}, variable="age", expected_dates=[])
    assert (full.metric_value, full.status) == (0.0, "GREEN")
    assert (half.metric_value, half.status) == (0.5, "RED")
    assert none.metric_value == 0.0


def test_median_shift(frames):
    r = run(frames, "median_shift", "raw", "raw_base", variable="age")
    assert r.baseline_value == 33.0 and r.metric_value == pytest.approx(abs(32.0 - 33.0) / 33.0)


def test_stability(frames):
    ks = run(frames, "ks_vs_dev", "raw", "raw_base", variable="age")
    assert ks.metric_value == pytest.approx(0.30)
    dyn = run(frames, "psi_dynamic", "raw", "raw_base", variable="age")
    same = run(frames, "psi_dynamic", "raw_base", "raw_base", variable="age")
    assert dyn.metric_value > 0 and same.metric_value == pytest.approx(0.0, abs=1e-12)
    for name in ("psi_dynamic", "ks_vs_dev", "tail_shift", "median_shift", "population_variation"):
        with pytest.raises(ValueError):
            calculate(name, frames["raw"], None, {}, variable="age")


def _psi(actual, expected):
    a = [x / (sum(actual) or 1) for x in actual]
    e = [x / (sum(expected) or 1) for x in expected]
    return sum((x - y) * math.log((x + 1e-6) / (y + 1e-6)) for x, y in zip(a, e))


def test_psi_categorical(frames):
    r = run(frames, "psi_dynamic", "raw", "raw_base", variable="category", data_type="categorical")
    assert r.metric_value == pytest.approx(_psi([4, 4, 2], [2, 3, 5]))


def test_psi_canonical_and_fallback(frames):
    bins = [{"bin": 1, "lb": float("-inf"), "ub": 30.0, "count_dev": 3}, {"bin": 2, "lb": 30.0, "ub": float("inf"), "count_dev": 7}]
    r = run(frames, "psi_canonical", "raw", "raw_base", variable="age", bins=bins)
    assert r.metric_value == pytest.approx(_psi([4, 5], [3, 7]))
    plain = [{k: v for k, v in b.items() if k != "count_dev"} for b in bins]
    r = run(frames, "psi_canonical", "raw", "raw_base", variable="age", bins=plain)
    assert r.metric_value == pytest.approx(_psi([4, 5], [3, 7]))
    fallback = run(frames, "psi_canonical", "raw", "raw_base", variable="age")
    assert fallback.metric_value == pytest.approx(run(frames, "psi_dynamic", "raw", "raw_base", variable="age").metric_value)


def test_score_metrics(frames):
    p = {"variable": "score", "score_col": "score", "var_type": "score"}
    assert run(frames, "range_violation", "score", None, {"threshold_red": 1e-9}, **p).status == "RED"
    assert run(frames, "range_violation", "score", **p).metric_value == pytest.approx(0.20)
    e = run(frames, "entropy", "score", "score_base", **p)
    bands = lambda s: [min(math.floor(x * 10), 9) for x in s]
    from tests.conftest import SCORES, SCORES_BASE
    H = lambda b: -sum(b.count(x) / 10 * math.log(b.count(x) / 10) for x in set(b))
    hc, hb = H(bands(SCORES)), H(bands(SCORES_BASE))
    assert e.metric_value == pytest.approx(abs(hc - hb) / hb) and e.baseline_value == pytest.approx(hb)
    a = run(frames, "approval_rate", "score", "score_base", cut_off_probability=0.5, **p)
    assert a.metric_value == pytest.approx(0.5) and a.baseline_value == pytest.approx(0.4)
    t = run(frames, "tail_shift", "score", "score_base", **p)
    assert t.metric_value == pytest.approx(abs(-0.2 - 0.05) + abs(0.95 - 0.8))
    g = run(frames, "concentration_gini", "score", "score_base", **p)
    assert g.baseline_value == pytest.approx(0.352747, abs=1e-6)
    assert g.metric_value == pytest.approx(abs(0.388525 - 0.352747) / 0.352747, abs=1e-5)
    assert run(frames, "concentration_gini", "score", None, **p).metric_value == pytest.approx(0.388525, abs=1e-6)


def test_split_psi(frames):
    p = {"variable": "score", "score_col": "score", "var_type": "score", "cut_off_probability": 0.5}
    bins = [{"bin": 1, "lb": float("-inf"), "ub": 0.3}, {"bin": 2, "lb": 0.3, "ub": 0.7}, {"bin": 3, "lb": 0.7, "ub": float("inf")}]
    approved = run(frames, "psi_approved", "score", "score_base", bins=bins, **p)
    rejected = run(frames, "psi_rejected", "score", "score_base", bins=bins, **p)
    assert approved.metric_value == pytest.approx(_psi([0, 2, 4], [0, 2, 2]))
    assert rejected.metric_value == pytest.approx(_psi([2, 2, 0], [4, 2, 0]))
    with pytest.raises(ValueError):
        calculate("psi_approved", frames["score"], frames["score_base"], {}, **p)
    with pytest.raises(ValueError):
        calculate("psi_rejected", frames["score"], None, {}, bins=bins, **p)


@pytest.mark.parametrize(
    "name,value,base",
    [
        ("auc", 0.791667, 0.583333),
        ("gini", (0.166667 - 0.583333) / 0.166667, 0.166667),
        ("brier_score", (0.249 - 0.28525) / 0.28525, 0.28525),
        ("lift_top_decile", 0.0, 2.5),
        ("calibration_slope", abs(0.5939 - 0.230105) / 0.230105, 0.230105),
        ("ks_score_target", abs(0.583333 - 0.333333) / 0.333333, 0.333333),
    ],
)
def test_conjugate(frames, name, value, base):
    r = run(frames, name, "joined", "joined_base", variable="__SCORE__", var_type="conjugate")
    assert r.metric_value == pytest.approx(value, abs=2e-4)
    assert r.baseline_value == pytest.approx(base, abs=1e-5)


def test_conjugate_alone(frames):
    assert run(frames, "auc", "joined").metric_value == pytest.approx(0.791667, abs=1e-6)
    assert run(frames, "lift_top_decile", "joined").metric_value == pytest.approx(2.5)
    assert run(frames, "auc", "joined").status == "NOT_APPLICABLE"


def test_target(frames):
    p = {"variable": "target", "target_col": "target", "var_type": "target"}
    r = run(frames, "event_rate", "target", "target_base", **p)
    assert r.metric_value == 0.0 and r.baseline_value == pytest.approx(0.4)
    assert run(frames, "psi_target", "target", "target_base", **p).metric_value == pytest.approx(0.0, abs=1e-12)
    bins = [{"bin": 1, "bin_type": "CATEGORICAL", "category_value": "0", "count_dev": 700},
            {"bin": 2, "bin_type": "CATEGORICAL", "category_value": "1", "count_dev": 300}]
    assert run(frames, "psi_target", "target", "target_base", bins=bins, **p).metric_value == pytest.approx(_psi([6, 4], [700, 300]))


def test_correlation_drift(spark):
    cur = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (None, 1.0)], "a double, b double")
    base = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 6.5)], "a double, b double")
    r = one(calculate("correlation_drift", cur, base, {}, variable="__INPUTS__"))
    assert r.metric_value == pytest.approx(abs(abs(cur.stat.corr("a", "b")) - abs(base.stat.corr("a", "b"))))


def test_bin_counts_are_the_same_where_bins_are_too_many_to_broadcast(spark, monkeypatch):
    from modelmon.operators import bins

    rows = spark.range(4000).selectExpr(
        "'m' AS model_id", "'2024-01-01' AS information_date", "'raw' AS var_type", "'v' AS variable",
        "CASE WHEN id % 2 = 0 THEN 'current' ELSE 'baseline' END AS side", "CASE WHEN id % 3 = 0 THEN 5.0D ELSE CAST(id % 97 AS DOUBLE) END AS value",
    )
    made = bins.numeric_bins(rows)
    wanted = sorted(map(tuple, bins.bin_counts(rows, made).select("bin", "n_cur", "n_base").collect()), key=str)
    monkeypatch.setattr(bins, "fits", lambda df: False)
    assert sorted(map(tuple, bins.bin_counts(rows, made).select("bin", "n_cur", "n_base").collect()), key=str) == wanted
    assert sum(n for _, n, _ in wanted) == 2000


def test_availability_rows_are_dealt_before_grouping(spark):
    rows = spark.range(0, 3000, 1, 1).select(
        F.format_string("m%d", F.col("id") % 1500).alias("model_id"), F.lit("2024-03-01").cast("date").alias("information_date"),
        F.lit("wh").alias("source_schema"), F.format_string("t%d", F.col("id") % 1500).alias("source_table"), F.lit(3).alias("deadline_days"),
    )
    newest = spark.createDataFrame([("t1", "2024-03-02"), ("t2", "2024-01-01")], "source_table string, d string").select("source_table", F.col("d").cast("date").alias("max_date"))
    found = data_availability(rows, newest, F.lit("2024-05-01").cast("date"))
    # Rows of one task, nearly each a group: no task groups them before they are dealt out.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.index("partial_first") < plan.index("REPARTITION_BY_NUM")
    lights = {r.model_id: (r.control, r.deadline_data_ingestion) for r in found.collect()}
    assert len(lights) == 1500 and lights["m1"] == (UPDATED, "2024-03-04") and lights["m2"][0] == LATE and lights["m3"][0] == NO_DATA
