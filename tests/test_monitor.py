"""A whole run on the ten-row frames: score, target, two inputs over three sources."""

import glob

import pytest
from pyspark.sql import functions as F

from modelmon.plans.feeds import ConfigTables
from modelmon.plans.monitor import Monitor, measured, run_models
from modelmon.sources.sinks import KeptTables
from tests.conftest import BASE, CUR

MODEL = "M1"


def config_tables(spark, frames):
    # Daily model: the day before 2025-01-02 is the baseline, so the fixture dates are swapped.
    def swapped(cur, base):
        return cur.withColumn("information_date", F.lit(BASE)).unionByName(base.withColumn("information_date", F.lit(CUR)))

    sources = {
        "scores": swapped(frames["score"], frames["score_base"]),
        "targets": swapped(frames["target"], frames["target_base"]),
        "raw": swapped(frames["raw"], frames["raw_base"]),
    }
    for name, df in sources.items():
        df.createOrReplaceTempView(name)
    d = "2025-01-01"
    summary = spark.createDataFrame([(MODEL, d, 0.5, "daily")], "model_id string, process_date string, cut_off_probability double, frequency string")
    meta = spark.createDataFrame(
        [("score", "score", "numeric", "scores", "score"), ("target", "target", "numeric", "targets", "target"),
         ("age", "input", "numeric", "raw", "age"), ("age2", "raw", "numeric", "raw", "age"),
         ("category", "input", "categorical", "raw", "category")],
        "variable string, var_type string, data_type string, source_table string, source_column string",
    ).withColumns({"process_date": F.lit(d), "model_id": F.lit(MODEL)})
    conf = spark.createDataFrame(
        [("score", "scores"), ("target", "targets"), ("raw", "raw")], "table_role string, source_table string"
    ).withColumns({
        "table_name": F.col("table_role"), "source_type": F.lit("hive"), "source_schema": F.lit(""),
        "entity_key_columns": F.lit('["customer_id"]'), "canonical_key_columns": F.lit('["customer_id"]'),
        "date_column": F.lit("information_date"), "date_format": F.lit(""), "history_months": F.lit(1), "lag": F.lit(0),
        "sql_transform": F.lit(""), "partition_columns": F.lit("[]"), "reading_mode": F.lit("each"),
        "use_business_days": F.lit(True), "active": F.lit(True), "process_date": F.lit(d), "model_id": F.lit(MODEL),
        "deadline_days": F.lit(5),
    })
    bins = spark.createDataFrame(
        [(i + 1, "NUMERIC", lo, hi) for i, (lo, hi) in enumerate([(float("-inf"), 0.3), (0.3, 0.7), (0.7, float("inf"))])],
        "bin int, bin_type string, lb double, ub double",
    ).withColumns({"lower_bound_type": F.lit(">"), "upper_bound_type": F.lit("<="), "variable": F.lit("score"),
                   "type": F.lit("score"), "process_date": F.lit(d), "model_id": F.lit(MODEL)})
    policy = spark.createDataFrame([("category", 2, 5, d, MODEL)], "variable string, top_n_threshold int, critical_top_k int, process_date string, model_id string")
    calendar = spark.range(1).select(F.explode(F.expr("sequence(date'2024-12-01', date'2025-02-28')")).alias("calendar_date")).withColumn("is_business_day", F.lit(True))
    return ConfigTables(summary, meta, conf, calendar, category_policy=policy, csi_bins=bins)


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))


def asked(spark):
    return spark.createDataFrame([(MODEL, BASE), (MODEL, "2099-01-01")], "model_id string, information_date string")


@pytest.fixture(scope="module")
def written(spark, frames, out):
    store = KeptTables(spark, f"{out}/kept")
    paths = run_models(spark, config_tables(spark, frames), asked(spark), out, "exec-1", store=store, as_of=F.lit("2025-01-03").cast("date"))
    return {t: spark.read.parquet(p) for t, p in paths.items()}


def test_results(written):
    rows = {(r.variable, r.metric_name): r for r in written["metric_result"].collect()}
    assert rows["age", "null_rate"].metric_value == pytest.approx(0.1)
    assert rows["age", "null_rate"].status == "RED"
    assert rows["category", "category_composition_drift"].metric_value == pytest.approx(2 / 3)
    assert rows["age", "ks_vs_dev"].metric_value == pytest.approx(0.3)
    assert rows["score", "range_violation"].status == "RED"
    assert rows["score", "approval_rate"].metric_value == pytest.approx(0.5)
    assert rows["__SCORE__", "auc"].metric_value == pytest.approx(0.791667, abs=1e-6)
    assert rows["__SCORE__", "auc"].status == "NOT_APPLICABLE"
    assert rows["__SCORE__", "lift_top_decile"].metric_value == pytest.approx(0.0)
    assert rows["__INPUTS__", "correlation_drift"].metric_value == pytest.approx(0.0, abs=1e-9)
    assert rows["age", "completeness"].metric_value == 0.0
    per = {}
    for variable, metric in rows:
        per.setdefault(variable, set()).add(metric)
    assert len(per["score"]) == 11 and len(per["target"]) == 3 and len(per["__SCORE__"]) == 6
    assert len(per["age"]) == 9 and len(per["category"]) == 8


def test_rollups(written):
    alerts = {r.var_type: r for r in written["alert_aggregate"].collect()}
    assert set(alerts) == {"score", "target", "input", "raw", "conjugate"}
    a = alerts["score"]
    assert a.total_metrics == 11
    assert a.equivalent_yellow == a.count_ambar + 2 * a.count_red
    assert a.stress_ratio == pytest.approx(a.equivalent_yellow / 22)
    log = {str(r.information_date): r for r in written["execution_log"].collect()}
    assert log[BASE].status == "SUCCESS" and log["2099-01-01"].status == "MISSING_DATA"
    assert log[BASE].variables_expected == 7
    s = written["scoring_summary"].collect()
    assert len(s) == 1 and s[0].population_scored == 10 and s[0].control_data_availability == "DONE"
    stats = {(r.variable, r.statistic): r for r in written["variable_summary"].collect()}
    assert stats["age", "count_null"].statistic_value == 1
    assert stats["category", "top_category"].statistic_value_str == "A"
    assert stats["score", "p50"].statistic_value == pytest.approx(0.55)
    late = {(str(r.information_date), r.source_table): r.control for r in written["data_availability"].collect()}
    assert late[BASE, "raw"] == "Latest Data Updated" and late["2099-01-01", "raw"] == "Data ingestion in progress"


def test_reuse_measures_nothing(spark, frames, written, out, monkeypatch):
    monitor, store, runs = Monitor(spark, config_tables(spark, frames)), KeptTables(spark, f"{out}/kept"), asked(spark)
    monkeypatch.setattr(Monitor, "run", lambda self, runs: pytest.fail("measured again"))
    kept = measured(monitor, runs, runs, store, None)
    assert kept.results.count() == written["metric_result"].count()
    monitor.config.thresholds = spark.createDataFrame([(MODEL, 1)], "model_id string, x int")
    with pytest.raises(pytest.fail.Exception):
        measured(monitor, runs, runs, store, None)


def many_models(config, spark, frames, names):
    """The configuration of MODEL under several names; all read the same sources."""
    each = F.explode(F.array(*[F.lit(n) for n in names]))
    copy = lambda df: None if df is None else df.drop("model_id").withColumn("model_id", each)
    return ConfigTables(*[copy(df) if name != "calendar" else df for name, df in vars(config).items()])


def plan_size(df):
    return df._jdf.queryExecution().analyzed().toString().count("\n")


def joint_plans(spark, config, names):
    monitor = Monitor(spark, config)
    dates, lagged = monitor.resolved(spark.createDataFrame([(n, BASE) for n in names], "model_id string, information_date string"))
    literals = monitor.feeds.read_dates(dates)
    joint = monitor.joint_inputs(dates, literals)
    return [plan_size(monitor.pairs(dates, lagged, literals)), len(joint), plan_size(joint[0][0])]


def test_plans_follow_sources_not_models(spark, frames):
    config, names = config_tables(spark, frames), [f"F{i}" for i in range(20)]
    assert joint_plans(spark, many_models(config, spark, frames, names), names) == joint_plans(spark, config, [MODEL])


def test_fleet_equals_single_models(spark, frames, written):
    names = ["A", "B"]
    config = many_models(config_tables(spark, frames), spark, frames, names)
    # The second model leaves an input out, so the two share sources but not columns.
    config.variable_metadata = config.variable_metadata.where("NOT (model_id = 'B' AND variable = 'category')")
    found = Monitor(spark, config).run(spark.createDataFrame([(n, BASE) for n in names], "model_id string, information_date string")).results
    rows = {(r.model_id, r.variable, r.metric_name): r.metric_value for r in found.collect()}
    alone = {(r.variable, r.metric_name): r.metric_value for r in written["metric_result"].where(F.col("information_date") == BASE).collect()}
    for name in names:
        assert {k[1:]: pytest.approx(v, abs=1e-12) for k, v in rows.items() if k[0] == name} == {
            k: v for k, v in alone.items() if name == "A" or k[0] != "category"
        }


def test_correlations_of_own_columns(spark):
    from modelmon.operators.stability import correlation

    data = [(m, "d", "input", "v", s, float(i), float(i * i % 7), float(-i)) for m in ("A", "B") for s in ("current", "baseline") for i in range(9)]
    rows = spark.createDataFrame(data, "model_id string, information_date string, var_type string, variable string, side string, a double, b double, c double")
    found = {r.model_id: r.corr_cur for r in correlation(rows, ["a", "b", "c"], own={"A": ["a", "b"], "B": ["c", "a"]}).collect()}
    alone = correlation(rows.where("model_id = 'A'"), ["a", "b"]).first().corr_cur
    assert found["B"] == pytest.approx(1.0) and found["A"] == pytest.approx(alone) and alone < 0.9
    twice = correlation(rows.where("model_id = 'A'"), ["a"], own={"A": ["a", "a"]}).first()
    assert twice.corr_cur == pytest.approx(1.0)


def test_failed_and_undefined(spark, frames, tmp_path):
    names = ["good", "lost", "odd"]
    config = many_models(config_tables(spark, frames), spark, frames, names)
    meta = config.variable_metadata
    table = F.when((F.col("model_id") == "lost") & (F.col("variable") == "age"), "nowhere").otherwise(F.col("source_table"))
    column = F.when((F.col("model_id") == "odd") & (F.col("variable") == "age2"), "wrong").otherwise(F.col("source_column"))
    config.variable_metadata = meta.withColumns({"source_table": table, "source_column": column})
    spark.table("scores").withColumn("score", F.when(F.col("information_date") != BASE, F.col("score"))).createOrReplaceTempView("scores")
    runs = spark.createDataFrame([(n, BASE) for n in names], "model_id string, information_date string")
    paths = run_models(spark, config, runs, str(tmp_path), "exec-3", as_of=F.lit("2025-01-03").cast("date"))
    config_tables(spark, frames)
    log = {r.model_id: r for r in spark.read.parquet(paths["execution_log"]).collect()}
    assert {m: r.status for m, r in log.items()} == {"good": "SUCCESS", "lost": "FAILED", "odd": "FAILED"}
    assert log["lost"].error_message == "table metadata not found for nowhere" and "missing columns ['wrong'] in raw" == log["odd"].error_message
    results = spark.read.parquet(paths["metric_result"])
    assert results.select("model_id").distinct().count() == 1
    assert results.where("metric_value IS NULL").count() == 0
    # No score in the current month: no tail of it, and no squared error against the outcome.
    assert log["good"].metrics_failed == 2
    tail = results.where("metric_name = 'tail_shift'").first()
    assert (tail.metric_value, tail.status) == (0.0, "GREEN")


def test_nothing_left_to_measure(spark, frames):
    config = config_tables(spark, frames)
    config.variable_metadata = config.variable_metadata.withColumn("source_table", F.lit("nowhere"))
    found = Monitor(spark, config).run(asked(spark))
    assert found.results.count() == 0 and found.missing.count() == 0 and found.failed.select("information_date").distinct().count() == 2


def test_corrected_source_is_measured_again(spark, frames, out, written, tmp_path, monkeypatch):
    config, runs = config_tables(spark, frames), asked(spark)
    store = KeptTables(spark, f"{out}/kept")
    raw = spark.table("raw")
    raw.withColumn("age", F.col("age") + F.when(F.col("customer_id") == 3, 1.0).otherwise(0.0)).createOrReplaceTempView("raw")
    monkeypatch.setattr(Monitor, "run", lambda self, runs: pytest.fail("measured again"))
    with pytest.raises(pytest.fail.Exception):
        measured(Monitor(spark, config), runs, runs, store, None)
    raw.createOrReplaceTempView("raw")
    config_tables(spark, frames)

    def version(path, value, mode):
        spark.createDataFrame([(1, "2025-01-01", value)], "customer_id long, information_date string, age double").write.mode(mode).partitionBy("information_date").parquet(path)
        own = config_tables(spark, frames)
        own.table_config = own.table_config.withColumns({
            "source_type": F.when(F.col("source_table") == "raw", "PARQUET").otherwise(F.col("source_type")),
            "table_name": F.when(F.col("source_table") == "raw", F.lit(path)).otherwise(F.col("table_name")),
            "source_table": F.when(F.col("source_table") == "raw", F.lit(path)).otherwise(F.col("source_table")),
        })
        own.variable_metadata = own.variable_metadata.where("variable != 'category'").withColumn(
            "source_table", F.when(F.col("source_table") == "raw", F.lit(path)).otherwise(F.col("source_table"))
        )
        return {k: v for k, v in Monitor(spark, own).feeds.sources_version().items() if path in k}

    path = str(tmp_path / "raw")
    first = version(path, 5.0, "overwrite")
    assert len(first) == 1 and version(path, 5.0, "ignore") == first and version(path, 6.0, "append") != first


def test_runs_leave_no_intermediate_tables(spark, frames, tmp_path, monkeypatch):
    from modelmon.functions.sizes import reliable, run_tables, shared_folder, side_by_side

    shared = f"{shared_folder(spark).removeprefix('file:')}/fixed"
    left = lambda: set(glob.glob(f"{shared}/run-*"))
    before = left()
    with run_tables(spark) as folder:
        found = side_by_side([lambda: reliable(spark.range(3)), lambda: reliable(spark.range(4))])
        assert [df.count() for df in found] == [3, 4] and len(glob.glob(f"{folder.removeprefix('file:')}/*")) == 2
        with pytest.raises(ZeroDivisionError), run_tables(spark):
            reliable(spark.range(2))
            1 / 0
        assert found[0].count() == 3
    assert left() == before
    monkeypatch.setattr(Monitor, "availability", lambda self, runs, as_of=None: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_models(spark, config_tables(spark, frames), asked(spark), str(tmp_path), "exec-4")
    assert left() == before and not glob.glob(f"{tmp_path}/*")


def test_baseline_date_of_stored_bins(written):
    rows = written["metric_result"].where("variable = 'score'").collect()
    dates = {r.metric_name: r.baseline_process_date for r in rows}
    assert {m for m, d in dates.items() if d} <= {"psi_canonical", "psi_approved", "psi_rejected"}
    assert dates["psi_canonical"] == "2025-01-01" and dates["null_rate"] is None


def test_rerun_leaves_nothing_of_the_run_before(spark, frames, written, out):
    config = config_tables(spark, frames)
    for name in ("scores", "targets", "raw"):
        spark.table(name).where(F.col("information_date") != BASE).createOrReplaceTempView(name)
    runs = spark.createDataFrame([(MODEL, BASE)], "model_id string, information_date string")
    paths = run_models(spark, config, runs, out, "exec-2", as_of=F.lit("2025-01-03").cast("date"))
    log = [(r.execution_id, r.status) for r in spark.read.parquet(paths["execution_log"]).where(F.col("information_date") == BASE).collect()]
    assert log == [("exec-2", "MISSING_DATA")]
    assert not glob.glob(f"{paths['metric_result']}/information_date={BASE}/*") and not glob.glob(f"{paths['alert_aggregate']}/information_date={BASE}/*")
    config_tables(spark, frames)
