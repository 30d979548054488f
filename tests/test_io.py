"""Sources, configuration parsing, sinks."""

import pytest
from pyspark.sql import functions as F

from modelmon import schemas
from modelmon.functions.columns import one_per_key
from modelmon.functions.dates import date_pattern, parse_date
from modelmon.sources import config, reader, sinks


def test_uris():
    spec = reader.SourceSpec.from_uri("hive:default.scores")
    assert (spec.source_type, spec.schema, spec.table_or_path) == ("HIVE", "default", "scores")
    assert reader.SourceSpec.from_uri("scores").schema is None
    assert reader.SourceSpec.from_uri("db.t").schema == "db"
    spec = reader.SourceSpec.from_uri("parquet:/data/x.parquet", partition_columns='["d"]')
    assert (spec.source_type, spec.table_or_path, spec.partition_columns) == ("PARQUET", "/data/x.parquet", ["d"])
    with pytest.raises(ValueError):
        reader.load(None, reader.SourceSpec("JDBC", None, "t"))


def test_text_helpers():
    assert reader.split_expressions("a, coalesce(b, c) AS d, e") == ["a", "coalesce(b, c) AS d", "e"]
    assert reader.date_literals(["2024-01-05", "2024-01-20", "2024-02-01"], "%Y%m") == ["202401", "202402"]
    assert date_pattern("%Y-%m") == "yyyy-MM" and date_pattern(None) is None
    with pytest.raises(ValueError):
        date_pattern("%j")


def test_parsing(spark):
    df = spark.createDataFrame(
        [('["a", "b"]', "7", None, "199912"), ("a, b ,", "x", "YES", "bad"), ("", "", "off", None), ('{"a": 1}', "1.5", "t", "202402")],
        "l string, i string, b string, d string",
    ).coalesce(1)
    rows = df.select(
        config.parse_list(F.col("l")).alias("l"), config.parse_int(F.col("i")).alias("i"), config.parse_bool(F.col("b")).alias("b"),
        parse_date(F.col("d"), "%Y%m").cast("string").alias("d"),
    ).collect()
    assert [r.l for r in rows] == [["a", "b"], ["a", "b"], [], []]
    assert [r.i for r in rows] == [7, None, None, None]
    assert [r.b for r in rows] == [True, True, False, True]
    assert [r.d for r in rows] == ["1999-12-01", None, None, "2024-02-01"]


def test_read_prunes_and_pushes_down(spark, sf_dir):
    spec = reader.SourceSpec("PARQUET", None, f"{sf_dir}/orders.parquet", "o_totalprice", "o_orderpriority", key_columns=["o_orderkey"], canonical_keys=["id"])
    df = reader.read(spark, spec, ["1-URGENT"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.columns == ["o_totalprice", "o_orderpriority", "id"]
    assert "o_custkey" not in plan.split("ReadSchema")[1] and "PushedFilters: [" in plan and "o_orderpriority" in plan.split("PushedFilters")[1]
    with pytest.raises(ValueError, match="missing columns"):
        reader.read(spark, spec.with_column("nope"))


def rows_for(spark, date, n, value=1.0):
    return spark.range(n).select(F.lit(date).alias("information_date"), F.lit("M").alias("model_id"), F.lit(value).alias("value"))


def test_write_partition(spark, tmp_path):
    path, audit = f"{tmp_path}/t", f"{tmp_path}/audit"
    done = sinks.write_partition(rows_for(spark, "d1", 5), path, audit_path=audit)
    assert (done["status"], done["row_count"]) == ("PROMOTED", 5)
    sinks.write_partition(rows_for(spark, "d2", 3), path, audit_path=audit)
    sinks.write_partition(rows_for(spark, "d1", 2, 9.0), path, audit_path=audit)
    assert {(r.information_date, r.n) for r in spark.read.parquet(path).groupBy("information_date").agg(F.count("*").alias("n")).collect()} == {("d1", 2), ("d2", 3)}

    def refuse(df):
        raise ValueError("bad rows")

    with pytest.raises(RuntimeError, match="no rows"):
        sinks.write_partition(rows_for(spark, "d1", 0), path)
    with pytest.raises(ValueError, match="bad rows"):
        sinks.write_partition(rows_for(spark, "d1", 7), path, extra_validation=refuse)
    with pytest.raises(ValueError, match="unsupported"):
        sinks.write_partition(rows_for(spark, "d1", 1), path, ["value"])
    assert spark.read.parquet(path).count() == 5
    state = sinks.audit_state(spark.read.parquet(audit)).collect()
    assert len(state) == 3 and {r.status for r in state} == {"PROMOTED"} and all(r.row_count_final == r.row_count_temp for r in state)


def test_mirror(spark, tmp_path):
    path = f"{tmp_path}/mirror"
    sinks.sync_mirror(rows_for(spark, "d1", 2).unionByName(rows_for(spark, "d2", 2)), path)
    sinks.sync_mirror(rows_for(spark, "d2", 3), path, information_date="d1")
    assert spark.read.parquet(path).select("information_date").distinct().collect()[0][0] == "d2"
    sinks.sync_mirror(rows_for(spark, "d2", 3).unionByName(rows_for(spark, "d3", 1)), path)
    assert {(r.information_date, r["count"]) for r in spark.read.parquet(path).groupBy("information_date").count().collect()} == {("d2", 3), ("d3", 1)}


def test_mirror_of_many_models(spark, tmp_path):
    path, day, model = f"{tmp_path}/mirror", F.col("information_date"), F.col("model_id")

    def state():
        return {tuple(r) for r in spark.read.schema(rows.schema).parquet(path).select("information_date", "model_id", "v").collect()}

    rows = spark.range(600).select(
        F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("information_date"),
        F.when(F.col("id") > 2, F.format_string("%03d", F.floor(F.col("id") / 3))).alias("model_id"), F.col("id").alias("v"),
    )
    held = {tuple(r) for r in rows.collect()}
    sinks.sync_mirror(rows, path)
    # 600 parts are far fewer files, and nothing of a model's text is lost.
    assert len(list((tmp_path / "mirror").rglob("*.parquet"))) < 60 and state() == held
    # One model on one date, then on all dates: the others stay, those without a model too.
    changed = rows.withColumn("v", -F.col("v"))
    sinks.sync_mirror(changed, path, "2024-01-02", "007")
    held = {(d, m, -v if (d, m) == ("2024-01-02", "007") else v) for d, m, v in held}
    assert state() == held
    sinks.sync_mirror(changed.where((model == "008") & (day < "2024-01-03")), path, model_id="008")
    held = {(d, m, -v if m == "008" else v) for d, m, v in held if (d, m) != ("2024-01-03", "008")}
    assert state() == held
    # The last model of a date takes the date with it.
    sinks.sync_mirror(rows.where("v = 3"), path)
    sinks.sync_mirror(rows.where("v < 0"), path, model_id="001")
    assert state() == set() and not [p for p in (tmp_path / "mirror").iterdir() if p.is_dir()]
    sinks.sync_mirror(rows.where("v = 3"), f"{path}2", model_id="001")
    assert spark.read.parquet(f"{path}2").count() == 1


def test_kept_tables(spark, tmp_path):
    store = sinks.KeptTables(spark, str(tmp_path))
    assert store.find("t", {"a": 1, "b": "x"}) is None
    store.keep(spark.range(2), "t", {"a": 1, "b": "x"})
    store.keep(spark.range(0), "none", {"a": 1})
    assert store.find("t", {"b": "x", "a": 1}).count() == 2 and store.find("none", {"a": 1}).count() == 0
    assert store.find("t", {"a": 2, "b": "x"}) is None and store.find("u", {"a": 1, "b": "x"}) is None
    (tmp_path / "t" / store.place("t", {"a": 1, "b": "x"}).split("/")[-1] / "_SUCCESS").unlink()
    assert store.find("t", {"a": 1, "b": "x"}) is None
    store.forget("none", {"a": 1})
    assert store.find("none", {"a": 1}) is None


def test_dropped_partitions(spark, tmp_path):
    path = f"{tmp_path}/table"
    rows = spark.createDataFrame([("d1", "a:b", 1), ("d1", "c", 2), ("d2", "c", 3)], "information_date string, model_id string, v int")
    sinks.replace_partitions(rows, path, ["information_date", "model_id"])
    gone = spark.createDataFrame([("d1", "a:b"), ("d9", "z")], "information_date string, model_id string")
    sinks.drop_partitions(gone, path, ["information_date", "model_id"])
    assert {r.v for r in spark.read.parquet(path).collect()} == {2, 3}
    sinks.drop_partitions(gone, f"{tmp_path}/nothing", ["information_date", "model_id"])


def test_one_per_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 2, "b"), ("b", None, None)], "k string, v int, w string").repartition(3)
    picked = one_per_key(rows, ["k"])
    assert picked.columns == rows.columns and {tuple(r) for r in picked.collect()} == {("a", 2, "b"), ("b", None, None)}
    assert one_per_key(rows.select("k"), ["k"]).count() == 2


def test_schemas(spark):
    assert len(schemas.TABLES) == 20 and schemas.columns("x.metric_result")[-2:] == ["information_date", "model_id"]
    padded = schemas.conform(spark.range(1).select(F.lit("v").alias("variable")), "metric_result")
    assert padded.columns == schemas.columns("metric_result") and padded.first()["metric_value"] is None
    with pytest.raises(KeyError):
        schemas.get("nope")


def test_upsert_and_insert_ignore(spark):
    old = spark.createDataFrame([("d1", True, 1), ("d2", True, 5)], "calendar_date string, is_business_day boolean, v int").coalesce(1)
    new = spark.createDataFrame([("d1", False, 1), ("d2", False, 4), ("d3", True, 1)], "calendar_date string, is_business_day boolean, v int").coalesce(1)
    rows = {r.calendar_date: (r.is_business_day, r.v) for r in sinks.upsert(old, new, ["calendar_date"], "v").collect()}
    assert rows == {"d1": (False, 1), "d2": (True, 5), "d3": (True, 1)}
    assert [r.calendar_date for r in sinks.insert_ignore(old, new, ["calendar_date"]).collect()] == ["d3"]
    days = spark.createDataFrame([("2025-01-01",), ("2024-11-01",)], "calendar_date string").coalesce(1)
    recent = sinks.recent_calendar(days.withColumn("calendar_date", F.col("calendar_date").cast("date")), F.lit("2025-01-15").cast("date"))
    assert recent.count() == 1


def test_views(spark):
    from modelmon.operators import dashboard

    res = spark.createDataFrame([("M", "d", "raw", "m1", 1.0, "RED"), ("M", "d", "score", "m2", 2.0, "GREEN")], "model_id string, information_date string, var_type string, metric_name string, metric_value double, status string")
    alerts = spark.createDataFrame([("M", "d", "raw", "RED", 0.5), ("M", "d", "score", "GREEN", 0.1)], "model_id string, information_date string, var_type string, aggregate_status string, stress_ratio double")
    log = spark.createDataFrame([("M", "d", "SUCCESS", 0)], "model_id string, information_date string, status string, variables_missing int")
    for name, df in (("v_res", res), ("v_alerts", alerts), ("v_log", log)):
        df.coalesce(1).createOrReplaceTempView(name)
    dashboard.create_views(spark, "v_res", "v_alerts", "v_log", "v_sem", "v_sum")
    assert spark.table("v_sem").count() == 4  # alerts meet every metric of the run
    assert dashboard.semaphore_view(res, alerts, log, match_var_type=True).count() == 2
    assert spark.table("v_sum").first()["raw_status"] == "RED"
