"""Sources, sinks, configuration, projections and set operations as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import data
from checks.catalog import Tables, check, iso, month, r6, scratch
from checks.data import LOG, NUM, RES, TXT
from modelmon import schemas
from modelmon.functions.columns import KEYS, smallest_per_key, union_all
from modelmon.functions.dates import format_date, parse_date
from modelmon.functions.ordering import top_per_group
from modelmon.functions.columns import first_rank_key
from modelmon.operators import bins, dashboard, observations, quality, runs, score, summary
from modelmon.sources import config, reader, sinks

BY_STATUS = """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) + 0.0 AS total FROM orders GROUP BY 1"""


def by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), r6(F.sum("o_totalprice"), 2).alias("total"))


# -- scans ------------------------------------------------------------------------------


@check("scan_catalog", BY_STATUS)
def scan_catalog(t):
    t.orders.createOrReplaceTempView("mm_orders")
    return by_status(reader.load(t.spark, reader.SourceSpec.from_uri("hive:mm_orders")))


@check("scan_parquet", BY_STATUS)
def scan_parquet(t):
    return by_status(reader.load(t.spark, reader.SourceSpec.from_uri(f"parquet:{t.sf_dir}/orders.parquet")))


@check("scan_csv", BY_STATUS)
def scan_csv(t):
    path = scratch(t, "csv")
    t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").write.option("header", True).csv(path)
    return by_status(reader.read_csv(t.spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double"))


MONTHS = [f"{y}-{m:02d}-01" for y in range(1990, 2010) for m in range(1, 13)]


@check("source_read", """SELECT o_orderkey AS order_id, o_totalprice AS price, strftime(o_orderdate, '%Y%m') AS ym FROM orders""")
def source_read(t):
    spec = reader.SourceSpec(
        "PARQUET", None, f"{t.sf_dir}/orders.parquet", "price", "ym", "%Y%m", ["o_orderkey"], ["order_id"],
        sql_transform="o_orderkey, o_totalprice AS price, date_format(o_orderdate, 'yyyyMM') AS ym, o_orderstatus",
    )
    return reader.read(t.spark, spec, MONTHS)


@check("source_spec", " UNION ALL ".join(f"SELECT '{x}' AS table_name, 'PARQUET' AS source_type, count(*) AS n FROM {x}" for x in ("orders", "lineitem", "events", "customer")))
def source_spec(t):
    frames = []
    for name in ("orders", "lineitem", "events", "customer"):
        spec = reader.SourceSpec.from_uri(f"parquet:{t.sf_dir}/{name}.parquet")
        rows = reader.load(t.spark, spec).agg(F.count("*").alias("n"))
        frames.append(rows.select(F.lit(name).alias("table_name"), F.lit(spec.source_type).alias("source_type"), "n"))
    return union_all(frames)


def config_rows(t: Tables):
    """Table configuration rows in every spelling, one per part."""
    p, k = t.part, F.col("p_partkey")
    keys = F.when(k % 3 == 0, F.concat(F.lit('["k'), k, F.lit('", "x"]'))).when(k % 3 == 1, F.concat(F.lit("k"), k, F.lit(" , x"))).otherwise("")
    return p.select(
        F.concat(F.lit("M"), (k % 50)).alias("model_id"),
        F.concat(F.lit("2024-0"), (F.col("p_size") % 3 + 1), F.lit("-01")).alias("process_date"),
        F.upper("p_type").alias("table_role"), F.upper("p_name").alias("table_name"),
        F.when(k % 2 == 0, "hive").otherwise("Parquet").alias("source_type"), F.lit("").alias("source_schema"),
        F.concat(F.lit("t"), k).alias("source_table"), keys.alias("entity_key_columns"), keys.alias("canonical_key_columns"),
        F.lit("d").alias("date_column"), F.lit("").alias("date_format"),
        F.when(k % 4 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string")).alias("lag"),
        F.lit("12").alias("history_months"), F.lit("").alias("sql_transform"), F.lit("[]").alias("partition_columns"),
        F.when(k % 5 == 0, F.lit(None)).otherwise("last").alias("reading_mode"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "Yes").when(k % 5 == 2, "no").when(k % 5 == 3, "T").otherwise("0").alias("use_business_days"),
        F.when(k % 7 == 0, "false").otherwise("true").alias("active"), F.lit("x").alias("deadline_days"),
    )


CFG = """cfg AS (SELECT 'M' || (p_partkey % 50) AS model_id, '2024-0' || (p_size % 3 + 1) || '-01' AS process_date, p_partkey, p_type, p_name, p_size FROM part),
  lat AS (SELECT cfg.* FROM cfg JOIN (SELECT model_id, max(process_date) AS process_date FROM cfg GROUP BY 1) USING (model_id, process_date))"""


@check("table_config_load", f"""WITH {CFG} SELECT model_id, process_date, lower(p_type) AS table_role, CASE WHEN p_partkey % 2 = 0 THEN 'HIVE' ELSE 'PARQUET' END AS source_type,
  't' || p_partkey AS source_table, CASE WHEN p_partkey % 3 = 2 THEN '' ELSE 'k' || p_partkey || '|x' END AS keys,
  coalesce(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END, -1) AS lag, CASE WHEN p_partkey % 5 = 0 THEN 'each' ELSE 'last' END AS reading_mode,
  p_partkey % 5 IN (0, 1, 3) AS use_business_days FROM lat WHERE p_partkey % 7 <> 0""")
def table_config_load(t):
    loaded = config.load_table_config(config_rows(t))
    return loaded.select(
        "model_id", "process_date", "table_role", "source_type", "source_table",
        F.concat_ws("|", "entity_key_columns").alias("keys"), F.coalesce("lag", F.lit(-1)).alias("lag"),
        "reading_mode", "use_business_days",
    )


@check("parse_config_lists", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN '' ELSE 'k' || p_partkey || '|x' END AS entries,
  CASE WHEN p_partkey % 3 = 2 THEN 0 ELSE 2 END AS n FROM part""")
def parse_config_lists(t):
    rows = config_rows(t).withColumn("p_partkey", F.substring("source_table", 2, 20).cast("long"))
    listed = config.parse_list(F.col("entity_key_columns"))
    return rows.select("p_partkey", F.concat_ws("|", listed).alias("entries"), F.size(listed).alias("n"))


@check("latest_partition", """SELECT 'C' || o_custkey AS model_id, strftime(o_orderdate, '%Y-%m-%d') AS process_date, o_orderkey FROM orders
  JOIN (SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1) USING (o_custkey, o_orderdate)""")
def latest_partition(t):
    rows = t.orders.select(F.concat(F.lit("C"), F.col("o_custkey")).alias("model_id"), iso("o_orderdate").alias("process_date"), "o_orderkey")
    return config.latest_partition(rows)


def versions(t: Tables):
    return t.orders.select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("model_id"), iso(month("o_orderdate")).alias("process_date"), "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", "active").otherwise("retired").alias("status"),
    )


@check("latest_global", """SELECT 'C' || o_custkey AS model_id, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS process_date, o_orderkey, 'active' AS status FROM orders
  WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders) AND o_orderstatus <> 'F'""")
def latest_global(t):
    return config.latest_global(versions(t))


def contacts(t: Tables):
    """One contact row per order of the model's customer."""
    return t.orders.select(
        F.concat(F.lit("S"), F.col("o_custkey")).alias("model_id"),
        F.concat(F.lit("u"), F.col("o_orderkey"), F.lit("@"), F.col("o_orderpriority")).alias("contact_email"),
        (F.col("o_orderstatus") != "F").alias("notify_on_red"), (F.col("o_orderstatus") == "F").alias("notify_on_ambar"),
        (F.col("o_orderstatus") == "P").alias("notify_on_missing"), iso(F.trunc("o_orderdate", "year")).alias("process_date"),
    )


CON = """con AS (SELECT 'S' || o_custkey AS model_id, 'u' || o_orderkey || '@' || o_orderpriority AS contact_email, o_orderstatus <> 'F' AS notify_on_red,
  o_orderstatus = 'F' AS notify_on_ambar, o_orderstatus = 'P' AS notify_on_missing, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS process_date FROM orders),
  lcon AS (SELECT con.* FROM con JOIN (SELECT model_id, max(process_date) AS process_date FROM con GROUP BY 1) USING (model_id, process_date))"""


@check("latest_contacts", f"WITH {CON} SELECT * FROM lcon")
def latest_contacts(t):
    return config.latest_partition(contacts(t))


@check("latest_global_config", """SELECT '[' || strftime(max(date_trunc('month', o_orderdate)), '%Y-%m') || ']' AS subject_prefix, 'ops' AS sender_name FROM orders WHERE o_orderpriority = '1-URGENT'""")
def latest_global_config(t):
    rows = t.orders.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", "global").otherwise(F.col("o_orderpriority")).alias("model_id"),
        iso(month("o_orderdate")).alias("process_date"), F.lit("ops").alias("sender_name"),
        F.concat(F.lit("["), F.date_format("o_orderdate", "yyyy-MM"), F.lit("]")).alias("subject_prefix"),
    )
    return config.latest_global_config(rows, {"subject_prefix": "[MODELMON]", "sender_name": ""})


@check("dates_in_period", """SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders WHERE o_orderpriority <> '5-LOW' AND CAST(o_orderdate AS DATE) BETWEEN '1996-01-15' AND '2000-03-10'""")
def dates_in_period(t):
    text = F.when(F.col("o_orderpriority") == "5-LOW", "unknown").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    found = reader.dates_in_period(t.orders.select(text.alias("d")), "d", "1996-01-15", "2000-03-10", "%Y%m%d")
    return found.select(iso("date").alias("date"))


@check("schema_registry", f"""WITH {RES} SELECT model_id, count(*) AS n, count(*) FILTER (metric_name IS NOT NULL) AS with_metric, 0 AS with_run_date, 15 AS n_columns FROM res GROUP BY 1""")
def schema_registry(t):
    padded = schemas.conform(data.results(t), "monitoring.metric_result")
    return padded.groupBy("model_id").agg(
        F.count("*").alias("n"), F.count("metric_name").alias("with_metric"), F.count("run_date").alias("with_run_date"),
        F.lit(len(padded.columns)).alias("n_columns"),
    )


@check("null_padding", f"""WITH {RES} SELECT model_id, information_date, variable, metric_name, metric_value, '' AS execution_id FROM res""")
def null_padding(t):
    padded = schemas.conform(data.results(t), "metric_result")
    return padded.select("model_id", "information_date", "variable", "metric_name", "metric_value", F.coalesce("execution_id", F.lit("")).alias("execution_id"))


@check("create_tables", f"WITH {RES} SELECT 'M-' || status AS model_id, information_date, count(*) AS n FROM res GROUP BY 1, 2")
def create_tables(t):
    t.spark.sql("CREATE DATABASE IF NOT EXISTS mm_checks")
    t.spark.sql("DROP TABLE IF EXISTS mm_checks.metric_result")
    schemas.create_tables(t.spark, "mm_checks", ["metric_result"], scratch(t, "tables"))
    owned = data.results(t).withColumn("model_id", F.concat(F.lit("M-"), F.col("status")))
    rows = schemas.conform(owned, "metric_result").repartition("information_date")
    rows.write.mode("append").insertInto("mm_checks.metric_result")
    return t.spark.table("mm_checks.metric_result").groupBy("model_id", "information_date").agg(F.count("*").alias("n"))


# -- sinks ------------------------------------------------------------------------------

BY_RUN = f"WITH {RES} SELECT information_date, status, count(*) AS n, round(sum(metric_value), 6) + 0.0 AS total FROM res GROUP BY 1, 2"


def by_run(df):
    return df.groupBy(F.col("information_date").cast("string").alias("information_date"), "status").agg(
        F.count("*").alias("n"), r6(F.sum("metric_value")).alias("total")
    )


@check("write_partition", BY_RUN)
def write_partition(t):
    path = scratch(t, "write")
    rows = schemas.conform(data.results(t), "metric_result").repartition("information_date")
    sinks.write_partition(rows.withColumn("metric_value", F.lit(0.0)), path, ["information_date"])
    sinks.write_partition(rows, path, ["information_date"])
    return by_run(t.spark.read.schema(schemas.get("metric_result")).parquet(path))


@check("write_audit", """SELECT CAST(o_custkey AS VARCHAR) AS staging_id, CASE WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN 'PROMOTED' ELSE 'VALIDATED' END AS status,
  max(o_orderkey) AS row_count_temp, coalesce(max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END), -1) AS row_count_final FROM orders GROUP BY 1""")
def write_audit(t):
    """The log of a write per customer: every order is an event of it, all appended in two batches."""
    path, done = scratch(t, "audit"), F.col("o_orderstatus") == "F"
    events = t.orders.select(
        F.col("o_custkey").cast("string").alias("staging_id"), F.when(done, sinks.PROMOTED).otherwise(sinks.VALIDATED).alias("status"),
        F.col("o_orderkey").cast("int").alias("row_count_temp"), F.when(done, F.col("o_orderkey")).cast("int").alias("row_count_final"),
    )
    for status in (sinks.VALIDATED, sinks.PROMOTED):
        sinks.append_audit(events.where(F.col("status") == status), path)
    state = sinks.audit_state(t.spark.read.schema(schemas.get("staging_control")).parquet(path))
    return state.select("staging_id", "status", "row_count_temp", F.coalesce("row_count_final", F.lit(-1)).alias("row_count_final"))


@check("append_rows", """SELECT variable, top_n_threshold, count(*) AS n FROM (SELECT p_brand AS variable, p_size AS top_n_threshold FROM part UNION ALL SELECT p_brand, p_size FROM part) GROUP BY 1, 2""")
def append_rows(t):
    path = scratch(t, "append")
    rows = t.part.select(F.col("p_brand").alias("variable"), F.col("p_size").alias("top_n_threshold"))
    sinks.append_rows(rows, "category_policy", path)
    sinks.append_rows(rows, "category_policy", path)
    return t.spark.read.parquet(path).groupBy("variable", "top_n_threshold").agg(F.count("*").alias("n"))


@check("insert_overwrite_year", f"""WITH {data.CAL} SELECT strftime(calendar_date, '%Y-%m') AS month, count(*) AS days, count(*) FILTER (biz) AS business_days FROM cal WHERE year(calendar_date) = 1998 GROUP BY 1""")
def insert_overwrite_year(t):
    path = scratch(t, "calendar")
    for year in (1997, 1998, 1998):
        sinks.overwrite_calendar_year(data.calendar(t), year, path)
    return t.spark.read.parquet(path).where("calendar_year = 1998").groupBy(F.date_format("calendar_date", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("days"), F.count_if("is_business_day").alias("business_days")
    )


@check("upsert_calendar", """WITH both_ AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey % 2 = 0 AS flag, o_orderkey AS v, 0 AS fresh FROM orders
  UNION ALL SELECT CAST(l_shipdate AS DATE), l_orderkey % 3 = 0, l_orderkey, 1 FROM lineitem)
  SELECT strftime(d, '%Y-%m-%d') AS calendar_date, flag AS is_business_day, v AS version FROM (SELECT *, row_number() OVER (PARTITION BY d ORDER BY v DESC, fresh DESC) AS rn FROM both_) WHERE rn = 1""")
def upsert_calendar(t):
    old = t.orders.select(F.col("o_orderdate").cast("date").alias("calendar_date"), (F.col("o_orderkey") % 2 == 0).alias("is_business_day"), F.col("o_orderkey").alias("version"))
    new = t.lineitem.select(F.col("l_shipdate").cast("date").alias("calendar_date"), (F.col("l_orderkey") % 3 == 0).alias("is_business_day"), F.col("l_orderkey").alias("version"))
    merged = sinks.upsert(old, new, ["calendar_date"], "version")
    return merged.withColumn("calendar_date", iso("calendar_date"))


@check("insert_ignore_contacts", f"""WITH {CON} SELECT DISTINCT model_id, process_date FROM con WHERE notify_on_ambar AND (model_id, process_date) NOT IN (SELECT model_id, process_date FROM con WHERE NOT notify_on_ambar)""")
def insert_ignore_contacts(t):
    rows = contacts(t).select("model_id", "process_date", "notify_on_ambar")
    added = sinks.insert_ignore(rows.where("not notify_on_ambar"), rows.where("notify_on_ambar"), ["model_id", "process_date"])
    return added.select("model_id", "process_date")


@check("materialize", BY_RUN)
def materialize(t):
    store, version = sinks.KeptTables(t.spark, scratch(t, "store")), {"sf": t.sf_dir}
    store.keep(by_run(data.results(t)), "results", version)
    return store.find("results", version)


MIR = f"""src AS (SELECT information_date, model_id FROM res), mir AS (SELECT information_date, model_id FROM log),
  plan AS (SELECT coalesce(a.information_date, b.information_date) AS information_date, coalesce(a.model_id, b.model_id) AS model_id, coalesce(a.n, 0) AS source_rows,
  coalesce(b.n, 0) AS mirror_rows, CASE WHEN a.n IS NULL THEN 'drop' ELSE 'rewrite' END AS action FROM (SELECT information_date, model_id, count(*) AS n FROM src GROUP BY 1, 2) a
  FULL JOIN (SELECT information_date, model_id, count(*) AS n FROM mir GROUP BY 1, 2) b ON a.information_date = b.information_date AND a.model_id = b.model_id)"""


@check("mirror_sync", f"WITH {RES}, {LOG}, {MIR} SELECT * FROM plan")
def mirror_sync(t):
    return sinks.mirror_plan(data.results(t), data.run_log(t))


@check("mirror_synced", f"WITH {RES} SELECT information_date, model_id, count(*) AS n FROM res GROUP BY 1, 2")
def mirror_synced(t):
    """What a mirror that held the runs of the log holds after a sync with the results."""
    path, run = scratch(t, "mirror"), ["information_date", "model_id"]
    held = data.run_log(t).select(F.lit(0.0).alias("metric_value"), *[F.col(c).cast("string").alias(c) for c in run])
    sinks.sync_mirror(held, path)
    wanted = data.results(t).select("metric_value", *[F.col(c).cast("string").alias(c) for c in run])
    sinks.sync_mirror(wanted, path)
    return t.spark.read.schema(wanted.schema).parquet(path).groupBy(*run).agg(F.count("*").alias("n"))


@check("mirror_result", f"""WITH {RES}, {LOG} SELECT information_date, model_id, count(*) AS n FROM (SELECT information_date, model_id FROM log WHERE information_date < '1998-01-01'
  UNION ALL SELECT information_date, model_id FROM res WHERE information_date >= '1998-01-01') GROUP BY 1, 2""")
def mirror_result(t):
    kept = ["information_date", "model_id"]
    merged = sinks.mirror_result(data.results(t).select(*kept), data.run_log(t).select(*kept), F.col("information_date") >= "1998-01-01")
    return merged.groupBy(*kept).agg(F.count("*").alias("n"))


# -- projections and filters ------------------------------------------------------------


@check("sql_transform", """SELECT o_orderkey, upper(trim(o_orderpriority)) AS p, coalesce(nullif(o_orderstatus, 'P'), 'none') AS s, round(o_totalprice, 1) + 0.0 AS r FROM orders""")
def sql_transform(t):
    return reader.transform(
        t.orders, "o_orderkey, upper(trim(o_orderpriority)) AS p, coalesce(nullif(o_orderstatus, 'P'), 'none') AS s, round(o_totalprice, 1) + 0.0D AS r"
    )


@check("string_exprs", "SELECT trim(c_name) AS customer, lower(c_mktsegment) AS segment, substr(c_name, 10) AS number FROM customer")
def string_exprs(t):
    return reader.transform(t.customer, ["trim(c_name) AS customer", "lower(c_mktsegment) AS segment", "substr(c_name, 10) AS number"])


@check("canonical_keys", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice FROM orders")
def canonical_keys(t):
    df = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return reader.canonical_keys(df, ["o_orderkey", "o_custkey"], ["order_id", "customer_id"])


@check("date_in_filter", """SELECT ym, count(*) AS n FROM (SELECT strftime(o_orderdate, '%y%m') AS ym FROM orders) WHERE ym IN ('9601', '9712', '9903') GROUP BY 1""")
def date_in_filter(t):
    df = t.orders.select(F.date_format("o_orderdate", "yyMM").alias("ym"))
    kept = reader.on_dates(df, "ym", ["1996-01-01", "1996-01-20", "1997-12-31", "1999-03-05"], "%y%m")
    return kept.groupBy("ym").agg(F.count("*").alias("n"))


@check("param_filter", f"WITH {RES} SELECT model_id, information_date, variable, metric_value FROM res WHERE model_id = 'S7' AND information_date >= '1996-02-01' AND information_date <= '2000-11-01' AND var_type IN ('raw', 'score')")
def param_filter(t):
    kept = dashboard.param_filter(data.results(t), "S7", "1996-02-01", "2000-11-01", {"var_type": ["raw", "score"], "metric_name": None})
    return kept.select("model_id", "information_date", "variable", "metric_value")


BOUNDS = """bnd AS (SELECT * FROM (VALUES (1, NULL, 100000.0, '>', '<='), (2, 100000.0, 200000.0, '>', '<'), (3, 200000.0, 300000.0, '>=', '<='), (4, 300000.0, NULL, '>', '<=')) AS b(bin, lb, ub, lt, ut))"""


@check("bin_predicate", f"""WITH {BOUNDS} SELECT bin, count(*) AS n FROM bnd JOIN orders ON (lb IS NULL OR CASE lt WHEN '>' THEN o_totalprice > lb ELSE o_totalprice >= lb END)
  AND (ub IS NULL OR CASE ut WHEN '<' THEN o_totalprice < ub ELSE o_totalprice <= ub END) GROUP BY 1""")
def bin_predicate(t):
    rows = [(1, float("-inf"), 100000.0, "-inf", "<="), (2, 100000.0, 200000.0, ">", "<"), (3, 200000.0, 300000.0, ">=", "<="), (4, 300000.0, float("inf"), ">", "inf")]
    b = t.spark.createDataFrame(rows, "bin int, lb double, ub double, lower_bound_type string, upper_bound_type string")
    b = b.withColumns({"bin_type": F.lit("NUMERIC"), "category_value": F.lit(None).cast("string")})
    joined = t.orders.alias("o").join(F.broadcast(b).alias("b"), bins.in_bin(F.col("o.o_totalprice")))
    return joined.groupBy("bin").agg(F.count("*").alias("n"))


@check("cutoff_split", f"WITH {NUM} SELECT d AS information_date, side, count(*) FILTER (value > 0.5) AS approved, count(*) FILTER (value <= 0.5) AS rejected FROM num WHERE variable = 'score' GROUP BY 1, 2")
def cutoff_split(t):
    approved, rejected = score.split_at_cutoff(data.numbers(t, "score"), 0.5)
    both = approved.withColumn("part", F.lit("a")).unionByName(rejected.withColumn("part", F.lit("r")))
    return both.groupBy("information_date", "side").agg(
        F.count_if(F.col("part") == "a").alias("approved"), F.count_if(F.col("part") == "r").alias("rejected")
    )


@check("anchor_align", """WITH al AS (SELECT l_orderkey, strftime(l_shipdate, '%Y-%m') AS join_date, l_extendedprice FROM lineitem)
  SELECT l_orderkey, join_date, min(l_extendedprice) AS price, count(*) - 1 AS removed FROM al GROUP BY 1, 2""")
def anchor_align(t):
    rows = t.lineitem.select("l_orderkey", F.date_format("l_shipdate", "yyyyMM").alias("ym"), "l_extendedprice")
    dated = reader.on_dates(rows, "ym", MONTHS, "%Y%m").withColumn("day", parse_date(F.col("ym"), "%Y%m"))
    keyed = dated.withColumn("join_date", F.date_format("day", "yyyy-MM"))
    return smallest_per_key(keyed, ["l_orderkey", "join_date"], ["l_extendedprice"], "removed").withColumnRenamed("l_extendedprice", "price")


@check("date_pattern", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-01') AS a, strftime(o_orderdate, '%Y-%m-%d') AS b, strftime(o_orderdate, '%d/%m/%Y') AS c FROM orders")
def date_pattern(t):
    day = F.col("o_orderdate").cast("date")
    month_text = format_date(day, "%y%m")
    return t.orders.select(
        "o_orderkey", iso(parse_date(month_text, "%y%m")).alias("a"), iso(parse_date(format_date(day, "%Y%m%d"), "%Y%m%d")).alias("b"),
        format_date(day, "%d/%m/%Y").alias("c"),
    )


@check("scalar_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS vintage, o_orderdate IS NOT NULL AS past FROM orders")
def scalar_dates(t):
    return t.orders.select(
        "o_orderkey", iso(parse_date(F.col("o_orderdate").cast("string"))).alias("day"), iso(month("o_orderdate")).alias("vintage"),
        (F.col("o_orderdate") < F.current_timestamp()).alias("past"),
    )


@check("scalar_math", """SELECT l_returnflag, round(avg(floor(l_extendedprice / 1000)), 6) + 0.0 AS a, round(avg(least(l_discount * 100, 5)), 6) + 0.0 AS b, round(avg(ln(l_quantity)), 6) + 0.0 AS c,
  round(avg(pow(l_discount - l_tax, 2)), 9) + 0.0 AS d, round(avg(abs(l_discount - l_tax)), 6) + 0.0 AS e, round(stddev_samp(l_quantity), 6) + 0.0 AS f, min(l_quantity) AS g, max(l_quantity) AS h FROM lineitem GROUP BY 1""")
def scalar_math(t):
    c = F.col
    return t.lineitem.groupBy("l_returnflag").agg(
        r6(F.avg(F.floor(c("l_extendedprice") / 1000))).alias("a"), r6(F.avg(F.least(c("l_discount") * 100, F.lit(5.0)))).alias("b"),
        r6(F.avg(F.ln("l_quantity"))).alias("c"), r6(F.avg(F.pow(c("l_discount") - c("l_tax"), F.lit(2.0))), 9).alias("d"),
        r6(F.avg(F.abs(c("l_discount") - c("l_tax")))).alias("e"), r6(F.stddev_samp("l_quantity")).alias("f"),
        F.min("l_quantity").alias("g"), F.max("l_quantity").alias("h"),
    )


@check("conditional_counts", f"WITH {TXT} SELECT d AS information_date, variable, count(*) FILTER (side = 'current' AND value IS NULL) AS null_cur, count(*) FILTER (side = 'baseline') AS n_base FROM txt GROUP BY 1, 2")
def conditional_counts(t):
    from modelmon.operators.quality import text_counts

    return text_counts(data.texts(t)).select("information_date", "variable", "null_cur", "n_base")


# -- sets, orders, limits ---------------------------------------------------------------


@check("win_rank_desc", f"""WITH {TXT}, c AS (SELECT d, variable, side, value, count(*) AS n FROM txt GROUP BY 1, 2, 3, 4) SELECT d AS information_date, variable, coalesce(value, '?') AS value,
  row_number() OVER (PARTITION BY d, variable ORDER BY n DESC, value NULLS LAST) AS rank FROM c WHERE side = 'current'""")
def win_rank_desc(t):
    ranked = bins.category_rank(data.texts(t).where("side = 'current'"))
    return ranked.select("information_date", "variable", F.coalesce("category_value", F.lit("?")).alias("value"), F.col("rank_dev").alias("rank"))


@check("topn_categories", f"""WITH {TXT}, c AS (SELECT d, variable, value, count(*) AS n FROM txt WHERE side = 'current' GROUP BY 1, 2, 3) SELECT d AS information_date, variable, coalesce(value, '?') AS value, n, rn AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY d, variable ORDER BY n DESC, value NULLS LAST) AS rn FROM c) WHERE rn <= 2""")
def topn_categories(t):
    counted = bins.category_counts(data.texts(t).where("side = 'current'"))
    top = top_per_group(counted, KEYS, [first_rank_key(F.col("count_dev"), F.col("value"))], 2)
    return top.select("information_date", "variable", F.coalesce("value", F.lit("?")).alias("value"), F.col("count_dev").alias("n"), "rank")


@check("top_category", f"""WITH {TXT}, c AS (SELECT d, variable, value, count(*) AS n FROM txt WHERE side = 'current' GROUP BY 1, 2, 3) SELECT d AS information_date, variable, coalesce(value, '?') AS value, n
  FROM (SELECT *, row_number() OVER (PARTITION BY d, variable ORDER BY n DESC, value NULLS LAST) AS rn FROM c) WHERE rn = 1""")
def top_category(t):
    found = summary.categorical_summary(data.texts(t))
    of = lambda name, column: F.max(F.when(F.col("statistic") == name, F.col(column)))
    value = of("top_category", "statistic_value_str")
    return found.groupBy("information_date", "variable").agg(
        F.when(value == "None", "?").otherwise(value).alias("value"), of("top_category_count", "statistic_value").cast("long").alias("n")
    ).where("n IS NOT NULL")


@check("order_results", f"WITH {RES} SELECT model_id, information_date, variable, metric_value FROM res ORDER BY model_id, information_date, variable")
def order_results(t):
    return dashboard.by_model(data.results(t), "variable").select("model_id", "information_date", "variable", "metric_value")


@check("union_samples", f"WITH {NUM} SELECT d AS information_date, variable, count(*) AS pooled FROM num GROUP BY 1, 2")
def union_samples(t):
    pool = observations.sizes(data.numbers(t))
    return pool.select("information_date", "variable", (F.col("n_cur") + F.col("n_base")).alias("pooled"))


@check("set_jaccard", f"""WITH {TXT} SELECT d AS information_date, variable, round(count(*) FILTER (s = 2) / count(*), 6) + 0.0 AS jaccard FROM (SELECT d, variable, value, count(DISTINCT side) AS s FROM txt GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def set_jaccard(t):
    # More leaders than there are categories, so both whole sets are compared.
    return quality.categories(data.texts(t), 100).select("information_date", "variable", r6("jaccard").alias("jaccard"))


@check("set_except", f"WITH {RES}, {LOG} SELECT DISTINCT information_date, model_id FROM log EXCEPT SELECT information_date, model_id FROM res")
def set_except(t):
    run = ["information_date", "model_id"]
    return sinks.mirror_plan(data.results(t), data.run_log(t)).where("action = 'drop'").select(*run)


@check("distinct_values", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders")
def distinct_values(t):
    return reader.source_dates(t.orders, "o_orderdate").select(iso("date").alias("date"))


@check("drop_duplicates", "SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2")
def drop_duplicates(t):
    return smallest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_extendedprice"]).withColumnRenamed("l_extendedprice", "price")


@check("successful_run_exists", f"WITH {RES}, {LOG}, s AS (SELECT DISTINCT model_id, information_date FROM log WHERE status = 'SUCCESS') SELECT r.model_id, r.information_date, s.model_id IS NOT NULL AS run_exists FROM (SELECT DISTINCT model_id, information_date FROM res) r LEFT JOIN s USING (model_id, information_date)")
def successful_run_exists(t):
    asked = data.results(t).select("model_id", "information_date").distinct()
    return runs.successful_run_exists(asked, data.run_log(t))


