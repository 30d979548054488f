"""Frames that Spark derives from the given tables, each beside the SQL that derives the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.catalog import Tables, iso, month
from modelmon.functions.columns import union_all

MODEL = "orders"


def _two_sides(values: DataFrame) -> DataFrame:
    """Every row is current in its month and baseline in the month after."""
    own = values.withColumns({"side": F.lit("current"), "information_date": iso("m")})
    after = values.withColumns({"side": F.lit("baseline"), "information_date": iso(F.add_months("m", 1))})
    both = own.unionByName(after)
    return both.select(F.lit(MODEL).alias("model_id"), "information_date", "var_type", "variable", "side", "value")


def _variable(df: DataFrame, var_type: str, variable: str, value) -> DataFrame:
    return df.select("m", F.lit(var_type).alias("var_type"), F.lit(variable).alias("variable"), value.alias("value"))


def numbers(t: Tables, *variables: str) -> DataFrame:
    o = t.orders.withColumn("m", month("o_orderdate"))
    unknown = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    made = {
        "price": ("raw", F.when(~unknown, F.col("o_totalprice"))),
        "score": ("score", F.col("o_totalprice") / 500000),
    }
    return _two_sides(union_all([_variable(o, made[v][0], v, made[v][1]) for v in variables or made]))


def texts(t: Tables) -> DataFrame:
    o = t.orders.withColumn("m", month("o_orderdate"))
    return _two_sides(
        _variable(o, "raw", "priority", F.col("o_orderpriority")).unionByName(
            _variable(o, "raw", "status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
        )
    )


def outcomes(t: Tables) -> DataFrame:
    """(o_orderkey, target): was any line of the order returned?"""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max((F.col("l_returnflag") == "R").cast("double")).alias("target")
    )


def targets(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", month("o_orderdate").alias("m")).join(outcomes(t), "o_orderkey")
    return _two_sides(_variable(o, "target", "target", F.col("target")))


def joined_pairs(t: Tables) -> DataFrame:
    """Score with outcome per order and side; the score is coarse, so ties are many."""
    o = t.orders.select("o_orderkey", month("o_orderdate").alias("m"), F.round(F.col("o_totalprice") / 500000, 1).alias("score"))
    both = o.join(outcomes(t), "o_orderkey")
    own = both.withColumns({"side": F.lit("current"), "information_date": iso("m")})
    after = both.withColumns({"side": F.lit("baseline"), "information_date": iso(F.add_months("m", 1))})
    return own.unionByName(after).withColumn("model_id", F.lit(MODEL))


def pairs(t: Tables) -> DataFrame:
    from modelmon.operators.conjugate import as_pairs

    return as_pairs(joined_pairs(t), F.col("o_orderkey").cast("double"))


def inputs(t: Tables) -> DataFrame:
    """Joint numeric inputs per order and side."""
    li = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"), F.avg("l_discount").alias("disc"), F.sum("l_extendedprice").alias("ext")
    )
    o = t.orders.select("o_orderkey", month("o_orderdate").alias("m"), F.col("o_totalprice").alias("price"))
    both = o.join(li, "o_orderkey")
    own = both.withColumns({"side": F.lit("current"), "information_date": iso("m")})
    after = both.withColumns({"side": F.lit("baseline"), "information_date": iso(F.add_months("m", 1))})
    return own.unionByName(after).withColumns(
        {"model_id": F.lit(MODEL), "var_type": F.lit("input"), "variable": F.lit("__INPUTS__")}
    )


ORD = """ord AS (SELECT o_orderkey, o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
  o_totalprice, o_orderpriority, o_orderstatus FROM orders)"""


def _sides_sql(name: str, source: str) -> str:
    return (
        f"{name} AS (SELECT strftime(m, '%Y-%m-%d') AS d, 'current' AS side, * FROM {source} UNION ALL "
        f"SELECT strftime(CAST(m + INTERVAL 1 MONTH AS DATE), '%Y-%m-%d'), 'baseline', * FROM {source})"
    )


NUM = ORD + """, numv AS (SELECT m, 'raw' AS var_type, 'price' AS variable,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS value FROM ord
  UNION ALL SELECT m, 'score', 'score', o_totalprice / 500000 FROM ord), """ + _sides_sql("num", "numv")
TXT = ORD + """, txtv AS (SELECT m, 'raw' AS var_type, 'priority' AS variable, o_orderpriority AS value FROM ord
  UNION ALL SELECT m, 'raw', 'status', nullif(o_orderstatus, 'P') FROM ord), """ + _sides_sql("txt", "txtv")
OUT = "out_ AS (SELECT l_orderkey AS o_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE AS target FROM lineitem GROUP BY 1)"
TGT = ORD + ", " + OUT + """, tgtv AS (SELECT m, 'target' AS var_type, 'target' AS variable, target AS value
  FROM ord JOIN out_ USING (o_orderkey)), """ + _sides_sql("tgt", "tgtv")
PRS = ORD + ", " + OUT + """, prsv AS (SELECT m, o_orderkey, round(o_totalprice / 500000, 1) AS score, target
  FROM ord JOIN out_ USING (o_orderkey)), """ + _sides_sql("prs", "prsv")
INP = ORD + """, inv AS (SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS qty, avg(l_discount) AS disc,
  sum(l_extendedprice) AS ext FROM lineitem GROUP BY 1), inpv AS (SELECT m, o_totalprice AS price, qty, disc, ext
  FROM ord JOIN inv USING (o_orderkey)), """ + _sides_sql("inp", "inpv")

# Exact discrete quantiles at i/20 by row numbers: current, baseline and pooled.
QTL = """rk AS (SELECT d, variable, side, value, row_number() OVER (PARTITION BY d, variable, side ORDER BY value) AS rn,
  count(*) OVER (PARTITION BY d, variable, side) AS n, row_number() OVER (PARTITION BY d, variable ORDER BY value) AS prn,
  count(*) OVER (PARTITION BY d, variable) AS pn FROM num WHERE value IS NOT NULL),
  steps AS (SELECT unnest(range(0, 21)) AS i),
  q AS (SELECT d, variable, side, i, value FROM rk, steps WHERE rn = greatest((i * n + 19) // 20, 1)),
  pq AS (SELECT d, variable, i, value FROM rk, steps WHERE prn = greatest((i * pn + 19) // 20, 1)),
  qw AS (SELECT d, variable, max(value) FILTER (side = 'current' AND i = 10) AS c50,
    max(value) FILTER (side = 'baseline' AND i = 10) AS b50,
    max(value) FILTER (side = 'current' AND i = 5) AS c25, max(value) FILTER (side = 'current' AND i = 15) AS c75,
    max(value) FILTER (side = 'current' AND i = 2) AS c10, max(value) FILTER (side = 'current' AND i = 18) AS c90,
    max(value) FILTER (side = 'baseline' AND i = 2) AS b10, max(value) FILTER (side = 'baseline' AND i = 18) AS b90
    FROM q GROUP BY 1, 2)"""


def sizes_sql(source: str) -> str:
    return (
        f"sz AS (SELECT d, variable, count(*) FILTER (side = 'current') AS n_cur, "
        f"count(*) FILTER (side = 'baseline') AS n_base FROM {source} GROUP BY 1, 2)"
    )


# -- result tables, derived from lineitem and orders ------------------------------------

TYPES = ["raw", "input", "transformed", "score", "target", "conjugate", "raw"]
METRICS = {
    "raw": ["median_shift", "population_variation", "completeness", "psi_canonical", "null_rate"],
    "input": ["median_shift", "population_variation", "completeness", "psi_canonical", "null_rate"],
    "transformed": ["null_rate", "ks_vs_dev", "outlier_rate", "psi_canonical", "psi_dynamic"],
    "score": ["psi_canonical", "psi_dynamic", "entropy", "approval_rate", "range_violation"],
    "target": ["event_rate", "psi_target", "null_rate", "event_rate", "psi_target"],
    "conjugate": ["auc", "gini", "brier_score", "lift_top_decile", "ks_score_target"],
}


def results(t: Tables) -> DataFrame:
    """Metric results: one row per line of an order, for the supplier as model."""
    li = t.lineitem
    kind = F.element_at(F.array(*[F.lit(x) for x in TYPES]), F.col("l_linenumber"))
    pick = (F.col("l_quantity").cast("int") % 5) + 1
    metric = F.lit(None).cast("string")
    for name, listed in METRICS.items():
        metric = F.when(F.col("var_type") == name, F.element_at(F.array(*[F.lit(x) for x in listed]), pick)).otherwise(metric)
    status = F.when(F.col("l_returnflag") == "R", "RED").when(F.col("l_returnflag") == "A", "AMBAR").otherwise("GREEN")
    return li.withColumn("var_type", kind).select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("model_id"),
        iso(month("l_shipdate")).alias("information_date"),
        F.concat(F.lit("v"), F.col("l_linenumber")).alias("variable"),
        "var_type",
        metric.alias("metric_name"),
        F.col("l_discount").alias("metric_value"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("baseline_value"),
        F.lit(0.05).alias("threshold_ambar"),
        F.lit(0.08).alias("threshold_red"),
        status.alias("status"),
    )


def _metric_sql() -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v!r}[CAST(l_quantity AS INT) % 5 + 1]" for k, v in METRICS.items())
    return f"CASE {TYPES!r}[l_linenumber] {cases} END"


RES = f"""res AS (SELECT 'S' || l_suppkey AS model_id, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS information_date,
  'v' || l_linenumber AS variable, {TYPES!r}[l_linenumber] AS var_type, {_metric_sql()} AS metric_name,
  l_discount AS metric_value, CASE WHEN l_tax > 0 THEN l_tax END AS baseline_value, 0.05 AS threshold_ambar, 0.08 AS threshold_red,
  CASE l_returnflag WHEN 'R' THEN 'RED' WHEN 'A' THEN 'AMBAR' ELSE 'GREEN' END AS status FROM lineitem)"""


def run_log(t: Tables) -> DataFrame:
    """Execution log: one run per order, for the customer's supplier-like model."""
    o = t.orders
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "P", "MISSING_DATA").otherwise("FAILED")
    return o.select(
        F.concat(F.lit("S"), F.col("o_custkey")).alias("model_id"),
        iso(month("o_orderdate")).alias("information_date"),
        (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400).alias("run_date"),
        status.alias("status"),
        (F.col("o_orderkey") % 4).cast("int").alias("variables_missing"),
    )


LOG = """log AS (SELECT 'S' || o_custkey AS model_id, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS information_date,
  CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS run_date,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'MISSING_DATA' ELSE 'FAILED' END AS status,
  CAST(o_orderkey % 4 AS INTEGER) AS variables_missing FROM orders)"""

ALERTS = """pol AS (SELECT * FROM (VALUES ('raw', 3, 0.60, 0.40), ('input', 3, 0.50, 0.30), ('transformed', 3, 0.50, 0.30),
  ('score', 2, 0.30, 0.15), ('target', 3, 0.50, 0.30), ('conjugate', 2, 0.50, 0.30)) AS p(var_type, w, pa, pr)),
  cnt AS (SELECT model_id, information_date, var_type, count(*) AS total_metrics, count(*) FILTER (status = 'AMBAR') AS count_ambar,
  count(*) FILTER (status = 'RED') AS count_red FROM res GROUP BY 1, 2, 3),
  alr AS (SELECT cnt.*, w, CAST(count_ambar + count_red * w AS DOUBLE) AS equivalent_yellow,
  CAST(count_ambar + count_red * w AS DOUBLE) / (total_metrics * w) AS stress_ratio,
  CASE WHEN CAST(count_ambar + count_red * w AS DOUBLE) / (total_metrics * w) >= CAST(pr AS DOUBLE) THEN 'RED'
  WHEN CAST(count_ambar + count_red * w AS DOUBLE) / (total_metrics * w) >= CAST(pa AS DOUBLE) THEN 'AMBAR' ELSE 'GREEN' END AS aggregate_status
  FROM cnt JOIN pol USING (var_type))"""


def alerts(t: Tables) -> DataFrame:
    from modelmon.operators.alerts import alert_aggregate

    return alert_aggregate(results(t))


# -- statistics table, derived from lineitem --------------------------------------------

STATISTICS = ["p10", "p50", "p90", "min", "max", "mean", "count_total"]


def statistics(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("model_id"),
        iso(month("l_shipdate")).alias("information_date"),
        F.concat(F.lit("v"), F.col("l_linenumber")).alias("variable"),
        F.element_at(F.array(*[F.lit(x) for x in TYPES]), F.col("l_linenumber")).alias("var_type"),
        F.element_at(F.array(*[F.lit(x) for x in STATISTICS]), (F.col("l_partkey") % 7 + 1).cast("int")).alias("statistic"),
        F.col("l_extendedprice").alias("statistic_value"),
    )


STA = f"""sta AS (SELECT 'S' || l_suppkey AS model_id, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS information_date,
  'v' || l_linenumber AS variable, {TYPES!r}[l_linenumber] AS var_type, {STATISTICS!r}[l_partkey % 7 + 1] AS statistic,
  l_extendedprice AS statistic_value FROM lineitem)"""


def calendar(t: Tables) -> DataFrame:
    """Every day from the first to the last order; weekends, New Year and Christmas are closed."""
    from modelmon.operators.calendar import weekday_calendar

    span = t.orders.agg(F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day"))
    return weekday_calendar(span, ["01-01", "12-25"])


CAL = """span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
  cal AS (SELECT day AS calendar_date, isodow(day) < 6 AND strftime(day, '%m-%d') NOT IN ('01-01', '12-25') AS biz
  FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span))"""


def ship_dates(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_shipdate").cast("date").alias("date")).distinct()


SHIP = "ship AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)"
