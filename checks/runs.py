"""Joins, training artefacts, run roll-ups and whole jobs as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import data
from checks.catalog import Tables, check, iso, month, r6, scratch
from checks.configs import CFG, CON, config_rows, contacts
from checks.data import ALERTS, INP, LOG, NUM, ORD, OUT, PRS, QTL, RES, STA, TXT, sizes_sql
from modelmon.functions.columns import KEYS
from modelmon.functions.dates import shift_periods
from modelmon.functions.sizes import reliable, side_by_side
from modelmon.operators import alerts as al
from modelmon.operators import availability as av
from modelmon.operators import bins, conjugate, dashboard, development, quality, registry, runs, stability, summary, thresholds
from modelmon.plans.feeds import ConfigTables
from modelmon.plans.monitor import Monitor, run_models
from modelmon.plans.training import Trainer
from modelmon.sources import config, sinks
from modelmon.sources.config import metadata_join as join_metadata

# -- joins ------------------------------------------------------------------------------


@check("join_score_target", f"WITH {ORD}, {OUT} SELECT o_orderkey, o_totalprice / 500000 AS score, target FROM ord JOIN out_ USING (o_orderkey)")
def join_score_target(t):
    scores = t.orders.select("o_orderkey", (F.col("o_totalprice") / 500000).alias("score"))
    return conjugate.join_pairs(scores, data.outcomes(t), ["o_orderkey", "read_date"])


@check("join_score_target_lagged", f"""WITH {ORD}, {OUT} SELECT strftime(m + INTERVAL 2 MONTH, '%Y-%m-%d') AS information_date, count(*) AS n, round(sum(o_totalprice) / 500000, 6) + 0.0 AS scores, CAST(sum(target) AS BIGINT) AS events
  FROM ord JOIN out_ USING (o_orderkey) WHERE m + INTERVAL 2 MONTH IN (SELECT m FROM ord) GROUP BY 1""")
def join_score_target_lagged(t):
    monitor, runs = Monitor(t.spark, *joint_model(t)), order_runs(t)
    dates, lagged = monitor.resolved(runs)
    both = monitor.pairs(dates, lagged, monitor.feeds.read_dates(dates)).where("side = 'current'")
    return both.groupBy("information_date").agg(
        F.count("*").alias("n"), r6(F.sum("score")).alias("scores"), F.sum("target").cast("long").alias("events")
    )


@check("join_inputs", f"WITH {INP} SELECT d AS information_date, side, count(*) AS n, round(sum(qty), 4) + 0.0 AS qty, round(sum(ext), 2) + 0.0 AS ext FROM inp GROUP BY 1, 2")
def join_inputs(t):
    monitor, runs = Monitor(t.spark, *joint_model(t)), order_runs(t)
    after = runs.select("model_id", iso(F.add_months(F.col("information_date").cast("date"), 1)).alias("information_date"))
    dates, _ = monitor.resolved(runs.unionByName(after))
    (rows, _, own), = monitor.joint_inputs(dates, monitor.feeds.read_dates(dates))
    ext, qty = own[data.MODEL]
    return rows.groupBy("information_date", "side").agg(
        F.count("*").alias("n"), r6(F.sum(qty), 4).alias("qty"), r6(F.sum(ext), 2).alias("ext")
    )


@check("metadata_join", f"""WITH {CFG}, act AS (SELECT model_id, 't' || p_partkey AS source_table FROM lat WHERE p_partkey % 7 <> 0),
  meta AS (SELECT DISTINCT 'M' || (l_partkey % 50) AS model_id, 't' || l_partkey AS source_table, 'v' || l_linenumber AS variable FROM lineitem)
  SELECT variable, count(*) FILTER (act.model_id IS NOT NULL) AS configured, count(*) FILTER (act.model_id IS NULL) AS unconfigured FROM meta LEFT JOIN act USING (model_id, source_table) GROUP BY 1""")
def metadata_join(t):
    meta = t.lineitem.select(
        F.concat(F.lit("M"), F.col("l_partkey") % 50).alias("model_id"), F.concat(F.lit("t"), F.col("l_partkey")).alias("source_table"),
        F.concat(F.lit("v"), F.col("l_linenumber")).alias("variable"),
    ).distinct()
    found, missing = join_metadata(meta, config.load_table_config(config_rows(t)))
    both = found.select("variable", F.lit(True).alias("ok")).unionByName(missing.select("variable", F.lit(False).alias("ok")))
    return both.groupBy("variable").agg(F.count_if("ok").alias("configured"), F.count_if(~F.col("ok")).alias("unconfigured"))


SEM = """sem AS (SELECT r.information_date, r.model_id, r.var_type, r.metric_name, r.metric_value, r.status, a.aggregate_status, a.stress_ratio, l.status AS execution_status, l.variables_missing
  FROM res r LEFT JOIN alr a ON r.model_id = a.model_id AND r.information_date = a.information_date LEFT JOIN log l ON r.model_id = l.model_id AND r.information_date = l.information_date)"""


@check("semaphore_view", f"""WITH {RES}, {LOG}, {ALERTS}, {SEM} SELECT model_id, var_type, status, aggregate_status, coalesce(execution_status, '') AS execution_status, count(*) AS n,
  round(sum(stress_ratio), 6) + 0.0 AS stress, CAST(coalesce(sum(variables_missing), 0) AS BIGINT) AS missing FROM sem GROUP BY 1, 2, 3, 4, 5""")
def semaphore_view(t):
    view = dashboard.semaphore_view(data.results(t), data.alerts(t), data.run_log(t))
    return view.groupBy("model_id", "var_type", "status", "aggregate_status", F.coalesce("execution_status", F.lit("")).alias("execution_status")).agg(
        F.count("*").alias("n"), r6(F.sum("stress_ratio")).alias("stress"), F.coalesce(F.sum("variables_missing"), F.lit(0)).alias("missing")
    )


MSV = """msv AS (SELECT a.information_date, a.model_id, max(CASE WHEN var_type = 'score' THEN aggregate_status END) AS score_status, max(CASE WHEN var_type = 'input' THEN aggregate_status END) AS input_status,
  max(CASE WHEN var_type = 'raw' THEN aggregate_status END) AS raw_status, max(CASE WHEN var_type = 'transformed' THEN aggregate_status END) AS transformed_status,
  max(CASE WHEN var_type = 'SYSTEM' THEN aggregate_status END) AS system_status, max(CASE WHEN l.status = 'MISSING_DATA' THEN 1 ELSE 0 END) AS has_missing_data, count(DISTINCT var_type) AS var_types_evaluated
  FROM alr a LEFT JOIN log l ON a.model_id = l.model_id AND a.information_date = l.information_date GROUP BY 1, 2)"""


@check("model_summary_view", f"WITH {RES}, {LOG}, {ALERTS}, {MSV} SELECT * FROM msv")
def model_summary_view(t):
    return dashboard.model_summary_view(data.alerts(t), data.run_log(t))


@check("new_models", "SELECT 'S' || c_custkey AS model_id FROM customer WHERE c_custkey NOT IN (SELECT l_suppkey FROM lineitem)")
def new_models(t):
    latest = t.customer.select(F.concat(F.lit("S"), F.col("c_custkey")).alias("model_id"))
    return runs.new_models(latest, data.results(t).select("model_id"))


FLAGS = "flags AS (SELECT model_id, information_date, bool_or(aggregate_status = 'RED') AS has_red, bool_or(aggregate_status = 'AMBAR') AS has_ambar FROM alr GROUP BY 1, 2)"
MISS = "miss AS (SELECT DISTINCT model_id, information_date, true AS m FROM log WHERE status = 'MISSING_DATA')"


ADDRESSED = """rr AS (SELECT flags.*, coalesce(m, false) AS missing FROM flags LEFT JOIN miss USING (model_id, information_date)),
  hit AS (SELECT DISTINCT rr.model_id, rr.information_date, contact_email FROM rr JOIN lcon USING (model_id) WHERE (missing AND notify_on_missing) OR (has_red AND notify_on_red) OR (has_ambar AND notify_on_ambar)),
  too AS (SELECT model_id, information_date, string_agg(contact_email, ', ' ORDER BY contact_email) AS a FROM hit GROUP BY 1, 2),
  bc AS (SELECT rr.model_id, rr.information_date, string_agg(email, ', ' ORDER BY email) AS b FROM rr, (SELECT DISTINCT 'r' || n_nationkey || '@x' AS email FROM nation WHERE n_regionkey = 1)
    WHERE (has_red OR missing) GROUP BY 1, 2),
  adr AS (SELECT model_id, information_date, coalesce(a, b, '') AS recipients_to, CASE WHEN a IS NULL THEN '' ELSE coalesce(b, '') END AS recipients_bcc FROM rr LEFT JOIN too USING (model_id, information_date) LEFT JOIN bc USING (model_id, information_date))"""


@check("recipients", f"WITH {RES}, {LOG}, {ALERTS}, {CON}, {FLAGS}, {MISS}, {ADDRESSED} SELECT * FROM adr")
def recipients(t):
    return addressed(t)


def addressed(t):
    run = ["model_id", "information_date"]
    flags = data.alerts(t).groupBy(*run).agg(
        F.bool_or(F.col("aggregate_status") == "RED").alias("has_red"), F.bool_or(F.col("aggregate_status") == "AMBAR").alias("has_ambar")
    )
    missing = data.run_log(t).where("status = 'MISSING_DATA'").select(*run).distinct().withColumn("missing_data", F.lit(True))
    asked = flags.join(missing, run, "left").fillna(False, ["missing_data"])
    red = t.nation.select(F.concat(F.lit("r"), F.col("n_nationkey"), F.lit("@x")).alias("email"), (F.col("n_regionkey") == 1).alias("is_active"))
    return al.recipients(asked, config.latest_partition(contacts(t)), red)


# -- training artefacts -----------------------------------------------------------------


def finite(column: str):
    return F.when(F.col(column) == float("-inf"), -1e300).when(F.col(column) == float("inf"), 1e300).otherwise(F.col(column)).alias(column)


DECILES = """cur AS (SELECT d, variable, value, row_number() OVER (PARTITION BY d, variable ORDER BY value) AS rn, count(*) OVER (PARTITION BY d, variable) AS n FROM num WHERE side = 'current' AND value IS NOT NULL),
  ed AS (SELECT d, variable, i, value FROM cur, (SELECT unnest(range(1, 10)) AS i) WHERE rn = greatest((i * n + 9) // 10, 1)),
  nb AS (SELECT k.d, k.variable, b AS bin, coalesce(lo.value, -1e300) AS lb, coalesce(hi.value, 1e300) AS ub FROM (SELECT DISTINCT d, variable FROM cur) k CROSS JOIN (SELECT unnest(range(1, 11)) AS b)
    LEFT JOIN ed lo ON lo.d = k.d AND lo.variable = k.variable AND lo.i = b - 1 LEFT JOIN ed hi ON hi.d = k.d AND hi.variable = k.variable AND hi.i = b),
  nbc AS (SELECT nb.d, nb.variable, bin, lb, ub, count(cur.value) AS count_dev FROM nb LEFT JOIN cur ON cur.d = nb.d AND cur.variable = nb.variable AND cur.value > lb AND cur.value <= ub GROUP BY 1, 2, 3, 4, 5)"""


@check("numeric_bins", f"WITH {NUM}, {DECILES} SELECT d AS information_date, variable, bin, lb, ub, count_dev FROM nbc")
def numeric_bins(t):
    found = bins.numeric_bins(data.numbers(t).where("side = 'current'"))
    return found.select("information_date", "variable", "bin", finite("lb"), finite("ub"), "count_dev")


@check("bin_counts", f"WITH {NUM}, {DECILES} SELECT d AS information_date, variable, bin, count_dev, round(count_dev / sum(count_dev) OVER (PARTITION BY d, variable), 9) + 0.0::DOUBLE AS freq_dev FROM nbc")
def bin_counts(t):
    rows = data.numbers(t).where("side = 'current'")
    made = bins.numeric_bins(rows).select(*KEYS, "bin", *[c for c in bins.BIN_COLUMNS if c not in ("bin", "count_dev")])
    by_date = made.withColumns({"model_id": F.concat_ws("|", "model_id", "information_date"), "type": F.col("var_type")}).drop("information_date", "var_type")
    dated = rows.withColumn("model_id", F.concat_ws("|", "model_id", "information_date"))
    counted = bins.bin_counts(dated, bins.normalise_bins(by_date))
    totals = counted.groupBy("information_date", "variable").agg(F.sum("n_cur").alias("total"))
    return counted.join(totals, ["information_date", "variable"]).select(
        "information_date", "variable", "bin", F.col("n_cur").alias("count_dev"), r6(F.col("n_cur") / F.col("total"), 9).alias("freq_dev")
    )


@check("categorical_bins", f"""WITH {TXT}, c AS (SELECT d, variable, value, count(*) AS n FROM txt WHERE side = 'current' GROUP BY 1, 2, 3) SELECT d AS information_date, variable, rn AS bin, coalesce(value, '?') AS category_value, n AS count_dev
  FROM (SELECT *, row_number() OVER (PARTITION BY d, variable ORDER BY n DESC, value NULLS LAST) AS rn FROM c) WHERE rn <= 50""")
def categorical_bins(t):
    found = bins.categorical_bins(data.texts(t).where("side = 'current'"))
    return found.select("information_date", "variable", "bin", F.coalesce("category_value", F.lit("?")).alias("category_value"), "count_dev")


@check("woe", f"""WITH {PRS}, b AS (SELECT d, score AS bin, count(*) FILTER (target = 1) AS p, count(*) FILTER (target = 0) AS n FROM prs WHERE side = 'current' GROUP BY 1, 2),
  s AS (SELECT d, CASE WHEN sum(p) = 0 THEN 1 ELSE sum(p) END::DOUBLE AS tp, CASE WHEN sum(n) = 0 THEN 1 ELSE sum(n) END::DOUBLE AS tn FROM b GROUP BY 1)
  SELECT d AS information_date, bin, round(100.0::DOUBLE * (((p + 1e-6) / tp) / ((n + 1e-6) / tn)), 6) + 0.0::DOUBLE AS woe FROM b JOIN s USING (d)""")
def woe(t):
    counted = data.pairs(t).where("side = 'current'").groupBy("information_date", F.col("score").alias("bin")).agg(
        F.count_if(F.col("target") == 1).alias("p"), F.count_if(F.col("target") == 0).alias("n")
    )
    totals = counted.groupBy("information_date").agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    both = counted.join(totals, "information_date")
    return both.select("information_date", "bin", bins.woe(F.col("p"), F.col("n"), F.col("tp"), F.col("tn")).alias("woe"))


@check("category_rank", f"""WITH {TXT}, c AS (SELECT d, variable, value, count(*) AS n FROM txt WHERE side = 'current' GROUP BY 1, 2, 3) SELECT d AS information_date, variable, coalesce(value, '?') AS category_value,
  row_number() OVER (PARTITION BY d, variable ORDER BY n DESC, value NULLS LAST) AS rank_dev, round(n / sum(n) OVER (PARTITION BY d, variable), 9) + 0.0::DOUBLE AS freq_dev, 50 AS top_n_threshold, 5 AS critical_top_k FROM c""")
def category_rank(t):
    ranked = development.with_policy(bins.category_rank(data.texts(t).where("side = 'current'")))
    return ranked.select(
        "information_date", "variable", F.coalesce("category_value", F.lit("?")).alias("category_value"), "rank_dev",
        r6("freq_dev", 9).alias("freq_dev"), "top_n_threshold", "critical_top_k",
    )


@check("auto_thresholds", f"""WITH {NUM}, {QTL}, cur_ AS (SELECT * FROM num WHERE side = 'current'), n_ AS (SELECT d, variable, count(*) AS n, count(*) FILTER (value IS NULL) AS k FROM cur_ GROUP BY 1, 2),
  o_ AS (SELECT d, variable, count(*) FILTER (value < c25 - 1.5 * (c75 - c25) OR value > c75 + 1.5 * (c75 - c25)) AS o FROM cur_ LEFT JOIN qw USING (d, variable) GROUP BY 1, 2),
  b_ AS (SELECT d, variable, least(floor(value * 10), 9) AS g, count(*) AS c FROM cur_ WHERE variable = 'score' GROUP BY 1, 2, 3),
  e_ AS (SELECT d, variable, sum(-c / t * ln(c / t)) AS h FROM b_ JOIN (SELECT d, variable, sum(c)::DOUBLE AS t FROM b_ GROUP BY 1, 2) USING (d, variable) GROUP BY 1, 2),
  all_ AS (SELECT d, variable, n, 'null_rate' AS metric_name, 0.05 AS ta, 0.10 AS tr, k / n AS v FROM n_ UNION ALL SELECT d, variable, n, 'outlier_rate', 0.03, 0.06, o / n FROM n_ JOIN o_ USING (d, variable)
    UNION ALL SELECT d, variable, n, 'psi_canonical', 0.10, 0.20, 0 FROM n_ UNION ALL SELECT d, variable, n, 'psi_dynamic', 0.10, 0.20, 0 FROM n_ UNION ALL SELECT d, variable, n, 'entropy', 0.15, 0.30, h FROM n_ JOIN e_ USING (d, variable))
  SELECT d AS information_date, variable, metric_name, ta::DOUBLE AS threshold_ambar, tr::DOUBLE AS threshold_red, round(v::DOUBLE, 9) + 0.0::DOUBLE AS baseline_value, n AS sample_size_dev FROM all_""")
def auto_thresholds(t):
    rows = data.numbers(t)
    current = rows.where("side = 'current'")
    found = development.auto_thresholds(current, stability.quartiles(stability.quantiles(rows)))
    return found.select(
        "information_date", "variable", "metric_name", "threshold_ambar", "threshold_red", r6("baseline_value", 9).alias("baseline_value"), "sample_size_dev"
    )


# -- limits and lights ------------------------------------------------------------------


@check("status_rule", f"""WITH {RES} SELECT model_id, variable, information_date, CASE WHEN coalesce(metric_value, 0) >= 0.08 THEN 'RED' WHEN coalesce(metric_value, 0) >= 0.05 AND baseline_value IS NOT NULL THEN 'AMBAR' ELSE 'GREEN' END AS light FROM res""")
def status_rule(t):
    ambar = F.when(F.col("baseline_value").isNotNull(), F.lit(0.05))
    light = thresholds.status_rule(F.col("metric_value"), ambar, F.lit(0.08))
    return data.results(t).select("model_id", "variable", "information_date", light.alias("light"))


LIMITS = ", ".join(f"('{m}', {a if a is not None else 'NULL'}, {r if r is not None else 'NULL'}, {str(m in ('gini', 'brier_score', 'lift_top_decile', 'entropy', 'approval_rate', 'event_rate', 'concentration_gini', 'calibration_slope', 'correlation_drift')).lower()})" for m, (a, r) in thresholds.DEFAULT_THRESHOLDS.items())


@check("resolve_thresholds", f"""WITH {RES}, lim AS (SELECT * FROM (VALUES {LIMITS}) AS l(metric_name, a, r, rel)), aut AS (SELECT 'S' || s_suppkey AS model_id, s_acctbal / 100000 AS ta FROM supplier WHERE s_nationkey < 12),
  man AS (SELECT 'S' || s_suppkey AS model_id, s_nationkey / 100 AS pa, s_nationkey / 50 AS pr FROM supplier)
  SELECT model_id, information_date, variable, metric_name, metric_value, coalesce(round((CASE WHEN rel AND baseline_value IS NULL THEN NULL WHEN metric_name IN ('psi_canonical', 'psi_target') AND variable = 'v1' THEN pa
    WHEN metric_name = 'null_rate' AND variable = 'v3' AND ta IS NOT NULL THEN ta ELSE a END)::DOUBLE, 9), -1) + 0.0::DOUBLE AS threshold_ambar,
  coalesce(round((CASE WHEN rel AND baseline_value IS NULL THEN NULL WHEN metric_name IN ('psi_canonical', 'psi_target') AND variable = 'v1' THEN pr ELSE r END)::DOUBLE, 9), -1) + 0.0::DOUBLE AS threshold_red
  FROM res JOIN lim USING (metric_name) LEFT JOIN aut USING (model_id) LEFT JOIN man USING (model_id)""")
def resolve_thresholds(t):
    rows = data.results(t).drop("threshold_ambar", "threshold_red", "status")
    owner = F.concat(F.lit("S"), F.col("s_suppkey")).alias("model_id")
    auto = t.supplier.where("s_nationkey < 12").select(
        owner, F.lit("v3").alias("variable"), F.lit("null_rate").alias("metric_name"), (F.col("s_acctbal") / 100000).alias("threshold_ambar"),
        F.lit(None).cast("double").alias("threshold_red"),
    )
    manual = t.supplier.select(
        owner, F.lit("v1").alias("variable"), F.lit("raw").alias("type"), (F.col("s_nationkey") / 100).alias("psi_threshold_ambar"),
        (F.col("s_nationkey") / 50).alias("psi_threshold_red"),
    )
    found = thresholds.resolve_thresholds(rows, auto, manual)
    return found.select(
        "model_id", "information_date", "variable", "metric_name", "metric_value",
        (F.coalesce(F.round("threshold_ambar", 9), F.lit(-1.0)) + F.lit(0.0)).alias("threshold_ambar"),
        (F.coalesce(F.round("threshold_red", 9), F.lit(-1.0)) + F.lit(0.0)).alias("threshold_red"),
    )


MATRIX = ", ".join(
    f"('{v}', '{k}', '{m}')" for (vs, kind), ms in thresholds.METRIC_MATRIX.items() for v in vs.split(",")
    for k in (["numeric", "categorical", "binary"] if kind == "*" else [kind]) for m in ms
)


@check("metric_matrix", f"""WITH mat AS (SELECT * FROM (VALUES {MATRIX}) AS x(var_type, data_type, metric_name)), meta AS (SELECT DISTINCT 'S' || l_suppkey AS model_id, 'v' || l_linenumber AS variable,
  {data.TYPES!r}[l_linenumber] AS var_type, CASE l_linenumber WHEN 7 THEN 'categorical' WHEN 5 THEN 'binary' ELSE 'numeric' END AS data_type FROM lineitem)
  SELECT model_id, variable, var_type, data_type, coalesce(metric_name, 'null_rate') AS metric_name FROM meta LEFT JOIN mat USING (var_type, data_type)""")
def metric_matrix(t):
    line = F.col("l_linenumber")
    meta = t.lineitem.select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("model_id"), F.concat(F.lit("v"), line).alias("variable"),
        F.element_at(F.array(*[F.lit(x) for x in data.TYPES]), line).alias("var_type"),
        F.when(line == 7, "categorical").when(line == 5, "binary").otherwise("numeric").alias("data_type"),
    ).distinct()
    return thresholds.applicable_metrics(meta)


@check("metric_registry", f"WITH {NUM} SELECT d AS information_date, variable, 'max_value' AS metric_name, coalesce(max(value) FILTER (side = 'current'), 0) AS metric_value FROM num GROUP BY 1, 2")
def metric_registry(t):
    """A user's own family and metric, measured without touching the library."""

    def largest(rows):
        return rows.groupBy(*KEYS).agg(F.max(F.when(F.col("side") == "current", F.col("value"))).alias("top"), F.lit(0).alias("n_base"))

    registry.register_family("largest", largest)
    registry.register(registry.Metric("max_value", "largest", lambda: F.col("top")))
    try:
        metric = registry.get("max_value")
        found = registry.measure(registry.family(metric.family)(data.numbers(t)), [metric])
    finally:
        registry.forget("max_value", "largest")
    return found.select("information_date", "variable", "metric_name", "metric_value")


# -- roll-ups ---------------------------------------------------------------------------

STATS = """vs AS (SELECT d, variable, count(*) AS n, count(value) AS k, min(value) AS mn, max(value) AS mx, avg(value) AS av, coalesce(stddev_samp(value), 0) AS sd FROM num WHERE side = 'current' GROUP BY 1, 2),
  long_ AS (SELECT d, variable, unnest(['count_total', 'count_non_null', 'count_null', 'min', 'max', 'mean', 'std']) AS statistic, unnest([n, k, n - k, mn, mx, av, sd]::DOUBLE[]) AS v FROM vs
    UNION ALL SELECT d, variable, 'p' || (i * 5), value FROM q WHERE side = 'current' AND i % 2 = 0 AND i BETWEEN 2 AND 18)"""


@check("variable_summary", f"""WITH {NUM}, {QTL}, {STATS}, {TXT.replace(ORD + ', ', '')}, tc AS (SELECT d, variable, value, count(*) AS n FROM txt WHERE side = 'current' GROUP BY 1, 2, 3),
  ts AS (SELECT d, variable, sum(n) AS n, coalesce(sum(n) FILTER (value IS NOT NULL), 0) AS k, count(value) AS u, max(n) AS m FROM tc GROUP BY 1, 2),
  lt AS (SELECT d, variable, unnest(['count_total', 'count_non_null', 'count_null', 'distinct_count', 'top_category_count']) AS statistic, unnest([n, k, n - k, u, m]::DOUBLE[]) AS v FROM ts),
  tt AS (SELECT d, variable, 'top_category' AS statistic, coalesce(value, 'None') AS s FROM (SELECT *, row_number() OVER (PARTITION BY d, variable ORDER BY n DESC, value NULLS LAST) AS rn FROM tc) WHERE rn = 1)
  SELECT d AS information_date, variable, statistic, CASE WHEN statistic IN ('mean', 'std') THEN round(v, 4) ELSE round(v, 9) END + 0.0::DOUBLE AS statistic_value, '' AS top FROM (SELECT * FROM long_ UNION ALL SELECT * FROM lt) UNION ALL SELECT d, variable, statistic, -1, s FROM tt""")
def variable_summary(t):
    rows = data.numbers(t)
    both = summary.numeric_summary(rows, stability.quantiles(rows)).unionByName(summary.categorical_summary(data.texts(t)))
    value = F.when(F.col("statistic").isin("mean", "std"), F.round("statistic_value", 4)).otherwise(F.round("statistic_value", 9))
    return both.select(
        "information_date", "variable", "statistic", (F.coalesce(value, F.lit(-1.0)) + F.lit(0.0)).alias("statistic_value"),
        F.when(F.col("statistic") == "top_category", F.col("statistic_value_str")).otherwise("").alias("top"),
    )


DONE = "av_ AS (SELECT DISTINCT model_id, information_date, true AS done FROM log WHERE status = 'SUCCESS')"


@check("scoring_summary", f"""WITH {RES}, {LOG}, {STA}, {DONE}, first_ AS (SELECT model_id, information_date, metric_name, arg_min(metric_value, variable) AS v FROM (SELECT model_id, information_date, metric_name, variable, min(metric_value) AS metric_value FROM res WHERE var_type = 'score' GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
  g AS (SELECT model_id, information_date, max(metric_value) FILTER (var_type IN ('raw', 'input') AND metric_name = 'psi_canonical') AS csi_max,
    coalesce(bool_or(status = 'RED') FILTER (var_type IN ('raw', 'input') AND metric_name = 'psi_canonical'), false) AS csi_red,
    coalesce(bool_or(status = 'RED') FILTER (var_type IN ('raw', 'input') AND metric_name IN ('median_shift', 'population_variation', 'completeness')), false) AS pre_red,
    bool_or(status IN ('RED', 'AMBAR')) AS lights FROM res GROUP BY 1, 2)
  SELECT g.model_id, g.information_date, g.information_date AS scoring_date, g.information_date AS vintage, CASE WHEN done THEN 'DONE' ELSE 'PENDING' END AS control_data_availability,
    CASE WHEN pre_red THEN 'Reprocess' ELSE 'OK' END AS control_pre_scoring, coalesce(csi_max, -1) AS csi_max, CASE WHEN csi_red THEN 'Stop' ELSE 'OK' END AS csi_status,
    CASE WHEN done IS NULL THEN 'DQR Process Pending' WHEN pre_red THEN 'Reprocess' WHEN lights OR csi_red THEN 'WARNING' ELSE 'OK' END AS general_status,
    round(coalesce(p.v, -1), 9) + 0.0::DOUBLE AS psi, round(coalesce(q.v, -1), 9) + 0.0::DOUBLE AS psi_variation FROM g LEFT JOIN av_ USING (model_id, information_date)
    LEFT JOIN (SELECT * FROM first_ WHERE metric_name = 'psi_canonical') p USING (model_id, information_date) LEFT JOIN (SELECT * FROM first_ WHERE metric_name = 'psi_dynamic') q USING (model_id, information_date)""")
def scoring_summary(t):
    available = data.run_log(t).where("status = 'SUCCESS'").select("model_id", "information_date").distinct().withColumn("done", F.lit(True))
    found = summary.scoring_summary(data.results(t), data.statistics(t), available)
    return found.select(
        "model_id", "information_date", "scoring_date", "vintage", "control_data_availability", "control_pre_scoring",
        F.coalesce("csi_max", F.lit(-1.0)).alias("csi_max"), "csi_status", "general_status",
        r6(F.coalesce("psi", F.lit(-1.0)), 9).alias("psi"), r6(F.coalesce("psi_variation", F.lit(-1.0)), 9).alias("psi_variation"),
    )


@check("alert_aggregate", f"""WITH {RES}, {ALERTS} SELECT model_id, information_date, var_type, total_metrics, count_ambar, count_red, equivalent_yellow, round(stress_ratio, 9) + 0.0::DOUBLE AS stress_ratio, aggregate_status FROM alr""")
def alert_aggregate(t):
    return data.alerts(t).select(
        "model_id", "information_date", "var_type", "total_metrics", "count_ambar", "count_red", "equivalent_yellow", r6("stress_ratio", 9).alias("stress_ratio"), "aggregate_status"
    )


WORST = "ov AS (SELECT model_id, information_date, CASE max(CASE aggregate_status WHEN 'RED' THEN 2 WHEN 'AMBAR' THEN 1 ELSE 0 END) WHEN 2 THEN 'RED' WHEN 1 THEN 'AMBAR' ELSE 'GREEN' END AS overall_status FROM alr GROUP BY 1, 2)"


@check("overall_status", f"WITH {RES}, {ALERTS}, {WORST} SELECT * FROM ov")
def overall_status(t):
    return al.overall_status(data.alerts(t))


def availability(t: Tables):
    """Freshness of each supplier's shipments against every month, as of mid-1999."""
    months = t.orders.select(F.trunc("o_orderdate", "month").alias("information_date")).distinct()
    source = F.concat(F.lit("ship_"), F.col("s_suppkey"))
    # A small file is one task, and each of its rows becomes one a month.
    configured = t.supplier.repartition(t.spark.sparkContext.defaultParallelism, "s_suppkey").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("model_id"), F.lit("wh").alias("source_schema"), source.alias("source_table"),
        F.when(F.col("s_nationkey") > 2, F.col("s_nationkey")).alias("deadline_days"),
    ).withColumn("_k", F.lit(1)).join(F.broadcast(months.withColumn("_k", F.lit(1))), "_k").drop("_k")
    newest = av.newest_dates(
        t.lineitem.where("l_suppkey % 5 > 0").select(F.concat(F.lit("ship_"), F.col("l_suppkey")).alias("source_table"), F.add_months(F.col("l_shipdate").cast("date"), -24).alias("date"))
    )
    return av.data_availability(configured, newest, F.lit("1999-06-15").cast("date"))


AVAIL = """mo AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders), nw AS (SELECT l_suppkey, max(CAST(l_shipdate AS DATE) - INTERVAL 24 MONTH) AS mx FROM lineitem WHERE l_suppkey % 5 > 0 GROUP BY 1),
  ava AS (SELECT 'S' || s_suppkey AS model_id, strftime(m, '%Y-%m-%d') AS information_date, 'wh' AS schema_name, 'ship_' || s_suppkey AS source_table, strftime(m, '%Y-%m-%d') AS scoring_date,
  strftime(m + CASE WHEN s_nationkey > 2 THEN s_nationkey ELSE 0 END, '%Y-%m-%d') AS deadline_data_ingestion, strftime(m, '%Y-%m-%d') AS vintage, strftime(m, '%Y-%m-%d') AS update_data_required,
  CASE WHEN mx >= m THEN 'Latest Data Updated' WHEN DATE '1999-06-15' <= m + CASE WHEN s_nationkey > 2 THEN s_nationkey ELSE 0 END THEN 'Data ingestion in progress'
    WHEN mx IS NOT NULL THEN 'Data Ingestation has not met the deadline' ELSE 'Not enough data to process the models' END AS control
  FROM supplier CROSS JOIN mo LEFT JOIN nw ON l_suppkey = s_suppkey)"""


@check("data_availability", f"WITH {AVAIL} SELECT * FROM ava")
def data_availability(t):
    return availability(t)


@check("availability_done", f"WITH {AVAIL} SELECT model_id, information_date, bool_and(control = 'Latest Data Updated') AS done FROM ava GROUP BY 1, 2")
def availability_done(t):
    return av.availability_done(availability(t))


@check("execution_log", f"""WITH {RES}, {LOG} SELECT model_id, information_date, 'SUCCESS' AS status, '' AS error_message, count(DISTINCT variable) AS variables_expected, 0 AS variables_missing, count(*) AS metrics_calculated, 0 AS metrics_failed FROM res GROUP BY 1, 2
  UNION ALL SELECT model_id, information_date, 'MISSING_DATA', 'no data', 0, CAST(sum(variables_missing) AS BIGINT), 0, 0 FROM log WHERE status = 'MISSING_DATA' GROUP BY 1, 2""")
def execution_log(t):
    missing = data.run_log(t).where("status = 'MISSING_DATA'").groupBy("model_id", "information_date").agg(
        F.lit("no data").alias("error_message"), F.sum("variables_missing").alias("variables_missing")
    )
    log = runs.execution_log(data.results(t), missing, "e1", "job")
    return log.select("model_id", "information_date", "status", "error_message", "variables_expected", "variables_missing", "metrics_calculated", "metrics_failed")


@check("missing_days", f"WITH {LOG} SELECT model_id, count(*) AS missing_days FROM log WHERE status = 'MISSING_DATA' AND CAST(information_date AS DATE) >= DATE '1997-06-08' - 7 GROUP BY 1")
def missing_days(t):
    return al.missing_days(data.run_log(t), F.lit("1997-06-08").cast("date"))


LATEST_RUN = "lrs AS (SELECT model_id, information_date, status AS run_status FROM (SELECT *, row_number() OVER (PARTITION BY model_id, information_date ORDER BY run_date DESC, status DESC) AS rn FROM log) WHERE rn = 1)"


@check("latest_run_status", f"WITH {LOG}, {LATEST_RUN} SELECT * FROM lrs")
def latest_run_status(t):
    return al.latest_run_status(data.run_log(t))


@check("output_validation", f"""WITH {RES}, {LOG}, d AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS information_date FROM orders), m AS (SELECT information_date, count(*) AS n FROM res GROUP BY 1), a AS (SELECT information_date, count(*) AS n FROM log GROUP BY 1)
  SELECT information_date, coalesce(m.n, 0) AS metric_rows, coalesce(a.n, 0) AS alert_rows, m.n IS NOT NULL AND a.n IS NOT NULL AS valid FROM d LEFT JOIN m USING (information_date) LEFT JOIN a USING (information_date)""")
def output_validation(t):
    dates = t.orders.select(iso("o_orderdate").alias("information_date")).distinct()
    return runs.output_validation(dates, data.results(t), data.run_log(t))


def changelog(t: Tables):
    return t.customer.select(
        F.concat(F.lit("S"), F.col("c_custkey")).alias("model_id"), F.concat(F.lit("1998-0"), (F.col("c_nationkey") % 9 + 1), F.lit("-01")).alias("process_date"),
        F.when(F.col("c_mktsegment") == "BUILDING", "UPDATED").otherwise("NEW_MODEL").alias("change_type"), (F.col("c_acctbal") > 0).alias("triggered_retraining"),
    )


CHL = """chl AS (SELECT 'S' || c_custkey AS model_id, '1998-0' || (c_nationkey % 9 + 1) || '-01' AS process_date, CASE WHEN c_mktsegment = 'BUILDING' THEN 'UPDATED' ELSE 'NEW_MODEL' END AS change_type, c_acctbal > 0 AS retrain FROM customer),
  lst AS (SELECT DISTINCT process_date, model_id FROM chl WHERE change_type = 'NEW_MODEL' AND retrain)"""


@check("training_validation", f"WITH {RES}, {CHL} SELECT process_date, model_id FROM lst EXCEPT SELECT information_date, model_id FROM res")
def training_validation(t):
    trained = data.results(t).select(F.col("information_date").alias("process_date"), "model_id")
    return runs.untrained_models(changelog(t), trained)


@check("config_changelog", """SELECT 'S' || s_suppkey AS model_id, 'NEW_MODEL' AS change_type, true AS triggered_retraining, '2001-01-01' AS process_date, 'model_summary' AS table_name FROM supplier WHERE s_suppkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def config_changelog(t):
    latest = t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("model_id"))
    known = t.orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(F.concat(F.lit("S"), F.col("o_custkey")).alias("model_id"))
    rows = runs.config_changes(latest, known, "model_summary", F.lit("2001-01-01"), "watch", "r1")
    return rows.select("model_id", "change_type", "triggered_retraining", "process_date", "table_name")


@check("digest_header", f"""WITH {RES}, {LOG}, {ALERTS}, {WORST}, {LATEST_RUN} SELECT l.model_id, l.information_date, CASE WHEN run_status = 'MISSING_DATA' THEN 'MISSING_DATA' ELSE coalesce(overall_status, 'GREEN') END AS alert_type,
  '[MON] ' || CASE WHEN run_status = 'MISSING_DATA' THEN 'MISSING_DATA' ELSE coalesce(overall_status, 'GREEN') END || ' - ' || l.model_id || ' - ' || l.information_date AS subject
  FROM lrs l LEFT JOIN ov USING (model_id, information_date) WHERE run_status = 'MISSING_DATA' OR (run_status = 'SUCCESS' AND (l.model_id, l.information_date) IN (SELECT model_id, information_date FROM res))""")
def digest_header(t):
    return al.digest_header(data.run_log(t), data.alerts(t), data.results(t), "[MON]")


@check("digest_mail", f"""WITH {RES}, {LOG}, {ALERTS}, {WORST}, {LATEST_RUN}, {CON}, {FLAGS}, {MISS}, {ADDRESSED}, sent AS (
  SELECT l.model_id, l.information_date, CASE WHEN run_status = 'MISSING_DATA' THEN 'MISSING_DATA' ELSE coalesce(overall_status, 'GREEN') END AS alert_type FROM lrs l LEFT JOIN ov USING (model_id, information_date)
    WHERE run_status = 'MISSING_DATA' OR (run_status = 'SUCCESS' AND (l.model_id, l.information_date) IN (SELECT model_id, information_date FROM res)))
  SELECT model_id, information_date, alert_type, '[MON] ' || alert_type || ' - ' || model_id || ' - ' || information_date AS subject, recipients_to, recipients_bcc
  FROM sent JOIN adr USING (model_id, information_date) WHERE recipients_to <> ''""")
def digest_mail(t):
    header = al.digest_header(data.run_log(t), data.alerts(t), data.results(t), "[MON]")
    path = scratch(t, "mail")
    sinks.append_rows(al.digest_mail(header, addressed(t), "e1"), "email_log", path)
    return t.spark.read.parquet(path).select("model_id", "information_date", "alert_type", "subject", "recipients_to", "recipients_bcc")


@check("alert_digest", f"""WITH {RES}, {ALERTS}, dg AS (SELECT model_id, information_date, 'types' AS section, var_type AS item, 'stress_ratio' AS metric_name, stress_ratio AS value, aggregate_status AS status FROM alr
  UNION ALL SELECT model_id, information_date, 'red', variable, metric_name, metric_value, status FROM res WHERE status = 'RED'
  UNION ALL SELECT model_id, information_date, 'performance', variable, metric_name, metric_value, status FROM res WHERE metric_name IN ('auc', 'gini', 'brier_score', 'lift_top_decile')
  UNION ALL SELECT model_id, information_date, 'target', variable, metric_name, metric_value, status FROM res WHERE var_type = 'target')
  SELECT model_id, information_date, section, item, metric_name, round(value, 9) + 0.0::DOUBLE AS value, status FROM dg""")
def alert_digest(t):
    lines = al.alert_digest(data.alerts(t), data.results(t))
    return lines.select("model_id", "information_date", "section", "item", "metric_name", r6("value", 9).alias("value"), "status")


# -- whole jobs -------------------------------------------------------------------------


@check("monitor_orders", f"""WITH {NUM}, {QTL}, {sizes_sql('num')}, ed AS (SELECT d, variable, i // 2 AS k, value AS e FROM q WHERE side = 'baseline' AND i % 2 = 0 AND i > 0 AND i < 20),
  bn AS (SELECT num.d, num.variable, num.side, count(*) FILTER (ed.e < num.value) AS bin FROM (SELECT *, row_number() OVER () AS rid FROM num WHERE value IS NOT NULL) AS num JOIN ed ON ed.d = num.d AND ed.variable = num.variable GROUP BY 1, 2, 3, rid),
  dy AS (SELECT d, variable, bin, count(*) FILTER (side = 'current') AS c, count(*) FILTER (side = 'baseline') AS e FROM bn GROUP BY 1, 2, 3), tt AS (SELECT d, variable, greatest(sum(c), 1)::DOUBLE AS tc, greatest(sum(e), 1)::DOUBLE AS te FROM dy GROUP BY 1, 2),
  ps AS (SELECT d, variable, sum((c / tc - e / te) * ln((c / tc + 1e-6) / (e / te + 1e-6))) AS v FROM dy JOIN tt USING (d, variable) GROUP BY 1, 2),
  nr AS (SELECT d, variable, coalesce(count(*) FILTER (side = 'current' AND value IS NULL) / nullif(count(*) FILTER (side = 'current'), 0), 0) AS v FROM num GROUP BY 1, 2),
  al AS (SELECT d, variable, CASE WHEN v >= 0.10 THEN 'RED' WHEN v >= 0.05 THEN 'AMBAR' ELSE 'GREEN' END AS status FROM nr
    UNION ALL SELECT d, variable, CASE WHEN v >= 0.30 THEN 'RED' WHEN v >= 0.15 THEN 'AMBAR' ELSE 'GREEN' END FROM (SELECT d, variable, CASE WHEN n_cur > 0 THEN abs(n_base / n_cur - 1) ELSE 1 END AS v FROM sz WHERE n_base > 0)
    UNION ALL SELECT d, variable, CASE WHEN v >= 0.20 THEN 'RED' WHEN v >= 0.10 THEN 'AMBAR' ELSE 'GREEN' END FROM (SELECT d, variable, CASE WHEN c50 IS NULL OR b50 IS NULL THEN 0 WHEN b50 <> 0 THEN abs(c50 - b50) / abs(b50) WHEN c50 = 0 THEN 0 ELSE 1 END AS v FROM sz LEFT JOIN qw USING (d, variable) WHERE n_base > 0)
    UNION ALL SELECT d, variable, CASE WHEN v >= 0.20 THEN 'RED' WHEN v >= 0.10 THEN 'AMBAR' ELSE 'GREEN' END FROM ps),
  g AS (SELECT d, CASE variable WHEN 'price' THEN 'raw' ELSE 'score' END AS var_type, CASE variable WHEN 'price' THEN 3 ELSE 2 END AS w, count(*) AS total_metrics, count(*) FILTER (status = 'AMBAR') AS count_ambar, count(*) FILTER (status = 'RED') AS count_red FROM al GROUP BY 1, 2, 3)
  SELECT 'orders' AS model_id, d AS information_date, var_type, total_metrics, count_ambar, count_red, round((count_ambar + count_red * w) / (total_metrics * w)::DOUBLE, 9) + 0.0::DOUBLE AS stress_ratio,
  CASE WHEN (count_ambar + count_red * w) / (total_metrics * w)::DOUBLE >= CASE w WHEN 3 THEN 0.40::DOUBLE ELSE 0.15::DOUBLE END THEN 'RED' WHEN (count_ambar + count_red * w) / (total_metrics * w)::DOUBLE >= CASE w WHEN 3 THEN 0.60::DOUBLE ELSE 0.30::DOUBLE END THEN 'AMBAR' ELSE 'GREEN' END AS aggregate_status FROM g""")
def monitor_orders(t):
    rows = data.numbers(t)
    measured = registry.measure(quality.counts(rows), [registry.get(m) for m in ("null_rate", "population_variation")]).unionByName(
        registry.measure(stability.quantiles(rows), [registry.get(m) for m in ("median_shift", "psi_dynamic")])
    )
    lights = thresholds.with_status(thresholds.resolve_thresholds(measured))
    return al.alert_aggregate(lights).select(
        "model_id", "information_date", "var_type", "total_metrics", "count_ambar", "count_red", r6("stress_ratio", 9).alias("stress_ratio"), "aggregate_status"
    )


def order_model(t: Tables):
    """Configuration of a monthly model over the order tables: 14 variables in 5 source tables."""
    o = t.orders.withColumns({"month": F.date_format("o_orderdate", "yyyyMM"), "customer": F.col("o_orderkey")})
    li = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"), F.avg("l_discount").alias("disc"), F.sum("l_extendedprice").alias("ext"), F.avg("l_tax").alias("tax"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("target"),
    )
    spread = t.spark.sparkContext.defaultParallelism
    lines = reliable(o.select("o_orderkey", "month").join(li, "o_orderkey").repartition(spread, "o_orderkey"))
    sources = {
        "raw_orders": o.select(
            "o_orderkey", "month", F.col("o_totalprice").alias("price"), (F.col("o_totalprice") % 1000).alias("cents"),
            F.nullif(F.col("o_custkey").cast("double"), F.lit(0.0)).alias("cust"), F.dayofmonth("o_orderdate").alias("day"),
            F.col("o_orderpriority").alias("priority"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        ),
        "inputs": lines.select("o_orderkey", "month", "qty", "disc", "ext", "tax"),
        "features": o.select("o_orderkey", "month", F.ln("o_totalprice").alias("log_price"), F.floor(F.col("o_totalprice") / 50000).alias("band")),
        "scores": o.select("o_orderkey", "month", (F.col("o_totalprice") / 500000).alias("score")),
        "targets": lines.select("o_orderkey", "month", "target"),
    }
    variables = [
        *[(v, "raw", "numeric", "raw_orders") for v in ("price", "cents", "cust", "day")],
        *[(v, "raw", "categorical", "raw_orders") for v in ("priority", "status")],
        *[(v, "input", "numeric", "inputs") for v in ("qty", "disc", "ext", "tax")],
        *[(v, "transformed", "numeric", "features") for v in ("log_price", "band")],
        ("score", "score", "numeric", "scores"), ("target", "target", "binary", "targets"),
    ]
    spark, d, model = t.spark, "1995-01-01", data.MODEL
    base = scratch(t, "sources")
    write = lambda name: sources[name].repartition(spread, "o_orderkey").write.parquet(f"{base}/{name}")
    side_by_side([lambda name=name: write(name) for name in sources])
    variables = [(v, vt, dt, f"{base}/{s}", v, d, model) for v, vt, dt, s in variables]
    meta = spark.createDataFrame(variables, "variable string, var_type string, data_type string, source_table string, source_column string, process_date string, model_id string")
    roles = {"raw_orders": "raw", "inputs": "input", "features": "processed", "scores": "score", "targets": "target"}
    conf = spark.createDataFrame(
        [(r, s, "PARQUET", "", f"{base}/{s}", '["o_orderkey"]', '["o_orderkey"]', "month", "%Y%m", 84, 2 if s == "targets" else 0, "", "[]", "first", False, True, 10, d, model) for s, r in roles.items()],
        "table_role string, table_name string, source_type string, source_schema string, source_table string, entity_key_columns string, canonical_key_columns string, date_column string, date_format string, history_months int, lag int, sql_transform string, partition_columns string, reading_mode string, use_business_days boolean, active boolean, deadline_days int, process_date string, model_id string",
    )
    model_row = spark.createDataFrame([("Orders", "active", 0.5, "monthly", d, model)], "model_name string, status string, cut_off_probability double, frequency string, process_date string, model_id string")
    return ConfigTables(model_row, meta, conf, data.calendar(t))


def monthly_config(t: Tables, variables: list[tuple], sources: dict[str, tuple[str, int]]) -> ConfigTables:
    """Configuration of monthly models. ``variables``: variable, type, data type, source, model; ``sources``: role and lag."""
    spark, d = t.spark, "1995-01-01"
    models = sorted({v[-1] for v in variables})
    meta = spark.createDataFrame(
        [(v, vt, dt, s, v, d, m) for v, vt, dt, s, m in variables],
        "variable string, var_type string, data_type string, source_table string, source_column string, process_date string, model_id string",
    )
    conf = spark.createDataFrame(
        [(role, s, "PARQUET", "", s, '["o_orderkey"]', '["o_orderkey"]', "month", "%Y%m", 84, lag, "", "[]", "first", False, True, 10, d, m) for s, (role, lag) in sources.items() for m in models],
        "table_role string, table_name string, source_type string, source_schema string, source_table string, entity_key_columns string, canonical_key_columns string, date_column string, date_format string, history_months int, lag int, sql_transform string, partition_columns string, reading_mode string, use_business_days boolean, active boolean, deadline_days int, process_date string, model_id string",
    )
    rows = spark.createDataFrame([(m, "active", 0.5, "monthly", d, m) for m in models], "model_name string, status string, cut_off_probability double, frequency string, process_date string, model_id string")
    return ConfigTables(rows, meta, conf, data.calendar(t))


def joint_model(t: Tables):
    """Configuration and sources of a model with score, a target two months later, and two inputs."""
    o = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("month"), (F.col("o_totalprice") / 500000).alias("score"))
    li = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("ext"))
    sources = {
        "scores": o, "targets": o.drop("score").join(data.outcomes(t), "o_orderkey"), "inputs": o.drop("score").join(li, "o_orderkey"),
    }
    variables = [
        ("score", "score", "numeric", "scores", data.MODEL), ("target", "target", "binary", "targets", data.MODEL),
        ("ext", "input", "numeric", "inputs", data.MODEL), ("qty", "input", "numeric", "inputs", data.MODEL),
    ]
    config = monthly_config(t, variables, {"scores": ("score", 0), "targets": ("target", 2), "inputs": ("input", 0)})
    return config, None, sources


def order_runs(t: Tables):
    """Every month of the order table as a run."""
    return t.orders.select(F.lit(data.MODEL).alias("model_id"), iso(month("o_orderdate")).alias("information_date")).distinct()


@check("run_metrics")
def run_metrics(t):
    found = Monitor(t.spark, order_model(t)).run(order_runs(t)).results.fillna(0.0, ["metric_value"])
    return found.select("model_id", "information_date", "var_type", "variable", "metric_name", r6("metric_value", 9).alias("metric_value"), "status")


@check("execution_log_failures", f"""WITH {ORD}, mon AS (SELECT DISTINCT m FROM ord)
  SELECT 'good' AS model_id, strftime(m, '%Y-%m-%d') AS information_date, 'SUCCESS' AS status, '' AS error_message, CASE WHEN m IN (DATE '1997-05-01', DATE '1997-06-01') THEN 1 ELSE 0 END AS metrics_failed FROM mon
  UNION ALL SELECT 'no column', strftime(m, '%Y-%m-%d'), 'FAILED', 'missing columns [''mark''] in scores', 0 FROM mon
  UNION ALL SELECT 'no table', strftime(m, '%Y-%m-%d'), 'FAILED', 'table metadata not found for elsewhere', 0 FROM mon""")
def execution_log_failures(t):
    """A model whose score is empty for a month, and two that cannot be read as configured: the others go on."""
    empty = F.date_format("o_orderdate", "yyyyMM") == "199705"
    scores = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("month"), F.when(~empty, F.col("o_totalprice") / 500000).alias("score"))
    variables = [("score", "score", "numeric", "scores", m) for m in ("good", "no column", "no table")]
    variables += [("mark", "score", "numeric", "scores", "no column"), ("age", "raw", "numeric", "elsewhere", "no table")]
    config_ = monthly_config(t, variables, {"scores": ("score", 0)})
    models = F.explode(F.array(*[F.lit(m) for m in ("good", "no column", "no table")]))
    asked = order_runs(t).select("information_date").withColumn("model_id", models)
    found = Monitor(t.spark, config_, None, {"scores": scores}).run(asked)
    log = runs.execution_log(found.results, found.missing, "exec", "monitoring", failed=found.failed)
    return log.select("model_id", "information_date", "status", "error_message", "metrics_failed")


@check("run_model_date")
def run_model_date(t):
    paths = run_models(t.spark, order_model(t), order_runs(t), scratch(t, "run"), "exec", as_of=F.lit("2001-08-01").cast("date"))
    found = t.spark.read.parquet(paths["scoring_summary"])
    return found.select(
        "model_id", F.col("information_date").cast("string").alias("information_date"), "control_data_availability", "control_pre_scoring",
        r6("psi_variation", 9).alias("psi_variation"), "csi_status", "population_scored", "general_status",
    )


@check("train_model")
def train_model(t):
    found = Trainer(t.spark, order_model(t)).run("2001-08-01")["csi_psi_table"]
    return found.select("model_id", "type", "variable", "bin", "bin_type", "count_dev")


