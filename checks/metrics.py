"""The 27 metrics and their parts over every month of the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import data
from checks.catalog import Tables, check, r6
from checks.data import INP, NUM, PRS, QTL, TGT, TXT, sizes_sql
from modelmon.functions.columns import KEYS
from modelmon.operators import bins, conjugate, quality, registry, score, stability, target

SQL_END = """SELECT d AS information_date, variable, coalesce(round(v::DOUBLE, 9), 0)::DOUBLE + 0.0::DOUBLE AS metric_value,
  coalesce(round(b::DOUBLE, 9), -1)::DOUBLE + 0.0::DOUBLE AS baseline_value FROM ("""


def shown(table: DataFrame, name: str) -> DataFrame:
    rows = registry.measure(table, [registry.get(name)])
    return rows.select(
        "information_date", "variable", r6("metric_value", 9).alias("metric_value"),
        (F.coalesce(F.round("baseline_value", 9), F.lit(-1.0)) + F.lit(0.0)).alias("baseline_value"),
    )


def metric(name: str, ctes: str, body: str):
    return check(name, f"WITH {ctes} {SQL_END}{body})")


def psi_sql(source: str, c: str = "c", e: str = "e") -> str:
    """PSI over (d, variable, counts c and e per bin)."""
    return f"""SELECT d, variable, sum(({c} / tc - {e} / te) * ln(({c} / tc + 1e-6) / ({e} / te + 1e-6))) AS v, 0.0 AS b
      FROM {source} JOIN (SELECT d, variable, greatest(sum({c}), 1)::DOUBLE AS tc, greatest(sum({e}), 1)::DOUBLE AS te
      FROM {source} GROUP BY 1, 2) USING (d, variable) GROUP BY 1, 2"""


# Stored bins: score bands of the whole order table (with counts), so expected shares are fixed.
STORED = """band AS (SELECT i AS bin, CASE WHEN i = 0 THEN NULL ELSE i / 5.0 END::DOUBLE AS lb,
  CASE WHEN i = 4 THEN NULL ELSE (i + 1) / 5.0 END::DOUBLE AS ub FROM (SELECT unnest(range(0, 5)) AS i)),
  dev AS (SELECT bin, lb, ub, count(*) AS count_dev FROM band JOIN orders ON (lb IS NULL OR o_totalprice / 500000 > lb)
  AND (ub IS NULL OR o_totalprice / 500000 <= ub) GROUP BY 1, 2, 3)"""
IN_DEV = "(lb IS NULL OR value > lb) AND (ub IS NULL OR value <= ub)"


def stored_bins(t: Tables) -> DataFrame:
    """Five score bands with their counts over the whole order table."""
    edges = [(i, None if i == 0 else i / 5.0, None if i == 4 else (i + 1) / 5.0) for i in range(5)]
    band = t.spark.createDataFrame(edges, "bin int, lb double, ub double")
    everything = t.orders.select(
        F.lit(data.MODEL).alias("model_id"), F.lit("all").alias("information_date"), F.lit("score").alias("var_type"),
        F.lit("score").alias("variable"), F.lit("current").alias("side"), (F.col("o_totalprice") / 500000).alias("value"),
    )
    fixed = {"model_id": F.lit(data.MODEL), "type": F.lit("score"), "variable": F.lit("score")}
    plain = bins.normalise_bins(band.withColumns(fixed))
    counted = bins.bin_counts(everything, plain).select("bin", F.col("n_cur").alias("counted"))
    return plain.join(counted, "bin").withColumn("count_dev", F.col("counted")).drop("counted")


# -- quality ----------------------------------------------------------------------------


@metric("null_rate", NUM, """SELECT d, variable, count(*) FILTER (side = 'current' AND value IS NULL) / nullif(count(*) FILTER (side = 'current'), 0) AS v,
  count(*) FILTER (side = 'baseline' AND value IS NULL) / nullif(count(*) FILTER (side = 'baseline'), 0) AS b FROM num GROUP BY 1, 2""")
def null_rate(t):
    return shown(quality.counts(data.numbers(t)), "null_rate")


@metric("cardinality_ratio", NUM, """SELECT d, variable, count(DISTINCT value) FILTER (side = 'current') / nullif(count(*) FILTER (side = 'current'), 0) AS v,
  NULL AS b FROM num GROUP BY 1, 2""")
def cardinality_ratio(t):
    return shown(quality.distinct(data.numbers(t)), "cardinality_ratio")


@metric("outlier_rate", f"{NUM}, {QTL}", """SELECT d, variable, count(*) FILTER (side = 'current' AND (value < c25 - 1.5 * (c75 - c25)
  OR value > c75 + 1.5 * (c75 - c25))) / nullif(count(*) FILTER (side = 'current'), 0) AS v, NULL AS b
  FROM num LEFT JOIN qw USING (d, variable) GROUP BY 1, 2""")
def outlier_rate(t):
    rows = data.numbers(t)
    return shown(quality.outliers(rows, stability.quartiles(stability.quantiles(rows))), "outlier_rate")


@metric("dominant_category_rate", TXT, """SELECT d, variable, max(c) / nullif(sum(c), 0) AS v, NULL AS b FROM (SELECT d, variable, value,
  count(*) FILTER (side = 'current') AS c FROM txt GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def dominant_category_rate(t):
    return shown(quality.categories(data.texts(t)), "dominant_category_rate")


TOP3 = """vc AS (SELECT d, variable, side, value, count(*) AS c FROM txt GROUP BY 1, 2, 3, 4),
  top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY d, variable, side ORDER BY c DESC, value NULLS LAST) AS rn FROM vc) WHERE rn <= {n})"""


@metric("category_composition_drift", f"{TXT}, {TOP3.format(n=3)}", """SELECT d, variable, 1 - count(*) FILTER (s = 2) / count(*) AS v,
  count(*) FILTER (s = 2) / count(*) AS b FROM (SELECT d, variable, value, count(DISTINCT side) AS s FROM top GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def category_composition_drift(t):
    return shown(quality.categories(data.texts(t), 3), "category_composition_drift")


@metric("median_shift", f"{NUM}, {QTL}, {sizes_sql('num')}", """SELECT d, variable, CASE WHEN c50 IS NULL OR b50 IS NULL THEN 0
  WHEN b50 <> 0 THEN abs(c50 - b50) / abs(b50) WHEN c50 = 0 THEN 0 ELSE 1 END AS v, b50 AS b FROM sz LEFT JOIN qw USING (d, variable) WHERE n_base > 0""")
def median_shift(t):
    return shown(stability.quantiles(data.numbers(t)), "median_shift")


@metric("population_variation", f"{NUM}, {sizes_sql('num')}", """SELECT d, variable, CASE WHEN n_cur > 0 THEN abs(n_base / n_cur - 1) ELSE 1 END AS v,
  n_base AS b FROM sz WHERE n_base > 0""")
def population_variation(t):
    return shown(quality.counts(data.numbers(t)), "population_variation")


@check("completeness", """WITH present AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'),
  days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
  SELECT strftime(date_trunc('month', days.date), '%Y-%m-%d') AS information_date, count(*) AS expected_dates,
  round(count(*) FILTER (present.date IS NULL) / count(*), 6) + 0.0 AS metric_value
  FROM days LEFT JOIN present USING (date) GROUP BY 1""")
def completeness(t):
    def keyed(df):
        day = df.select(F.col("o_orderdate").cast("date").alias("date"))
        return day.select(
            F.lit(data.MODEL).alias("model_id"), F.date_format(F.trunc("date", "month"), "yyyy-MM-dd").alias("information_date"),
            F.lit("raw").alias("var_type"), F.lit("price").alias("variable"), "date",
        )

    urgent = t.orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    table = quality.completeness(keyed(t.orders), keyed(urgent))
    rows = registry.measure(table, [registry.get("completeness")])
    return rows.join(table, KEYS).select("information_date", "expected_dates", r6("metric_value").alias("metric_value"))


# -- stability --------------------------------------------------------------------------

DYN = """edge AS (SELECT d, variable, i // 2 AS k, value AS e FROM q WHERE side = 'baseline' AND i % 2 = 0 AND i > 0 AND i < 20),
  binned AS (SELECT num.d, num.variable, num.side, count(*) FILTER (edge.e < num.value) AS bin FROM
  (SELECT *, row_number() OVER () AS rid FROM num WHERE value IS NOT NULL) AS num
  JOIN edge ON edge.d = num.d AND edge.variable = num.variable GROUP BY 1, 2, 3, rid),
  dyn AS (SELECT d, variable, bin, count(*) FILTER (side = 'current') AS c, count(*) FILTER (side = 'baseline') AS e FROM binned GROUP BY 1, 2, 3)"""


@metric("psi_dynamic", f"{NUM}, {QTL}, {DYN}", psi_sql("dyn"))
def psi_dynamic(t):
    return shown(stability.quantiles(data.numbers(t)), "psi_dynamic")


TOP_BASE = """vc AS (SELECT d, variable, value, count(*) FILTER (side = 'current') AS n_cur, count(*) FILTER (side = 'baseline') AS n_base FROM txt GROUP BY 1, 2, 3),
  cat AS (SELECT d, variable, CASE WHEN value IS NULL THEN 0 ELSE n_cur END AS c, n_base AS e FROM (SELECT *, row_number() OVER
  (PARTITION BY d, variable ORDER BY n_base DESC, value NULLS LAST) AS rn FROM vc WHERE n_base > 0) WHERE rn <= 3)"""


@metric("psi_dynamic_categorical", f"{TXT}, {TOP_BASE}", psi_sql("cat"))
def psi_dynamic_categorical(t):
    return shown(stability.dynamic_categories(data.texts(t), 3), "psi_dynamic")


@metric("psi_canonical", f"{NUM}, {QTL}, {DYN}, {STORED}, {sizes_sql('num')}, st AS (SELECT sz.d, sz.variable, dev.bin, count(value) AS c, any_value(count_dev) AS e FROM sz JOIN dev ON sz.variable = 'score' "
        f"LEFT JOIN num ON num.d = sz.d AND num.variable = sz.variable AND side = 'current' AND {IN_DEV} GROUP BY 1, 2, 3)",
        f"SELECT * FROM ({psi_sql('st')}) UNION ALL SELECT * FROM ({psi_sql('dyn')}) WHERE variable = 'price'")
def psi_canonical(t):
    rows = data.numbers(t)
    dynamic = stability.quantiles(rows).where(F.col("n_base") > 0)
    return shown(stability.canonical_psi(rows, stored_bins(t), dynamic), "psi_canonical")


@metric("psi", f"{NUM}, {STORED}, st AS (SELECT d, variable, bin, count(*) FILTER (side = 'current') AS c, count(*) FILTER (side = 'baseline') AS e FROM num JOIN dev ON variable = 'score' AND {IN_DEV} GROUP BY 1, 2, 3)", psi_sql("st"))
def psi(t):
    counted = bins.bin_counts(data.numbers(t, "score"), stored_bins(t))
    found = bins.psi(counted, "n_cur", "n_base")
    return found.select(
        "information_date", "variable", r6("psi", 9).alias("metric_value"), F.lit(0.0).alias("baseline_value")
    )


@metric("ks_vs_dev", f"{NUM}, {QTL}, {sizes_sql('num')}", """SELECT d, variable, greatest(1e-9, max(abs(c / greatest(n_cur, 1) - b0 / greatest(n_base, 1)))) AS v, 0.0 AS b FROM (
  SELECT pq.d, pq.variable, pq.i, count(*) FILTER (side = 'current') AS c, count(*) FILTER (side = 'baseline') AS b0 FROM pq JOIN num
  ON num.d = pq.d AND num.variable = pq.variable AND num.value <= pq.value GROUP BY 1, 2, 3) JOIN sz USING (d, variable) WHERE n_base > 0 GROUP BY 1, 2""")
def ks_vs_dev(t):
    return shown(stability.quantiles(data.numbers(t)), "ks_vs_dev")


PAIRS = [("price", "qty"), ("price", "disc"), ("price", "ext"), ("qty", "disc"), ("qty", "ext"), ("disc", "ext")]
CORR = "greatest(1e-9, " + ", ".join(f"coalesce(nullif(abs(corr(coalesce({a}, 0), coalesce({b}, 0))), 'nan'::DOUBLE), 0)" for a, b in PAIRS) + ")"


@metric("correlation_drift", f"{INP}, co AS (SELECT d, side, {CORR} AS r, count(*) AS n FROM inp GROUP BY 1, 2)",
        """SELECT d, '__INPUTS__' AS variable, CASE WHEN max(r) FILTER (side = 'baseline') IS NULL THEN max(r) FILTER (side = 'current')
  ELSE abs(max(r) FILTER (side = 'current') - max(r) FILTER (side = 'baseline')) END AS v, max(r) FILTER (side = 'baseline') AS b FROM co GROUP BY 1""")
def correlation_drift(t):
    rows = data.inputs(t)
    return shown(stability.correlation(rows, ["price", "qty", "disc", "ext"]), "correlation_drift")


# -- score ------------------------------------------------------------------------------


@metric("range_violation", NUM, """SELECT d, variable, count(*) FILTER (side = 'current' AND (value < 0 OR value > 1)) / nullif(count(*) FILTER (side = 'current'), 0) AS v, NULL AS b FROM num GROUP BY 1, 2""")
def range_violation(t):
    return shown(quality.counts(data.numbers(t)), "range_violation")


@metric("entropy", f"""{NUM}, bd AS (SELECT d, variable, side, least(floor(value * 10), 9) AS k, count(*) AS c FROM (SELECT * FROM num WHERE variable = 'score') GROUP BY 1, 2, 3, 4),
  h AS (SELECT d, variable, side, sum(-c / n * ln(c / n)) AS h FROM bd JOIN (SELECT d, variable, side, sum(c)::DOUBLE AS n FROM bd GROUP BY 1, 2, 3) USING (d, variable, side) GROUP BY 1, 2, 3),
  hw AS (SELECT d, variable, coalesce(max(h) FILTER (side = 'current'), 0) AS hc, max(h) FILTER (side = 'baseline') AS hb FROM h GROUP BY 1, 2)""",
        "SELECT d, variable, CASE WHEN hb IS NULL THEN hc WHEN hb <> 0 THEN abs(hc - hb) / hb ELSE 0 END AS v, hb AS b FROM hw")
def entropy(t):
    return shown(score.entropy(data.numbers(t, "score")), "entropy")


@metric("approval_rate", f"""{NUM}, ap AS (SELECT d, variable, coalesce(count(*) FILTER (side = 'current' AND value > 0.5) / nullif(count(*) FILTER (side = 'current'), 0), 0) AS rc,
  count(*) FILTER (side = 'baseline' AND value > 0.5) / nullif(count(*) FILTER (side = 'baseline'), 0) AS rb FROM num WHERE variable = 'score' GROUP BY 1, 2)""",
        "SELECT d, variable, CASE WHEN rb IS NULL THEN rc WHEN rb <> 0 THEN abs(rc - rb) / rb WHEN rc > 0 THEN 1 ELSE 0 END AS v, rb AS b FROM ap")
def approval_rate(t):
    return shown(quality.counts(data.numbers(t, "score"), 0.5), "approval_rate")


@metric("tail_shift", f"{NUM}, {QTL}, {sizes_sql('num')}", """SELECT d, variable, abs(c10 - b10) + abs(c90 - b90) AS v, 0.0 AS b FROM sz LEFT JOIN qw USING (d, variable) WHERE n_base > 0""")
def tail_shift(t):
    return shown(stability.quantiles(data.numbers(t)), "tail_shift")


GINI = """gr AS (SELECT d, variable, side, value, row_number() OVER (PARTITION BY d, variable, side ORDER BY value NULLS FIRST) AS rk FROM num),
  gi AS (SELECT d, variable, side, CASE WHEN coalesce(sum(value), 0) = 0 OR count(*) < 2 THEN 0 ELSE 2.0 * sum(value * rk) / (count(*) * sum(value)) - (count(*) + 1.0) / count(*) END AS g FROM gr GROUP BY 1, 2, 3),
  gw AS (SELECT d, variable, max(g) FILTER (side = 'current') AS gc, max(g) FILTER (side = 'baseline') AS gb FROM gi GROUP BY 1, 2)"""


@metric("concentration_gini", f"{NUM}, {GINI}", "SELECT d, variable, CASE WHEN gb <> 0 THEN abs(gc - gb) / abs(gb) ELSE abs(gc) END AS v, gb AS b FROM gw WHERE gb IS NOT NULL")
def concentration_gini(t):
    return shown(score.concentration(data.numbers(t)), "concentration_gini")


def _split(kind: str) -> tuple[str, str]:
    op = ">" if kind == "approved" else "<="
    return (
        f"{NUM}, {STORED}, {sizes_sql('num')}, part AS (SELECT DISTINCT d, variable FROM num WHERE variable = 'score' AND value {op} 0.5), "
        f"st AS (SELECT part.d, part.variable, dev.bin, count(value) AS c, any_value(count_dev) AS e FROM part CROSS JOIN dev "
        f"LEFT JOIN num ON num.d = part.d AND num.variable = 'score' AND side = 'current' AND value {op} 0.5 AND {IN_DEV} GROUP BY 1, 2, 3)",
        f"SELECT sz.d, sz.variable, v, 0.0 AS b FROM sz LEFT JOIN ({psi_sql('st')}) USING (d, variable) WHERE n_base > 0 AND variable = 'score'",
    )


@metric("psi_approved", *_split("approved"))
def psi_approved(t):
    return shown(score.split_psi(data.numbers(t, "score"), stored_bins(t), 0.5), "psi_approved")


@metric("psi_rejected", *_split("rejected"))
def psi_rejected(t):
    return shown(score.split_psi(data.numbers(t, "score"), stored_bins(t), 0.5), "psi_rejected")


# -- score with outcome -----------------------------------------------------------------

AUC = """ar AS (SELECT d, side, target, rank() OVER (PARTITION BY d, side ORDER BY score) + (count(*) OVER (PARTITION BY d, side, score) - 1) / 2.0 AS rk FROM prs),
  au AS (SELECT d, side, count(*) FILTER (target > 0.5) AS p, count(*) FILTER (target <= 0.5) AS q, sum(rk) FILTER (target > 0.5) AS s FROM ar GROUP BY 1, 2),
  ax AS (SELECT d, side, CASE WHEN p = 0 THEN 0 WHEN q = 0 THEN 1 ELSE (s - p * (p + 1) / 2.0) / (p * q) END AS a FROM au),
  aw AS (SELECT d, '__SCORE__' AS variable, max(a) FILTER (side = 'current') AS ac, max(a) FILTER (side = 'baseline') AS ab FROM ax GROUP BY 1)"""


@metric("auc", f"{PRS}, {AUC}", "SELECT d, variable, ac AS v, ab AS b FROM aw WHERE ac IS NOT NULL")
def auc(t):
    return shown(conjugate.roc(data.pairs(t)), "auc")


@metric("gini", f"{PRS}, {AUC}", """SELECT d, variable, CASE WHEN ab IS NULL THEN 2 * ac - 1 WHEN 2 * ab - 1 <> 0 THEN ((2 * ab - 1) - (2 * ac - 1)) / (2 * ab - 1) ELSE 0 END AS v,
  2 * ab - 1 AS b FROM aw WHERE ac IS NOT NULL""")
def gini(t):
    return shown(conjugate.roc(data.pairs(t)), "gini")


def _sides(expr: str) -> str:
    return (
        f"{PRS}, f AS (SELECT d, side, {expr} AS x FROM prs GROUP BY 1, 2), fw AS (SELECT d, '__SCORE__' AS variable, "
        "max(x) FILTER (side = 'current') AS xc, max(x) FILTER (side = 'baseline') AS xb FROM f GROUP BY 1)"
    )


@metric("brier_score", _sides("avg(pow(score - target, 2))"),
        "SELECT d, variable, CASE WHEN xb IS NULL THEN xc WHEN xb <> 0 THEN (xc - xb) / xb ELSE 0 END AS v, xb AS b FROM fw WHERE xc IS NOT NULL")
def brier_score(t):
    return shown(conjugate.fit(data.pairs(t)), "brier_score")


@metric("calibration_slope", _sides("CASE WHEN count(*) < 2 THEN 1.0 ELSE coalesce(CASE WHEN isnan(regr_slope(target, score)) THEN NULL ELSE regr_slope(target, score) END, 0) END"),
        "SELECT d, variable, CASE WHEN xb IS NOT NULL AND xb <> 0 THEN abs(xc - xb) / abs(xb) ELSE abs(xc - 1) END AS v, xb AS b FROM fw WHERE xc IS NOT NULL")
def calibration_slope(t):
    return shown(conjugate.fit(data.pairs(t)), "calibration_slope")


TILE = "tl AS (SELECT d, side, target, ntile(10) OVER (PARTITION BY d, side ORDER BY score DESC NULLS LAST, o_orderkey) AS tile FROM prs)"


@metric("lift_top_decile", f"""{PRS}, {TILE}, f AS (SELECT d, side, CASE WHEN avg(target) <> 0 THEN avg(target) FILTER (tile = 1) / avg(target) ELSE 0 END AS x FROM tl GROUP BY 1, 2),
  fw AS (SELECT d, '__SCORE__' AS variable, max(x) FILTER (side = 'current') AS xc, max(x) FILTER (side = 'baseline') AS xb FROM f GROUP BY 1)""",
        "SELECT d, variable, CASE WHEN xb IS NULL THEN xc WHEN xb <> 0 THEN (xb - xc) / xb ELSE 0 END AS v, xb AS b FROM fw WHERE xc IS NOT NULL")
def lift_top_decile(t):
    return shown(conjugate.lift(data.pairs(t)), "lift_top_decile")


@check("win_ntile", f"WITH {PRS}, {TILE} SELECT d AS information_date, side, count(*) FILTER (tile = 1) AS tile_rows, round(sum(target) FILTER (tile = 1), 6) + 0.0 AS tile_events FROM tl GROUP BY 1, 2")
def win_ntile(t):
    top = conjugate.top_tile(data.pairs(t))
    return top.select("information_date", "side", "tile_rows", r6("tile_events").alias("tile_events"))


@check("win_row_number_asc", f"WITH {NUM}, {GINI} SELECT d AS information_date, variable, side, count(*) AS n, round(sum(value * rk), 3) + 0.0 AS rank_sum FROM gr WHERE variable = 'score' GROUP BY 1, 2, 3")
def win_row_number_asc(t):
    from modelmon.functions.ordering import ordered_cross

    rows = data.numbers(t, "score").withColumns({"one": F.lit(1.0), "mass": F.col("value")})
    ranked = ordered_cross(rows, [*KEYS, "side"], "value", "one", "mass")
    rank_sum = F.col("cross") + F.col("total_right") / 2
    return ranked.select(
        "information_date", "variable", "side", F.col("total_left").cast("long").alias("n"), r6(rank_sum, 3).alias("rank_sum")
    )


KST = """kr AS (SELECT d, side, score, target, row_number() OVER (PARTITION BY d, side ORDER BY score) AS rn, count(*) OVER (PARTITION BY d, side) AS n FROM prs),
  kp AS (SELECT d, side, i, score AS p FROM kr, (SELECT unnest(range(0, 21)) AS i) WHERE rn = greatest((i * n + 19) // 20, 1)),
  kn AS (SELECT d, side, greatest(count(*) FILTER (target = 0), 1) AS n0, greatest(count(*) FILTER (target = 1), 1) AS n1 FROM prs GROUP BY 1, 2),
  kc AS (SELECT kp.d, kp.side, kp.i, count(*) FILTER (target = 0) AS c0, count(*) FILTER (target = 1) AS c1 FROM kp JOIN prs ON prs.d = kp.d AND prs.side = kp.side AND prs.score <= kp.p GROUP BY 1, 2, 3),
  f AS (SELECT d, side, greatest(1e-9, max(abs(c0 / n0 - c1 / n1))) AS x FROM kc JOIN kn USING (d, side) GROUP BY 1, 2),
  fw AS (SELECT d, '__SCORE__' AS variable, max(x) FILTER (side = 'current') AS xc, max(x) FILTER (side = 'baseline') AS xb FROM f GROUP BY 1)"""


@metric("ks_score_target", f"{PRS}, {KST}", "SELECT d, variable, CASE WHEN xb <> 0 THEN abs(xc - xb) / xb ELSE xc END AS v, xb AS b FROM fw WHERE xc IS NOT NULL")
def ks_score_target(t):
    return shown(conjugate.separation(data.pairs(t)), "ks_score_target")


# -- outcome ----------------------------------------------------------------------------


@metric("event_rate", f"""{TGT}, ev AS (SELECT d, variable, coalesce(avg(value) FILTER (side = 'current'), 0) AS mc, avg(value) FILTER (side = 'baseline') AS mb FROM tgt GROUP BY 1, 2)""",
        "SELECT d, variable, CASE WHEN mb IS NULL THEN mc WHEN mb <> 0 THEN abs(mc - mb) / mb WHEN mc > 0 THEN 1 ELSE 0 END AS v, mb AS b FROM ev")
def event_rate(t):
    return shown(quality.counts(data.targets(t)), "event_rate")


@metric("psi_target", f"""{TGT}, tb AS (SELECT d, variable, value, count(*) FILTER (side = 'current') AS c, count(*) FILTER (side = 'baseline') AS e FROM tgt GROUP BY 1, 2, 3 HAVING count(*) FILTER (side = 'current') > 0), {sizes_sql('tgt')}""",
        f"SELECT sz.d, sz.variable, coalesce(v, 0) AS v, 0.0 AS b FROM sz LEFT JOIN ({psi_sql('tb')}) USING (d, variable)")
def psi_target(t):
    return shown(target.target_psi(data.targets(t)), "psi_target")
