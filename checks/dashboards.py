"""Dashboard queries over the result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import data
from checks.catalog import check, r6
from checks.data import ALERTS, LOG, RES, STA
from checks.runs import AVAIL, MSV, SEM, availability
from modelmon.operators import dashboard as dash

BASE = f"{RES}, {LOG}, {ALERTS}"
LATEST = "lt AS (SELECT s.* FROM {src} s JOIN (SELECT model_id, max(information_date) AS information_date FROM {src} GROUP BY 1) USING (model_id, information_date))"


def view(t):
    return dash.model_summary_view(data.alerts(t), data.run_log(t))


@check("dash_models", f"WITH {RES} SELECT DISTINCT model_id FROM res ORDER BY 1")
def dash_models(t):
    return dash.models(view(t))


@check("dash_date_range", f"WITH {RES} SELECT min(information_date) AS min_date, max(information_date) AS max_date FROM res WHERE model_id = 'S3'")
def dash_date_range(t):
    return dash.date_range(view(t), "S3")


@check("dash_semaphore", f"WITH {BASE}, {SEM} SELECT information_date, model_id, var_type, metric_name, metric_value, status, aggregate_status, round(stress_ratio, 9) + 0.0::DOUBLE AS stress_ratio, coalesce(execution_status, '') AS execution_status, coalesce(variables_missing, -1) AS variables_missing FROM sem WHERE model_id = 'S5' AND information_date >= '1997-01-01' AND information_date <= '1999-12-01' ORDER BY 1")
def dash_semaphore(t):
    sem = dash.semaphore_view(data.results(t), data.alerts(t), data.run_log(t))
    return dash.by_date(sem, model_id="S5", start="1997-01-01", end="1999-12-01").withColumns({
        "stress_ratio": r6("stress_ratio", 9), "execution_status": F.coalesce("execution_status", F.lit("")),
        "variables_missing": F.coalesce("variables_missing", F.lit(-1)),
    })


@check("dash_summary", f"WITH {BASE}, {MSV} SELECT * FROM msv WHERE information_date >= '1996-06-01' ORDER BY information_date")
def dash_summary(t):
    return dash.by_date(view(t), start="1996-06-01")


@check("dash_scoring", f"WITH {RES} SELECT model_id, information_date, max(metric_value) FILTER (var_type IN ('raw', 'input') AND metric_name = 'psi_canonical') IS NOT NULL AS has_csi FROM res GROUP BY 1, 2 ORDER BY 1, 2")
def dash_scoring(t):
    from modelmon.operators.summary import scoring_summary

    none = t.spark.createDataFrame([], "model_id string, information_date string, done boolean")
    rows = dash.by_model(scoring_summary(data.results(t), data.statistics(t), none))
    return rows.select("model_id", "information_date", F.col("csi_max").isNotNull().alias("has_csi"))


@check("dash_availability", f"WITH {AVAIL} SELECT model_id, information_date, source_table, control FROM ava WHERE information_date <= '2000-01-01' ORDER BY 1, 2, 3")
def dash_availability(t):
    return dash.by_model(availability(t), "source_table", end="2000-01-01").select("model_id", "information_date", "source_table", "control")


@check("dash_metrics", f"WITH {RES} SELECT model_id, information_date, variable, metric_name, metric_value FROM res WHERE var_type IN ('raw', 'score') AND metric_name IN ('psi_canonical', 'entropy') ORDER BY information_date")
def dash_metrics(t):
    return dash.metric_rows(data.results(t), ["raw", "score"], ["psi_canonical", "entropy"]).select(
        "model_id", "information_date", "variable", "metric_name", "metric_value"
    )


@check("dash_var_summary", f"WITH {STA} SELECT * FROM sta WHERE var_type IN ('input', 'target') AND statistic IN ('p50', 'mean') ORDER BY information_date")
def dash_var_summary(t):
    return dash.statistic_rows(data.statistics(t), ["input", "target"], ["p50", "mean"])


PIVOT_METRICS = ["null_rate", "psi_canonical", "psi_dynamic", "entropy", "auc"]
PIVOT_STATS = ["p50", "mean", "max"]


def _pivot_sql(value: str, column: str, names: list[str], fill: str) -> str:
    return ", ".join(f"coalesce(min({value}) FILTER ({column} = '{n}'), {fill}) AS {n}" for n in names)


@check("semaphore_pivot", f"WITH {RES}, {LATEST.format(src='res')} SELECT model_id, var_type, variable, {_pivot_sql('status', 'metric_name', PIVOT_METRICS, repr(''))} FROM lt GROUP BY 1, 2, 3")
def semaphore_pivot(t):
    return dash.semaphore_pivot(data.results(t), PIVOT_METRICS).fillna("", PIVOT_METRICS)


@check("stat_pivot", f"WITH {STA}, {LATEST.format(src='sta')} SELECT model_id, var_type, variable, {_pivot_sql('statistic_value', 'statistic', PIVOT_STATS, '-1.0::DOUBLE')} FROM lt GROUP BY 1, 2, 3")
def stat_pivot(t):
    return dash.stat_pivot(data.statistics(t), PIVOT_STATS).fillna(-1.0, PIVOT_STATS)


WORD = "CASE status WHEN 'GREEN' THEN 'PASS' WHEN 'AMBAR' THEN 'WARNING' ELSE 'FAIL' END"


@check("status_trend", f"WITH {RES} SELECT model_id, information_date, {WORD} AS severity, count(*) AS count FROM res GROUP BY 1, 2, 3")
def status_trend(t):
    return dash.status_trend(data.results(t))


CANON = ", ".join(repr(m) for m in dash.CANONICAL_METRICS)


@check("noncanonical_metrics", f"WITH {RES} SELECT model_id, information_date, variable, metric_name, metric_value FROM res WHERE metric_name NOT IN ({CANON})")
def noncanonical_metrics(t):
    return dash.noncanonical_metrics(data.results(t)).select("model_id", "information_date", "variable", "metric_name", "metric_value")


CHECK = "CASE metric_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in dash.CHECKS.items()) + " END"
PRE = f'pre AS (SELECT *, {CHECK} AS "check", {WORD} AS result FROM res WHERE var_type IN (\'raw\', \'input\') AND metric_name IN (\'median_shift\', \'population_variation\', \'completeness\'))'


@check("prescoring_counts", f'WITH {RES}, {PRE} SELECT model_id, "check", result, count(*) AS count FROM pre GROUP BY 1, 2, 3')
def prescoring_counts(t):
    return dash.prescoring_counts(data.results(t))


@check("prescoring_latest", f'WITH {RES}, {PRE}, {LATEST.format(src="pre")} SELECT model_id, variable, "check", metric_value, coalesce(baseline_value, -1) AS baseline_value, result FROM lt')
def prescoring_latest(t):
    return dash.prescoring_latest(data.results(t)).fillna(-1.0, ["baseline_value"])


@check("availability_latest", f"WITH {AVAIL}, {LATEST.format(src='ava')} SELECT model_id, schema_name, source_table, scoring_date, deadline_data_ingestion, vintage, update_data_required, control FROM lt")
def availability_latest(t):
    return dash.availability_latest(availability(t))


@check("conjugate_latest", f"WITH {RES}, cj AS (SELECT * FROM res WHERE var_type = 'conjugate'), {LATEST.format(src='cj')} SELECT model_id, metric_name, metric_value, coalesce(baseline_value, -1) AS baseline_value, threshold_ambar::DOUBLE AS threshold_ambar, threshold_red::DOUBLE AS threshold_red, status FROM lt")
def conjugate_latest(t):
    return dash.conjugate_latest(data.results(t)).fillna(-1.0, ["baseline_value"])


@check("median_history", f"WITH {STA} SELECT * FROM sta WHERE var_type IN ('raw', 'input') AND statistic = 'p50'")
def median_history(t):
    return dash.median_history(data.statistics(t))


@check("percentile_latest", f"WITH {STA}, ps AS (SELECT * FROM sta WHERE var_type IN ('raw', 'input') AND statistic <> 'count_total'), {LATEST.format(src='ps')} SELECT * FROM lt")
def percentile_latest(t):
    return dash.percentile_latest(data.statistics(t))


def series(name, fn, types, metrics):
    kinds, names = ", ".join(map(repr, types)), ", ".join(map(repr, metrics))
    sql = f"WITH {RES} SELECT model_id, information_date, variable, metric_name, metric_value, status FROM res WHERE var_type IN ({kinds}) AND metric_name IN ({names})"

    @check(name, sql)
    def run(t):
        return fn(data.results(t)).select("model_id", "information_date", "variable", "metric_name", "metric_value", "status")


series("raw_source_trend", dash.raw_source_trend, ["raw", "input"], ["population_variation", "completeness", "null_rate"])
series("score_trend", dash.score_trend, ["score"], ["entropy", "approval_rate", "concentration_gini", "population_variation", "range_violation"])
series("csi_series", dash.csi_series, ["raw", "input"], ["psi_canonical"])
series("psi_series", dash.psi_series, ["score"], ["psi_canonical", "psi_dynamic"])
