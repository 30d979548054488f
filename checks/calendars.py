"""Calendar and period operators over the order and shipping dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import data
from checks.catalog import Tables, check, iso
from checks.data import CAL, SHIP
from modelmon.functions.columns import union_all
from modelmon.functions.dates import run_day, shift_months, shift_periods
from modelmon.operators import calendar as cal
from modelmon.operators import runs
from modelmon.plans.training import dev_dates

ISO = "strftime({}, '%Y-%m-%d')"


@check("is_business_day", f"WITH {CAL}, {SHIP} SELECT {ISO.format('date')} AS date, coalesce(biz, true) AS is_business_day FROM ship LEFT JOIN cal ON date = calendar_date")
def is_business_day(t):
    return cal.is_business_day(data.ship_dates(t), data.calendar(t)).select(iso("date").alias("date"), "is_business_day")


@check("next_business_day", f"WITH {CAL}, {SHIP} SELECT {ISO.format('date')} AS date, coalesce({ISO.format('(SELECT min(calendar_date) FROM cal WHERE biz AND calendar_date > date)')}, '') AS next_day FROM ship")
def next_business_day(t):
    found = cal.next_business_day(data.ship_dates(t), data.calendar(t))
    return found.select(iso("date").alias("date"), F.coalesce(iso("next_business_day"), F.lit("")).alias("next_day"))


@check("business_day_on_or_after", f"WITH {CAL}, {SHIP} SELECT {ISO.format('date')} AS date, {ISO.format('coalesce((SELECT min(calendar_date) FROM cal WHERE biz AND calendar_date >= date), date)')} AS day FROM ship")
def business_day_on_or_after(t):
    found = cal.business_day_on_or_after(data.ship_dates(t), data.calendar(t))
    return found.select(iso("date").alias("date"), iso("on_or_after").alias("day"))


@check("previous_business_days", f"""WITH {CAL}, {SHIP}, p AS (SELECT date, calendar_date, row_number() OVER (PARTITION BY date ORDER BY calendar_date DESC) AS position FROM ship JOIN cal
  ON biz AND calendar_date <= date AND calendar_date > date - INTERVAL 200 DAY) SELECT {ISO.format('date')} AS date, position, {ISO.format('calendar_date')} AS business_day FROM p WHERE position <= 3""")
def previous_business_days(t):
    found = cal.previous_business_days(data.ship_dates(t), data.calendar(t), 3)
    return found.select(iso("date").alias("date"), "position", iso("business_day").alias("business_day"))


PERIODS = "periods AS (SELECT unnest(['month', 'week', 'day']) AS period), pd AS (SELECT date, period, CASE period WHEN 'month' THEN date_trunc('month', date) WHEN 'week' THEN date_trunc('week', date) ELSE date END::DATE AS a, CASE period WHEN 'month' THEN last_day(date) WHEN 'week' THEN date_trunc('week', date) + INTERVAL 6 DAY ELSE date END::DATE AS b FROM ship, periods)"


def _periods(t: Tables):
    return data.ship_dates(t).withColumn("period", F.explode(F.array(F.lit("month"), F.lit("week"), F.lit("day"))))


@check("period_bounds", f"WITH {SHIP}, {PERIODS} SELECT {ISO.format('date')} AS date, period, {ISO.format('a')} AS first_day, {ISO.format('b')} AS last_day FROM pd")
def period_bounds(t):
    found = cal.with_period(_periods(t), "date", F.col("period"))
    return found.select(iso("date").alias("date"), "period", iso("period_start").alias("first_day"), iso("period_end").alias("last_day"))


@check("first_last_business_day", f"""WITH {CAL}, {SHIP}, {PERIODS} SELECT {ISO.format('date')} AS date, period, {ISO.format('coalesce(min(calendar_date), date)')} AS first_day, {ISO.format('coalesce(max(calendar_date), date)')} AS last_day
  FROM pd LEFT JOIN cal ON biz AND calendar_date BETWEEN a AND b GROUP BY date, period""")
def first_last_business_day(t):
    found = cal.period_business_bounds(_periods(t), data.calendar(t), "date", F.col("period"))
    return found.select(iso("date").alias("date"), "period", iso("first_business_day").alias("first_day"), iso("last_business_day").alias("last_day"))


@check("days_of_period", f"WITH {SHIP}, {PERIODS} SELECT {ISO.format('date')} AS date, period, strftime(unnest(generate_series(a, b, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM pd WHERE period = 'week'")
def days_of_period(t):
    found = cal.days_of_period(data.ship_dates(t), "date", "week")
    return found.select(iso("date").alias("date"), F.lit("week").alias("period"), iso("day").alias("day"))


@check("business_days_of_period", f"WITH {CAL}, {SHIP}, {PERIODS} SELECT {ISO.format('date')} AS date, {ISO.format('calendar_date')} AS day FROM pd JOIN cal ON biz AND calendar_date BETWEEN a AND b WHERE period = 'month'")
def business_days_of_period(t):
    found = cal.business_days_of_period(data.ship_dates(t), data.calendar(t), "date", "month")
    return found.select(iso("date").alias("date"), iso("day").alias("day"))


@check("shift_months", f"WITH {SHIP}, k AS (SELECT unnest([-13, -1, 1, 18]) AS months) SELECT {ISO.format('date')} AS date, months, strftime(date + to_months(months), '%Y-%m-%d') AS shifted FROM ship, k")
def shift(t):
    rows = data.ship_dates(t).withColumn("months", F.explode(F.array(*[F.lit(x) for x in (-13, -1, 1, 18)])))
    return rows.select(iso("date").alias("date"), "months", iso(shift_months(F.col("date"), F.col("months"))).alias("shifted"))


def fleet(t: Tables):
    """A model of every frequency and run-day setting, for each shipping date."""
    kinds = [("daily", None, None), ("business_daily", None, None), ("weekly", None, 2), ("weekly", None, None), ("monthly", 31, None), ("monthly", 14, None), ("monthly", None, None)]
    rows = [(f"M{i}", f, d, w) for i, (f, d, w) in enumerate(kinds)]
    models = t.spark.createDataFrame(rows, "model_id string, frequency string, execution_monthly_day int, execution_weekday int")
    dates = data.ship_dates(t).withColumn("_k", F.lit(1))
    return dates.join(F.broadcast(models.withColumn("_k", F.lit(1))), "_k").drop("_k")


FLEET = """fleet AS (SELECT * FROM ship, (VALUES ('M0', 'daily', NULL, NULL), ('M1', 'business_daily', NULL, NULL), ('M2', 'weekly', NULL, 2), ('M3', 'weekly', NULL, NULL),
  ('M4', 'monthly', 31, NULL), ('M5', 'monthly', 14, NULL), ('M6', 'monthly', NULL, NULL)) AS f(model_id, frequency, mday, wday)),
  planned AS (SELECT *, CASE WHEN frequency = 'monthly' AND mday IS NOT NULL THEN date_trunc('month', date)::DATE + (least(mday, day(last_day(date))) - 1)::INTEGER
  WHEN frequency = 'weekly' AND wday IS NOT NULL THEN date_trunc('week', date)::DATE + wday::INTEGER ELSE date END::DATE AS run FROM fleet)"""
EXPECTED = """expd AS (SELECT model_id, frequency, date, CASE WHEN frequency IN ('daily', 'business_daily') THEN date
  WHEN mday IS NOT NULL OR wday IS NOT NULL THEN coalesce((SELECT min(calendar_date) FROM cal WHERE biz AND calendar_date >= run), run)
  WHEN frequency = 'weekly' THEN coalesce((SELECT max(calendar_date) FROM cal WHERE biz AND calendar_date BETWEEN date_trunc('week', date) AND date_trunc('week', date) + INTERVAL 6 DAY), date)
  ELSE coalesce((SELECT max(calendar_date) FROM cal WHERE biz AND calendar_date BETWEEN date_trunc('month', date) AND last_day(date)), date) END::DATE AS expected FROM planned)"""


@check("reference_date", f"WITH {SHIP}, {FLEET} SELECT model_id, {ISO.format('date')} AS date, {ISO.format('run')} AS run_date FROM planned")
def reference_date(t):
    day = run_day(F.col("date"), F.col("frequency"), F.col("execution_monthly_day"), F.col("execution_weekday"))
    return fleet(t).select("model_id", iso("date").alias("date"), iso(day).alias("run_date"))


@check("expected_information_date", f"WITH {CAL}, {SHIP}, {FLEET}, {EXPECTED} SELECT model_id, {ISO.format('date')} AS date, {ISO.format('expected')} AS expected_date FROM expd")
def expected_information_date(t):
    found = cal.expected_information_date(fleet(t), data.calendar(t))
    return found.select("model_id", iso("date").alias("date"), iso("expected_date").alias("expected_date"))


DUE = """due AS (SELECT model_id, strftime(expected, '%Y-%m-%d') AS information_date, date FROM expd LEFT JOIN cal ON calendar_date = date
  WHERE NOT (frequency = 'business_daily' AND NOT coalesce(biz, true)) AND NOT (frequency IN ('weekly', 'monthly') AND expected <> date))"""
DAYLOG = "dlog AS (SELECT DISTINCT 'M' || (o_custkey % 7) AS model_id, strftime(o_orderdate, '%Y-%m-%d') AS information_date FROM orders WHERE o_orderstatus = 'F')"


def day_log(t: Tables):
    return t.orders.select(
        F.concat(F.lit("M"), F.col("o_custkey") % 7).alias("model_id"), iso("o_orderdate").alias("information_date"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
    )


@check("eligible_models", f"WITH {CAL}, {SHIP}, {FLEET}, {EXPECTED}, {DUE}, {DAYLOG} SELECT model_id, information_date FROM due WHERE (model_id, information_date) NOT IN (SELECT model_id, information_date FROM dlog)")
def eligible_models(t):
    return runs.due_runs(fleet(t), data.calendar(t), day_log(t)).select("model_id", "information_date")


@check("backfill", f"""WITH {CAL}, ship AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM span), {FLEET}, {EXPECTED}, {DUE}, {DAYLOG}
  SELECT DISTINCT model_id, information_date FROM due WHERE (model_id, information_date) NOT IN (SELECT model_id, information_date FROM dlog)""")
def backfill(t):
    models = fleet(t).drop("date").distinct()
    span = t.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    spanned = models.withColumn("_k", F.lit(1)).join(span.withColumn("_k", F.lit(1)), "_k")
    return runs.candidate_dates(spanned, data.calendar(t), F.col("a"), F.col("b"), day_log(t))


@check("period_reference", f"""WITH {SHIP}, {FLEET} SELECT model_id, {ISO.format('date')} AS date, strftime(CASE frequency WHEN 'monthly' THEN date - INTERVAL 2 MONTH WHEN 'weekly' THEN date - INTERVAL 14 DAY ELSE date - INTERVAL 2 DAY END, '%Y-%m-%d') AS ref_date FROM fleet""")
def period_reference(t):
    return fleet(t).select("model_id", iso("date").alias("date"), iso(shift_periods(F.col("date"), F.col("frequency"), 2)).alias("ref_date"))


MODES = ["first", "last", "each", "first_partition", "last_partition", "other"]


def readers(t: Tables):
    """Every reading mode, with and without business days, for each month of orders."""
    months = t.orders.select(F.trunc("o_orderdate", "month").alias("information_date")).distinct()
    frames = [
        months.withColumns({
            "model_id": F.lit(f"{mode}-{business}"), "source_table": F.lit("orders"), "frequency": F.lit("monthly"), "lag": F.lit(1),
            "reading_mode": F.lit(mode), "use_business_days": F.lit(business), "history_months": F.lit(3),
        })
        for mode in MODES for business in (True, False)
    ]
    return union_all(frames)


def held_dates(t: Tables):
    return t.orders.where("o_orderpriority = '1-URGENT'").select(F.lit("orders").alias("source_table"), F.col("o_orderdate").cast("date").alias("date")).distinct()


READERS = """mo AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS ref FROM orders), md AS (SELECT unnest(['first', 'last', 'each', 'first_partition', 'last_partition', 'other']) AS mode),
  bz AS (SELECT unnest([true, false]) AS ub), held AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS hd FROM orders WHERE o_orderpriority = '1-URGENT')"""


def _read_sql(refs: str) -> str:
    """Dates to read for (ref, mode, ub, ...) rows of ``refs``."""
    return f"""SELECT r.*, unnest(CASE mode
      WHEN 'first' THEN [CASE WHEN ub THEN coalesce((SELECT min(calendar_date) FROM cal WHERE biz AND date_trunc('month', calendar_date) = date_trunc('month', r.ref)), r.ref) ELSE date_trunc('month', r.ref)::DATE END]
      WHEN 'last' THEN [CASE WHEN ub THEN coalesce((SELECT max(calendar_date) FROM cal WHERE biz AND date_trunc('month', calendar_date) = date_trunc('month', r.ref)), r.ref) ELSE last_day(r.ref) END]
      WHEN 'each' THEN CASE WHEN ub THEN (SELECT list(calendar_date) FROM cal WHERE biz AND date_trunc('month', calendar_date) = date_trunc('month', r.ref))
        ELSE [CAST(x AS DATE) FOR x IN generate_series(date_trunc('month', r.ref)::DATE, last_day(r.ref), INTERVAL 1 DAY)] END
      WHEN 'first_partition' THEN (SELECT CASE WHEN min(hd) IS NULL THEN [] ELSE [min(hd)] END FROM held LEFT JOIN cal ON hd = calendar_date WHERE date_trunc('month', hd) = date_trunc('month', r.ref) AND (NOT r.ub OR biz))
      WHEN 'last_partition' THEN (SELECT CASE WHEN max(hd) IS NULL THEN [] ELSE [max(hd)] END FROM held LEFT JOIN cal ON hd = calendar_date WHERE date_trunc('month', hd) = date_trunc('month', r.ref) AND (NOT r.ub OR biz))
      ELSE [r.ref] END) AS read_date FROM {refs} r"""


NAME = "mode || '-' || CASE WHEN ub THEN 'True' ELSE 'False' END"


@check("period_dates", f"WITH {CAL}, {READERS}, refs AS (SELECT ref, mode, ub FROM mo, md, bz), rd AS ({_read_sql('refs')}) SELECT {NAME} AS model_id, {ISO.format('ref')} AS ref_date, {ISO.format('read_date')} AS read_date FROM rd")
def period_dates(t):
    refs = readers(t).withColumnRenamed("information_date", "ref_date")
    return cal.period_dates(refs, data.calendar(t), held_dates(t)).select("model_id", iso("ref_date").alias("ref_date"), iso("read_date").alias("read_date"))


@check("resolve_dates", f"""WITH {CAL}, {READERS}, refs AS (SELECT mo.ref AS info, CAST(mo.ref - INTERVAL 1 MONTH * k AS DATE) AS ref, CASE k WHEN 1 THEN 'current' ELSE 'baseline' END AS side, mode, ub FROM mo, md, bz, (SELECT unnest([1, 2]) AS k)),
  rd AS ({_read_sql('refs')}) SELECT {NAME} AS model_id, {ISO.format('info')} AS information_date, side, {ISO.format('read_date')} AS read_date FROM rd""")
def resolve_dates(t):
    found = cal.resolve_dates(readers(t), data.calendar(t), held_dates(t))
    return found.select("model_id", iso("information_date").alias("information_date"), "side", iso("read_date").alias("read_date"))


@check("history_range", """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS ref, CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS e FROM orders), s AS (SELECT ref, e, CAST(e - INTERVAL 2 MONTH AS DATE) AS a FROM d),
  w AS (SELECT ref, e, a, CAST(a + INTERVAL 1 MONTH AS DATE) AS b FROM s) SELECT strftime(ref, '%Y-%m-%d') AS ref_date, strftime(h, '%Y-%m-%d') AS history_date
  FROM (SELECT ref, e, unnest([a, b, CAST(b + INTERVAL 1 MONTH AS DATE)]) AS h FROM w) WHERE h <= e""")
def history_range(t):
    refs = t.orders.select(F.col("o_orderdate").cast("date").alias("ref_date")).distinct().withColumns({"lag": F.lit(1), "history_months": F.lit(3)})
    return cal.history_dates(refs).select(iso("ref_date").alias("ref_date"), iso("history_date").alias("history_date"))


@check("dev_dates", f"""WITH {CAL}, {READERS}, refs AS (SELECT mo.ref AS base, CAST(mo.ref - INTERVAL 1 MONTH * k AS DATE) AS ref, CASE WHEN mode IN ('first', 'last') THEN 'as_is' ELSE mode END AS mode, mode AS m0, ub FROM mo, md, bz, (SELECT unnest([1, 2, 3]) AS k)),
  rd AS ({_read_sql('refs')}) SELECT m0 || '-' || CASE WHEN ub THEN 'True' ELSE 'False' END AS model_id, {ISO.format('base')} AS ref_date, {ISO.format('read_date')} AS read_date FROM rd""")
def development_dates(t):
    refs = readers(t).withColumnRenamed("information_date", "ref_date")
    found = dev_dates(refs, data.calendar(t), held_dates(t))
    return found.select("model_id", iso("ref_date").alias("ref_date"), iso("read_date").alias("read_date"))


@check("calendar_ready", f"""WITH {CAL}, y AS (SELECT DISTINCT year(l_shipdate) AS year FROM lineitem), c AS (SELECT year(calendar_date) AS year, count(*) AS n FROM cal GROUP BY 1)
  SELECT year, coalesce(n, 0) AS n_days, CASE WHEN year % 4 = 0 THEN 366 ELSE 365 END AS expected_days, coalesce(n, 0) >= CASE WHEN year % 4 = 0 THEN 366 ELSE 365 END AS ready FROM y LEFT JOIN c USING (year)""")
def calendar_ready(t):
    years = t.lineitem.select(F.year("l_shipdate").alias("year")).distinct()
    return cal.calendar_ready(data.calendar(t), years)


