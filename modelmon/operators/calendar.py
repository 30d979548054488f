"""Business-day calendar operators.

A calendar is a DataFrame (``calendar_date`` date, ``is_business_day`` boolean): one row per day,
some 40,000 rows for a century, so it is the one thing here that may sit in a single window.
Operators take a frame of reference dates and add columns; every date is answered at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from modelmon.functions.columns import union_all
from modelmon.functions.dates import period_end, period_of, period_start, run_day, shift_periods


def weekday_calendar(days: DataFrame, holidays: list[str] | None = None) -> DataFrame:
    """Calendar over [first_day, last_day] of a one-row frame; Saturday and Sunday are closed."""
    day = days.select(F.explode(F.sequence("first_day", "last_day")).alias("calendar_date"))
    holiday = F.date_format("calendar_date", "MM-dd").isin(holidays or [])
    return day.select(
        "calendar_date",
        ((F.weekday("calendar_date") < 5) & ~holiday).alias("is_business_day"),
        holiday.alias("is_holiday"),
    )


def _business(calendar: DataFrame) -> DataFrame:
    return calendar.where("is_business_day").select(F.col("calendar_date").alias("business_day"))


def is_business_day(dates: DataFrame, calendar: DataFrame, column: str = "date") -> DataFrame:
    """Flag per date. A date the calendar does not know counts as a business day."""
    flags = calendar.select(F.col("calendar_date").alias(column), F.col("is_business_day").alias("_flag"))
    return dates.join(flags, column, "left").withColumn(
        "is_business_day", F.coalesce("_flag", F.lit(True))
    ).drop("_flag")


def _distinct(dates: DataFrame, column: str) -> DataFrame:
    return dates.select(F.col(column).alias("_d")).where(F.col("_d").isNotNull()).distinct()


def _spread(dates: DataFrame, calendar: DataFrame, column: str) -> DataFrame:
    """Calendar days merged with the asked dates, so that each asked date meets its neighbours."""
    days = calendar.select(
        F.col("calendar_date").alias("_d"), F.when(F.col("is_business_day"), F.col("calendar_date")).alias("_open")
    )
    asked = _distinct(dates, column).select("_d", F.lit(None).cast("date").alias("_open"))
    return days.unionByName(asked).groupBy("_d").agg(F.max("_open").alias("_open"))


def next_business_day(dates: DataFrame, calendar: DataFrame, column: str = "date") -> DataFrame:
    """First business day after each date; null past the end of the calendar."""
    window = W.orderBy("_d").rowsBetween(1, W.unboundedFollowing)
    found = _spread(dates, calendar, column).select(
        F.col("_d").alias(column), F.min("_open").over(window).alias("next_business_day")
    )
    return dates.join(found, column, "left")


def business_day_on_or_after(dates: DataFrame, calendar: DataFrame, column: str = "date", name: str = "on_or_after") -> DataFrame:
    """First business day from each date on; the date itself past the end of the calendar."""
    window = W.orderBy("_d").rowsBetween(0, W.unboundedFollowing)
    found = _spread(dates, calendar, column).select(
        F.col("_d").alias(column), F.coalesce(F.min("_open").over(window), F.col("_d")).alias(name)
    )
    return dates.join(found, column, "left")


def previous_business_days(dates: DataFrame, calendar: DataFrame, n: int = 1, column: str = "date") -> DataFrame:
    """The last n business days up to each date, newest first (``position`` from 1)."""
    window = W.orderBy("_d").rowsBetween(W.unboundedPreceding, 0)
    recent = _spread(dates, calendar, column).withColumn("_seen", F.count("_open").over(window))
    numbered = recent.where(F.col("_open").isNotNull()).select(F.col("_open").alias("business_day"), F.col("_seen").alias("_rank"))
    wanted = (
        dates.join(recent.select(F.col("_d").alias(column), "_seen"), column)
        .withColumn("position", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("_rank", F.col("_seen") - F.col("position") + 1)
    )
    return wanted.join(numbered, "_rank").drop("_rank", "_seen")


def with_period(dates: DataFrame, column: str = "date", period: Column | str = "month") -> DataFrame:
    """Start and end of the day, ISO week or calendar month around each date."""
    return dates.withColumns(
        {"period_start": period_start(F.col(column), period), "period_end": period_end(F.col(column), period)}
    )


def days_of_period(dates: DataFrame, column: str = "date", period: Column | str = "month") -> DataFrame:
    return with_period(dates, column, period).withColumn("day", F.explode(F.sequence("period_start", "period_end")))


def business_days_of_period(dates: DataFrame, calendar: DataFrame, column: str = "date", period: Column | str = "month") -> DataFrame:
    days = days_of_period(dates, column, period)
    return days.join(_business(calendar).withColumnRenamed("business_day", "day"), "day", "left_semi")


def period_business_bounds(dates: DataFrame, calendar: DataFrame, column: str = "date", period: Column | str = "month") -> DataFrame:
    """First and last business day of each date's period; the date itself where it has none."""
    known = with_period(dates, column, period)
    asked = known.select("period_start", "period_end").distinct()
    spans = asked.select("*", F.explode(F.sequence("period_start", "period_end")).alias("business_day"))
    found = (
        spans.join(_business(calendar), "business_day")
        .groupBy("period_start", "period_end")
        .agg(F.min("business_day").alias("_first"), F.max("business_day").alias("_last"))
    )
    return (
        known.join(found, ["period_start", "period_end"], "left")
        .withColumns(
            {
                "first_business_day": F.coalesce("_first", F.col(column)),
                "last_business_day": F.coalesce("_last", F.col(column)),
            }
        )
        .drop("_first", "_last")
    )


def expected_information_date(models: DataFrame, calendar: DataFrame, column: str = "date") -> DataFrame:
    """Load date each model is expected to have for a reference date.

    Daily frequencies: the date. Weekly or monthly with a run day: that day, moved on to a
    business day. Without a run day: the last business day of the period.
    """
    frequency = F.col("frequency")
    has_day = ((frequency == "weekly") & F.col("execution_weekday").isNotNull()) | (
        (frequency == "monthly") & F.col("execution_monthly_day").isNotNull()
    )
    planned = models.withColumn(
        "_run", run_day(F.col(column), frequency, F.col("execution_monthly_day"), F.col("execution_weekday"))
    ).withColumn("_period", period_of(frequency))
    moved = business_day_on_or_after(planned, calendar, "_run", "_moved")
    bounded = period_business_bounds(moved, calendar, column, F.col("_period"))
    return bounded.withColumn(
        "expected_date",
        F.when(has_day, F.col("_moved"))
        .when(frequency.isin("weekly", "monthly"), F.col("last_business_day"))
        .otherwise(F.col(column)),
    ).drop("_run", "_moved", "_period", "period_start", "period_end", "first_business_day", "last_business_day")


def period_dates(refs: DataFrame, calendar: DataFrame, present: DataFrame | None = None, column: str = "ref_date") -> DataFrame:
    """Dates to read for each reference: adds ``read_date``, one row per date.

    ``refs`` carries ``reading_mode, frequency, use_business_days``; partition modes also need
    ``present`` (source_table, date). A reference without a date to read gives no row.
    """
    mode, business = F.col("reading_mode"), F.col("use_business_days")
    staged = refs.withColumn("_period", period_of(F.col("frequency")))
    bounds = period_business_bounds(staged, calendar, column, F.col("_period"))
    picked = F.when(mode == "first", F.when(business, F.col("first_business_day")).otherwise(F.col("period_start")))
    picked = picked.when(mode == "last", F.when(business, F.col("last_business_day")).otherwise(F.col("period_end")))
    scanned = mode.isin("each", "first_partition", "last_partition")
    simple = bounds.where(~scanned).withColumn("read_date", picked.otherwise(F.col(column)))
    days = bounds.where(scanned).withColumn("read_date", F.explode(F.sequence("period_start", "period_end")))
    open_days = _business(calendar).select(F.col("business_day").alias("read_date"), F.lit(True).alias("_open"))
    days = days.join(open_days, "read_date", "left").where(~business | F.col("_open")).drop("_open")
    each = days.where(mode == "each")
    frames = [simple, each.select(*simple.columns)]
    if present is not None:
        held = present.select("source_table", F.col("date").alias("read_date")).distinct()
        found = days.where(mode != "each").join(held, ["source_table", "read_date"], "left_semi")
        ends = found.groupBy(*refs.columns).agg(F.min("read_date").alias("_a"), F.max("read_date").alias("_b"))
        chosen = ends.withColumn("read_date", F.when(mode == "first_partition", F.col("_a")).otherwise(F.col("_b")))
        frames = [f.select(*refs.columns, "read_date") for f in frames] + [chosen.select(*refs.columns, "read_date")]
    return union_all([f.select(*refs.columns, "read_date") for f in frames])


def resolve_dates(runs: DataFrame, calendar: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """Current and baseline dates to read, per run and source.

    ``runs`` carries ``information_date`` (date), ``frequency, lag, reading_mode,
    use_business_days, source_table``. The current reference lies ``lag`` periods back, the
    baseline one period before that. Adds ``side, ref_date, read_date``.
    """
    frequency = F.col("frequency")
    current = shift_periods(F.col("information_date"), frequency, F.coalesce(F.col("lag"), F.lit(0)))
    sides = F.array(
        F.struct(F.lit("current").alias("side"), current.alias("ref_date")),
        F.struct(F.lit("baseline").alias("side"), shift_periods(current, frequency, 1).alias("ref_date")),
    )
    refs = runs.select("*", F.explode(sides).alias("_s")).select(*runs.columns, "_s.side", "_s.ref_date")
    return period_dates(refs, calendar, present)


def history_dates(refs: DataFrame, column: str = "ref_date") -> DataFrame:
    """Training history: one monthly date per month of history, ending ``lag`` months back.

    Each step moves on from the step before it, so a clamped day stays clamped.
    """
    end = F.add_months(F.col(column), -F.coalesce(F.col("lag"), F.lit(0)))
    months = F.greatest(F.coalesce(F.col("history_months"), F.lit(1)), F.lit(1))
    start = F.add_months(end, -(months - 1))
    steps = F.sequence(F.lit(0), months - 1)

    def walk(path: Column, _i: Column) -> Column:
        return F.concat(path, F.array(F.add_months(F.element_at(path, -1), 1)))

    path = F.aggregate(F.slice(steps, F.lit(1), months - 1), F.array(start), walk)
    return refs.withColumn("_end", end).withColumn("history_date", F.explode(path)).where(
        F.col("history_date") <= F.col("_end")
    ).drop("_end")


def calendar_ready(calendar: DataFrame, years: DataFrame) -> DataFrame:
    """Per year: enough calendar rows for every day of it? ``years`` holds ``year`` (int)."""
    held = calendar.groupBy(F.year("calendar_date").alias("year")).agg(F.count("*").alias("n_days"))
    first = F.make_date(F.col("year"), F.lit(1), F.lit(1))
    needed = F.datediff(F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)), first)
    return years.join(held, "year", "left").select(
        "year",
        F.coalesce("n_days", F.lit(0)).alias("n_days"),
        needed.alias("expected_days"),
        (F.coalesce("n_days", F.lit(0)) >= needed).alias("ready"),
    )
