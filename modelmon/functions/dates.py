"""Date patterns and period arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Strptime directives a source may declare, and Spark's own letters.
DIRECTIVES = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}


def date_pattern(pattern: str | None) -> str | None:
    """Spark datetime pattern for a strptime-style pattern ('%Y%m' -> 'yyyyMM')."""
    if not pattern:
        return None
    out, literal, i = [], "", 0

    def flush() -> None:
        nonlocal literal
        if literal:
            out.append("'" + literal.replace("'", "''") + "'" if literal.isalpha() else literal)
            literal = ""

    while i < len(pattern):
        pair = pattern[i : i + 2]
        if pair in DIRECTIVES:
            flush()
            out.append(DIRECTIVES[pair])
            i += 2
        elif pattern[i] == "%":
            raise ValueError(f"unsupported date directive {pair!r} in {pattern!r}")
        else:
            literal += pattern[i]
            i += 1
    flush()
    return "".join(out)


def parse_date(column: Column, pattern: str | None = None) -> Column:
    """Source value -> date; null where the text does not parse.

    Without a pattern the first ten characters are read as an ISO date. Two-digit years mean
    1969 to 2068.
    """
    text = column.cast("string")
    if pattern:
        parsed = F.try_to_timestamp(text, F.lit(date_pattern(pattern))).cast("date")
        if "%y" in pattern:
            parsed = F.when(F.year(parsed) > 2068, F.add_months(parsed, -1200)).otherwise(parsed)
        return parsed
    return F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def format_date(column: Column, pattern: str | None = None) -> Column:
    """Date -> the text a source stores for it (ISO when no pattern is set)."""
    return F.date_format(column, date_pattern(pattern) or "yyyy-MM-dd")


def period_of(frequency: Column) -> Column:
    """Reading period that belongs to a model's frequency."""
    return F.when(frequency == "monthly", "month").when(frequency == "weekly", "week").otherwise("day")


def period_start(date: Column, period: Column | str) -> Column:
    period = F.lit(period) if isinstance(period, str) else period
    return (
        F.when(period == "month", F.trunc(date, "month"))
        .when(period == "week", F.date_trunc("week", date).cast("date"))
        .otherwise(date.cast("date"))
    )


def period_end(date: Column, period: Column | str) -> Column:
    period = F.lit(period) if isinstance(period, str) else period
    return (
        F.when(period == "month", F.last_day(date))
        .when(period == "week", F.date_add(F.date_trunc("week", date).cast("date"), 6))
        .otherwise(date.cast("date"))
    )


def shift_months(date: Column, months: Column | int) -> Column:
    """Move by whole months, clamping the day to the month's length."""
    return F.add_months(date.cast("date"), months)


def shift_periods(date: Column, frequency: Column, periods: Column | int) -> Column:
    """Move back by ``periods`` units of the model's frequency."""
    periods = F.lit(periods) if isinstance(periods, int) else periods
    return (
        F.when(frequency == "monthly", F.add_months(date, -periods))
        .when(frequency == "weekly", F.date_sub(date, 7 * periods))
        .otherwise(F.date_sub(date, periods))
    )


def run_day(date: Column, frequency: Column, month_day: Column, weekday: Column) -> Column:
    """Calendar run date in the period of ``date``.

    Monthly: the configured day, clamped to the month. Weekly: the configured weekday
    (0 = Monday) of the same ISO week. Otherwise the date itself.
    """
    first = F.trunc(date, "month")
    day = F.least(F.greatest(month_day, F.lit(1)), F.dayofmonth(F.last_day(date)))
    monday = F.date_trunc("week", date).cast("date")
    return (
        F.when((frequency == "monthly") & month_day.isNotNull(), F.date_add(first, day - 1))
        .when((frequency == "weekly") & weekday.isNotNull(), F.date_add(monday, weekday))
        .otherwise(date.cast("date"))
    )
