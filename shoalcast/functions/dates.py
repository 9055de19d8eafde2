"""Calendar functions (F3-F5, F7, F9-F14, P11).  The session time zone is UTC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalcast.schemas import LOCAL_TZ


def parse_timestamp(col: Column) -> Column:
    return col.try_cast("timestamp")


def local_date(ts: Column, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), tz))


def parse_date(col: Column) -> Column:
    """Year-month-day text to DATE."""
    return F.to_date(F.try_to_timestamp(F.regexp_replace(F.substring(F.trim(col), 1, 10), "[/. ]", "-"), F.lit("y-M-d")))


def two_format_date(col: Column) -> Column:
    """Text ending in a slash and two digits is month/day/year, else day/month/year.

    Two-digit years 69-99 belong to the last century.
    """
    slashed = F.regexp_replace(F.trim(col), r"[-. ]", "/")
    month_first = F.to_date(F.try_to_timestamp(slashed, F.lit("M/d/yy")))
    month_first = F.when(F.year(month_first) >= 2069, F.add_months(month_first, -1200)).otherwise(month_first)
    day_first = F.coalesce(
        F.to_date(F.try_to_timestamp(slashed, F.lit("d/M/yyyy"))), F.to_date(F.try_to_timestamp(slashed, F.lit("d/M/yy")))
    )
    return F.when(col.rlike(r"/[0-9]{2}$"), month_first).when(~col.rlike(r"/[0-9]{2}$"), day_first)


def floor_week(date: Column) -> Column:
    """Sunday on or before the day."""
    return F.date_sub(F.next_day(date, "SUN"), 7)


def floor_period(date: Column, unit: str) -> Column:
    if unit == "week":
        return floor_week(date)
    if unit in ("month", "year"):
        return F.trunc(date, unit)
    if unit == "day":
        return date
    raise ValueError(f"unknown period unit: {unit}")


def week_number(date: Column) -> Column:
    """Complete seven-day blocks since 1 January, plus one (not the ISO week)."""
    return F.floor((F.dayofyear(date) - 1) / 7).cast("int") + 1


def month_number(date: Column) -> Column:
    return F.month(date)


def weekday_label(date: Column) -> Column:
    return F.date_format(date, "E")


def days_in_month(date: Column) -> Column:
    return F.day(F.last_day(date))


def month_sequence(first: str, last: str) -> Column:
    """Array of month starts between two ISO dates."""
    return F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))


def period_features(
    df: DataFrame, date_col: str, unit: str = "month", seasonal: Callable[[Column], Column] = month_number
) -> DataFrame:
    """``period_static``, ``period_seasonal`` (text) and ``wday`` of a date column."""
    date = F.col(date_col)
    return df.withColumns(
        {
            "period_static": floor_period(date, unit),
            "period_seasonal": seasonal(date).cast("string"),
            "wday": weekday_label(date),
        }
    )
