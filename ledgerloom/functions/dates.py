"""Date expressions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

# Fixed values of the mission calendar: sol 4102 fell on 2024-02-19 and one sol
# lasts 1.0274912517 earth days.
ANCHOR_SOL = 4102
ANCHOR_DATE = datetime.date(2024, 2, 19)
EARTH_DAYS_PER_SOL = 1.0274912517


def month_start(year: Column, month: Column) -> Column:
    """First day of a month given as year and month numbers."""
    return F.make_date(year, month, F.lit(1))


def month_day_name(day: Column) -> Column:
    """``January 5`` for a date or timestamp."""
    return F.date_format(day, "MMMM d")


def page_name(month_day: Column) -> Column:
    """``January 5`` to ``January_5``."""
    return F.translate(month_day, " ", "_")


def month_day_of_page(name: Column) -> Column:
    """``January_5`` to ``January 5``."""
    return F.translate(name, "_", " ")


def month_day_as_date(month_day: Column) -> Column:
    """A month-day name as a date of the leap year 2000; null if it is no date."""
    return F.try_to_timestamp(F.concat(F.lit("2000 "), month_day), F.lit("yyyy MMMM d")).cast("date")


def in_year(column: str, first: int, last: int | None = None) -> Column:
    """Whether a timestamp lies in the years ``first`` to ``last``, as a range that a scan can use."""
    start, end = (F.lit(datetime.datetime(y, 1, 1)).cast("timestamp_ntz") for y in (first, (last or first) + 1))
    return (F.col(column) >= start) & (F.col(column) < end)


def month_day_number(day: Column) -> Column:
    """105 for the fifth of January."""
    return F.month(day) * 100 + F.dayofmonth(day)


def days_in_month(month_name: Column) -> Column:
    """Number of days of a named month in a common year (February has 28)."""
    first = F.try_to_timestamp(F.concat(F.lit("2001 "), month_name, F.lit(" 1")), F.lit("yyyy MMMM d"))
    return F.dayofmonth(F.last_day(first.cast("date")))


def week_start(day: Column, first_day: str = "sunday") -> Column:
    """First day of the week that holds ``day``; weeks begin on Sunday or Monday."""
    if first_day == "sunday":
        return F.date_sub(day.cast("date"), F.dayofweek(day) - 1)
    if first_day == "monday":
        return F.trunc(day, "week")
    raise ValueError(f"weeks start on 'sunday' or 'monday', not {first_day!r}")


def mission_sol(as_of: Column | None = None) -> Column:
    """Sol number of a date (default: today)."""
    as_of = F.current_date() if as_of is None else as_of
    days = F.datediff(as_of, F.lit(ANCHOR_DATE))
    return F.round(F.lit(ANCHOR_SOL) + days / F.lit(EARTH_DAYS_PER_SOL)).cast("bigint")
