"""Dates and times of day: parsing, formatting, differences, anniversaries."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyloom.functions.predicates import as_column, first_match
from tidyloom.functions.text import extract

# Date layouts by name, in Spark's pattern letters.
LAYOUTS = {
    "iso": "yyyy-M-d",
    "month_first": "M/d/yyyy",
    "day_first": "d/M/yyyy",
    "day_short_month": "d-MMM-yyyy",
    "day_long_month": "d-MMMM-yyyy",
    "month_first_short_year": "M-d-yy",
    "joined_long_month": "dMMMMyyyy",
    "written": "d MMMM, yyyy",
}


def parse_date(column: Column | str, layout: str) -> Column:
    """Parse a text by a named layout, or by a Spark pattern.

    ``written`` may carry a leading weekday name, which Spark does not parse.
    Two-digit years run from 1969 to 2068, where Spark would begin at 2000.
    """
    column = as_column(column)
    if layout == "written":
        column = F.regexp_replace(column, r"^\p{L}+, *", "")
    parsed = F.to_date(column, LAYOUTS.get(layout, layout))
    if layout == "month_first_short_year":
        parsed = F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)
    return parsed


def weekday_number(column: Column | str) -> Column:
    """Monday is 1, Sunday 7."""
    return F.weekday(as_column(column)) + 1


def is_weekday(column: Column | str) -> Column:
    return F.weekday(as_column(column)) < 5


def weekday_name(column: Column | str) -> Column:
    return F.date_format(as_column(column), "EEEE")


def month_name(column: Column | str) -> Column:
    return F.date_format(as_column(column), "MMMM")


def month_year(column: Column | str, pattern: str = "MMMM-yyyy") -> Column:
    return F.date_format(as_column(column), pattern)


def month_start(column: Column | str) -> Column:
    return F.trunc(as_column(column), "month")


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start))


def approx_years_between(start: Column | str, end: Column | str) -> Column:
    return days_between(start, end) / 365.25


def approx_months_between(start: Column | str, end: Column | str) -> Column:
    return F.lit(12) * days_between(start, end) / 365.25


def whole_years_between(start: Column | str, end: Column | str) -> Column:
    return F.floor(approx_years_between(start, end)).cast("long")


def whole_months_between(start: Column | str, end: Column | str) -> Column:
    return F.floor(approx_months_between(start, end)).cast("long")


def anniversary(column: Column | str, year: int) -> Column:
    """The same day in another year; null for 29 February in a common year."""
    column = as_column(column)
    return F.to_date(F.try_to_timestamp(F.concat(F.lit(f"{year}-"), F.date_format(column, "MM-dd")), F.lit("yyyy-MM-dd")))


def earliest(first: Column | str, second: Column | str) -> Column:
    """The earlier of two dates; a null ``second`` leaves ``first``."""
    first, second = as_column(first), as_column(second)
    return first_match([(second.isNull(), first), (first <= second, first)], second)


def date_from_month_text(day: Column | str, month: Column | str, year: Column | str) -> Column:
    """Day number, long month name and year, each a column, put together to a date."""
    return F.to_date(F.concat(as_column(day), as_column(month), as_column(year)), LAYOUTS["joined_long_month"])


def time_of_day(column: Column | str) -> Column:
    """``H:mm`` text to ``HH:mm:ss`` text; null when it is no time.

    Spark has no time-of-day type on by default, so the time stays a text that sorts right.
    """
    column = as_column(column)
    hour, minute = extract(column, r"^(\d{1,2}):\d{2}$").cast("int"), extract(column, r"^\d{1,2}:(\d{2})$").cast("int")
    valid = hour.between(0, 23) & minute.between(0, 59)
    return F.when(valid, F.format_string("%02d:%02d:00", hour, minute))


def academic_year(born_on: Column | str, first_start: datetime.date = datetime.date(2014, 9, 1), years: int = 4) -> Column:
    """Year of school by September cut-offs: 1 from ``first_start`` on, one more a year before."""
    born_on = as_column(born_on)
    cuts = [(born_on >= F.lit(first_start.replace(year=first_start.year - k)), k + 1) for k in range(years)]
    return first_match(cuts)


def fiscal_quarter(column: Column | str, shift: int = 2) -> Column:
    """Quarter of a fiscal year that begins ``shift`` quarters after January."""
    return ((F.quarter(as_column(column)) - 1 + shift) % 4 + 1).cast("int")
