"""Dates written in several ways, read without ever failing a task.

The text is put into year-month-day order and cast with ``try_cast``. Unlike a
chain of format attempts, that costs no exception for the formats that do not fit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.text import as_col


# Day, month and year at the start of a text, in either order of day and month. A number that is no month does not
# fit: the cast would find that out by an exception, which costs more than all the rest of a record.
_MONTH_FIRST = r"^\s*(0?[1-9]|1[0-2])[-/.](\d{1,2})[-/.](\d{4})"
_DAY_FIRST = r"^\s*(\d{1,2})[-/.](0?[1-9]|1[0-2])[-/.](\d{4})"
_LONG_DATE = r"^\s*(\d{4})[/.](\d{1,2})[/.](\d{1,2})"


def record_date(value: str | Column, day_first: bool = False) -> Column:
    """Date of a record. Ambiguous dates read month first unless ``day_first`` is set.

    A date that cannot start with its month (13 and up) is read day first either way.
    """
    c = as_col(value)
    read = lambda pattern, order: F.regexp_replace(c, pattern, order).try_cast("timestamp")
    orders = [read(_DAY_FIRST, "$3-$2-$1")] if day_first else [
        read(_MONTH_FIRST, "$3-$1-$2"),
        read(_DAY_FIRST, "$3-$2-$1"),
    ]
    # a bare time of day would be cast to today's date
    bare_time = F.substring(c, 1, 4).contains(":")
    return F.when(~bare_time, F.coalesce(*orders, read(_LONG_DATE, "$1-$2-$3")))


def rule_date(value: str | Column, strict: bool = False) -> Column:
    """Date of a rule, day first. ``strict`` admits only ``d-M-yyyy``."""
    text = as_col(value)
    if strict:
        text = F.when(text.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), text)
    return record_date(text, day_first=True)


def report_date(value: str | Column) -> Column:
    """``dd-MM-yyyy``, or ``nan`` for a missing date."""
    return F.coalesce(F.date_format(as_col(value), "dd-MM-yyyy"), F.lit("nan"))


def planning_day(value: str | Column) -> Column:
    """Delivery date ``day-month-year`` as a date; days and months past their end roll over."""
    parts = F.split(as_col(value), "-")
    day, month, year = (F.trim(F.get(parts, F.lit(i))).try_cast("int") for i in range(3))
    full_year = F.when(year.between(0, 99), year + 1900).otherwise(year)
    usable = full_year.between(1, 9000) & month.between(-1200, 1200) & day.between(-36500, 36500)
    january = F.when(usable, F.make_date(full_year, F.lit(1), F.lit(1)))
    return F.date_add(F.add_months(january, month - 1), day - 1)


def delivery_year(value: str | Column) -> Column:
    """Year of a delivery date in any of the accepted spellings, null if there is none."""
    c = as_col(value)
    parts = F.split(c, "-")
    n = F.size(parts)
    first, third = F.get(parts, F.lit(0)), F.get(parts, F.lit(2))
    leading = lambda t: F.regexp_extract(t, r"^\s*(\d+)", 1).try_cast("int")
    return F.coalesce(
        F.when((n == 3) & (F.length(third) == 4), leading(third)),
        F.when((n >= 3) & (F.length(first) == 4), leading(first)),
        F.year(record_date(c)),
        F.regexp_extract(c, r"\b((?:19|20)\d{2})\b", 1).try_cast("int"),
    )


def display_date(value: str | Column) -> Column:
    """Time stamp as ``dd/MM/yyyy, HH:mm``; a placeholder if missing, unreadable text as it is."""
    c = as_col(value).cast("string")
    shown = F.date_format(c.try_cast("timestamp"), "dd/MM/yyyy, HH:mm")
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("Geen datum")).otherwise(F.coalesce(shown, c))


def display_delivery(value: str | Column) -> Column:
    """Delivery date as ``dd/MM/yyyy``; a placeholder if missing, unreadable text as it is."""
    c = as_col(value).cast("string")
    shown = F.date_format(F.coalesce(rule_date(c), c.try_cast("timestamp")), "dd/MM/yyyy")
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("Geen leverdatum")).otherwise(F.coalesce(shown, c))


def deadline(today: str | Column, days: int) -> Column:
    """``yyyy-MM-dd`` text of the day ``days`` after ``today``."""
    day = F.lit(today).cast("date") if isinstance(today, str) else today
    return F.date_format(F.date_add(day, days), "yyyy-MM-dd")
