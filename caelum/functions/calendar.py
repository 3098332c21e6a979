"""Periods, dates and calendar months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = dt.date(1950, 1, 1)


def parse_period(text: str) -> list[int]:
    """``"a"`` one value, ``"a,0,b"`` the closed range a..b, otherwise the listed values."""
    items = [int(part) for part in text.split(",")]
    if len(items) == 3 and items[1] == 0:
        return list(range(items[0], items[2] + 1))
    return items


def in_period(value: Column, text: str) -> Column:
    items = parse_period(text)
    if items == list(range(items[0], items[0] + len(items))):
        return value.between(items[0], items[-1])
    return value.isin(items)


def evaluation_period(text: str | None, syr: int, eyr: int) -> tuple[int, int, int, int]:
    """(first year, last year, first month, last month) of an evaluation run."""
    if text is None:
        return syr, eyr, 1, 12
    first, second = (int(part) for part in text.split(","))
    if first > 1000 and 1 <= second <= 12:
        return first, first, second, second
    if first > 1000 and second > 1000:
        return first, second, 1, 12
    raise ValueError(f"period {text!r} is neither 'year,month' nor 'year,year'")


def within_evaluation(issue_date: Column, text: str | None, syr: int, eyr: int) -> Column:
    y0, y1, m0, m1 = evaluation_period(text, syr, eyr)
    return F.year(issue_date).between(y0, y1) & F.month(issue_date).between(m0, m1)


def lead_month(valid_date: Column, issue_date: Column) -> Column:
    """Calendar months between the issue month and the valid month, wrapping December."""
    return F.pmod(F.month(valid_date) - F.month(issue_date), F.lit(12)).cast("int")


def in_month_set(valid_date: Column, issue_date: Column, months: int = 8) -> Column:
    """The ``months`` calendar months from the issue month on."""
    return lead_month(valid_date, issue_date) < months


def evaluation_months(month_start: Column, issue_date: Column | None = None) -> Column:
    """Calendar months 1 to 7; with ``issue_date``, the first seven lead months instead."""
    if issue_date is None:
        return F.month(month_start) < 8
    return lead_month(month_start, issue_date) < 7


def valid_date(issue_date: Column, lead: Column) -> Column:
    return F.date_add(issue_date.cast("date"), lead.cast("int"))


def hindcast_date(year: Column, month: Column, step: Column) -> Column:
    """Date of day ``step`` of the hindcast issued on the first of ``month``."""
    return F.date_add(F.make_date(year, month, F.lit(1)), step.cast("int"))


def day_number(date: Column) -> Column:
    return F.datediff(date.cast("date"), F.lit(EPOCH))


def from_day_number(number: Column) -> Column:
    return F.date_add(F.lit(EPOCH), number.cast("int"))


def year_length(date: Column) -> Column:
    return F.dayofyear(F.make_date(F.year(date), F.lit(12), F.lit(31)))


def month_start(date: Column) -> Column:
    return F.trunc(date.cast("date"), "month")
