"""Reporting periods: fiscal quarters and inclusive date ranges."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fiscal quarter -> first month; the year is the calendar year of that month.
FIRST_MONTHS = {1: 7, 2: 10, 3: 1, 4: 4}


@dataclass(frozen=True)
class Period:
    """A range of days, both ends included."""

    start: dt.date
    end: dt.date

    @classmethod
    def of(cls, start: str, end: str) -> "Period":
        return cls(dt.date.fromisoformat(start), dt.date.fromisoformat(end))

    @classmethod
    def fiscal_quarter(cls, quarter: int, year: int) -> "Period":
        """Quarter 1 is Jul-Sep, 2 Oct-Dec, 3 Jan-Mar and any other number Apr-Jun."""
        month = FIRST_MONTHS.get(quarter, FIRST_MONTHS[4])
        following = dt.date(year + month // 10, (month + 3) % 12 or 12, 1)
        return cls(dt.date(year, month, 1), following - dt.timedelta(days=1))

    @classmethod
    def last_completed(cls, today: dt.date) -> "Period":
        """The most recent quarter that ended before ``today``."""
        first_month = (today.month - 1) // 3 * 3 + 1
        end = dt.date(today.year, first_month, 1) - dt.timedelta(days=1)
        return cls(dt.date(end.year, end.month - 2, 1), end)

    def covers(self, moment: Column) -> Column:
        """Rows of these days, the whole last day included.

        A half-open range on the bare column, so that it reaches the Parquet scan.
        """
        return (moment >= F.lit(self.start)) & (moment < F.lit(self.end + dt.timedelta(days=1)))

    def display(self) -> tuple[str, str]:
        """Both ends as ``dd/MM/yyyy``."""
        return self.start.strftime("%d/%m/%Y"), self.end.strftime("%d/%m/%Y")


def fiscal_quarter_of(day: Column) -> Column:
    """Fiscal quarter number of a date: Jul-Sep is 1."""
    return (F.quarter(day) + 1) % 4 + 1


def quarter_start_of(day: Column) -> Column:
    return F.trunc(day, "quarter")


def quarter_end_of(day: Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)


def display_date(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")
