"""Shares, percent text, unit scaling and display of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A name nothing has.  Usage without an account or login is kept under it: it counts in the total and
# joins to nothing.  Being never null, the key lets the sums and their total share one shuffle.
NO_NAME = "\x00"

BYTES_PER_GB = 1024.0 * 1024 * 1024


def exact_sum(amount: Column) -> Column:
    """Sum that is 0, not null, for no rows."""
    total = F.sum(amount)
    return F.coalesce(total, F.lit(0).cast("decimal(38,6)"))


def scalar_total(df: DataFrame, amount: str) -> Column:
    """Grand total of ``amount`` as a scalar subquery: one row, computed inside the same job."""
    return df.agg(F.sum(amount).alias("total")).scalar()


def named(name: str) -> Column:
    """A grouping key that is never null."""
    return F.coalesce(F.col(name), F.lit(NO_NAME))


def percent(part: Column, total: Column, places: int) -> Column:
    """``part`` of ``total`` in percent, rounded half up; null when the total is 0 or null."""
    share = F.try_divide(part.cast("double") * F.lit(100.0), total.cast("double"))
    return F.round(share, places)


def percent_text(value: Column) -> Column:
    """``12.5%``, or ``-`` when there is no value."""
    return F.coalesce(F.concat(value.cast("string"), F.lit("%")), F.lit("-"))


def thousands(amount: Column) -> Column:
    return amount.cast("double") / F.lit(1000.0)


def gigabytes(size: Column) -> Column:
    return F.round(size.cast("double") / F.lit(BYTES_PER_GB), 3)


def gigabytes_text(gb: Column) -> Column:
    return F.format_string("%.3f GB", gb)


def grouped_digits(count: Column) -> Column:
    """1234567 as ``1,234,567``."""
    return F.format_number(count, 0)
