"""Filters over events, accounts and users."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions.period import Period

FILTER_COLUMNS = frozenset(
    {"is_astronomy", "gender", "is_student", "department_id", "institution_id", "country",
     "institution", "username"}
)


def in_period(events: DataFrame, period: Period) -> DataFrame:
    """Events of a period; of a stored table only the dates of the period are listed and opened."""
    within = period.covers(F.col("time"))
    if "event_date" in events.columns:
        within &= F.col("event_date").between(F.lit(period.start), F.lit(period.end))
    return events.filter(within)


def finished_in(events: DataFrame, period: Period) -> DataFrame:
    """Finished jobs of a period; all predicates are on bare columns and reach the scan."""
    return in_period(events, period).filter(F.col("type") == V.JOB_END)


def all_of(pairs: Iterable[tuple[str, object]]) -> Column:
    """AND of column = value pairs; columns outside the allowed set are refused."""
    pairs = list(pairs)
    refused = sorted({name for name, _ in pairs} - FILTER_COLUMNS)
    if refused:
        raise ValueError(f"not a filter column: {', '.join(refused)}")
    return reduce(lambda a, b: a & b, [F.col(n) == F.lit(v) for n, v in pairs], F.lit(True))


def _values(names: Iterable[str]) -> list[str]:
    return sorted({name.strip() for name in names if name and name.strip()})


def excluding(df: DataFrame, column: str, names: Iterable[str] | DataFrame) -> DataFrame:
    """NOT IN: rows whose value is not listed; a null value is dropped too.

    A list, being short and given by the caller, becomes a pushed-down predicate without a join.
    A DataFrame of names becomes an anti-join, broadcast only when it measures small.
    """
    present = df.filter(F.col(column).isNotNull())
    if isinstance(names, DataFrame):
        listed = names.select(F.trim(names.columns[0]).alias(column)).distinct()
        return present.join(listed, column, "left_anti")
    listed = _values(names)
    return present.filter(~F.col(column).isin(listed)) if listed else present


def drop_listed(df: DataFrame, column: str, names: Iterable[str] | DataFrame) -> DataFrame:
    """Remove the rows whose value is listed; rows with a null value stay."""
    if isinstance(names, DataFrame):
        listed = names.select(F.trim(names.columns[0]).alias(column)).distinct()
        return df.join(listed, column, "left_anti")
    listed = _values(names)
    if not listed:
        return df
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(listed))


def drop_admin_usage(events: DataFrame, admins: Iterable[str] | DataFrame) -> DataFrame:
    """Events without those of the administrative users."""
    return drop_listed(events, "user", admins)


def discard_accounts(extract: DataFrame, accounts: Iterable[str] = V.DISCARDED_ACCOUNTS) -> DataFrame:
    """Extract rows without the administrative accounts; rows without an account stay."""
    return drop_listed(extract, "account", accounts)
