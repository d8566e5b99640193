"""Usage rolled up per user and day, and its attribution to dated affiliations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions.period import Period
from tallyforge.operators.filters import finished_in, in_period
from tallyforge.operators.materialize import materialize


def units_sum(events: DataFrame, when: Column | None = None) -> Column:
    """CPU hours of events, optionally of some of them: exact seconds are summed and divided once.

    Events without CPU seconds, from another source, are summed by their service units.
    """
    name = "cpu_seconds" if "cpu_seconds" in events.columns else "service_units"
    total = F.sum(F.col(name) if when is None else F.when(when, F.col(name)))
    return _hours(total) if name == "cpu_seconds" else total


def _hours(seconds: Column) -> Column:
    return (seconds.cast("decimal(38,18)") / F.lit(3600).cast("decimal(4,0)")).cast("decimal(38,18)")


def finished_usage(events: DataFrame, period: Period) -> DataFrame:
    """User, account and units of every finished job of a period."""
    exact = "cpu_seconds" in events.columns
    units = _hours(F.col("cpu_seconds")) if exact else F.col("service_units")
    return finished_in(events, period).select("user", "account", units.alias("units"))


def daily_usage(events: DataFrame, period: Period, *more_keys: str) -> DataFrame:
    """Usage of finished jobs per user, day and "exactly at midnight", and any further keys.

    Affiliation bounds are dates, so a job's day, and whether it falls on midnight itself, decide
    every comparison with them.  Summing to this grain first loses nothing and leaves a heavy user
    at most two rows per day, so the join that follows has no hot key.
    """
    day = F.to_date("time")
    return (
        finished_in(events, period)
        .groupBy("user", *more_keys, day.alias("day"), (F.col("time") == day).alias("at_midnight"))
        .agg(units_sum(events).alias("units"))
    )


def activity_rollup(events: DataFrame, period: Period) -> DataFrame:
    """Everything a report asks of the events, from one pass over them.

    The grain of ``daily_usage`` with accounts, but events of every type count as activity;
    ``finished`` is the number of finished jobs and ``units`` their usage.
    """
    day = F.to_date("time")
    ended = F.col("type") == V.JOB_END
    return (
        in_period(events, period)
        .groupBy("user", "account", day.alias("day"), (F.col("time") == day).alias("at_midnight"))
        .agg(
            F.count_if(ended).alias("finished"),
            units_sum(events, ended).alias("units"),
        )
    )


def usage_of(rollup: DataFrame) -> DataFrame:
    """The finished usage in a rollup, in the columns of ``daily_usage``."""
    return rollup.filter("finished > 0").drop("finished")


def valid_at_day(day: Column, at_midnight: Column, start: Column, end: Column) -> Column:
    """``start <= moment <= end`` for a moment known by its day; a null end is open.

    An end date means its first instant: of the last day only midnight itself is inside.
    """
    return (day >= start) & (end.isNull() | (day < end) | ((day == end) & at_midnight))


def valid_at(moment: Column, start: Column, end: Column) -> Column:
    """``start <= moment <= end``; a null end is open."""
    return (moment >= start) & (end.isNull() | (moment <= end))


#: A user's events of one month are a hot bin beyond this many, or beyond a ten-thousandth of all events.
HOT_ROWS, MOST_HOT_BINS = 1_000_000, 10_000


def affiliation_at_event(events: DataFrame, affiliations: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every event with each affiliation of its user valid at that time.

    A user with overlapping affiliations yields one row for each of them.

    Events meet affiliations by user and month, so a busy user is many keys.  What a user has done in a
    month is counted first, combined before its shuffle: affiliations are repeated for the months in
    which their user has events and no others, and a month with very many is dealt over slots, by a
    hash of the whole event, with its affiliations in each.  There are fewer than ``MOST_HOT_BINS``
    such months, so their list can be sent to every task.
    """
    events = events.withColumn("_month", F.trunc(F.to_date("time"), "month"))
    months = materialize(events.groupBy("user", "_month").agg(F.count("*").alias("_n")), "months")
    total = months.agg(F.sum("_n")).first()[0] or 0
    bound = max(hot_rows, total // MOST_HOT_BINS)
    slots = F.ceil(F.col("_n") / bound).cast("int")
    hot = months.filter(F.col("_n") > bound).select("user", "_month", slots.alias("_slots"))
    dated = affiliations.withColumnRenamed("username", "user")
    overlap = (F.col("start_date") <= F.last_day("_month")) & (
        F.col("end_date").isNull() | (F.col("end_date") >= F.col("_month"))
    )
    bins = months.filter("_month IS NOT NULL").join(dated, "user").filter(overlap)
    bins = bins.select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / bound).cast("int") - 1)).alias("_slot"))
    spread = F.pmod(F.xxhash64(*[f"`{c}`" for c in events.columns]), F.coalesce("_slots", F.lit(1))).cast("int")
    dealt = events.join(F.broadcast(hot), ["user", "_month"], "left").withColumn("_slot", spread)
    joined = dealt.join(bins.drop("_n"), ["user", "_month", "_slot"]).drop("_month", "_slot", "_slots")
    return joined.filter(valid_at(F.col("time"), F.col("start_date"), F.col("end_date")))


def attribute_usage(
    user_days: DataFrame, affiliations: DataFrame, keys: list[str]
) -> DataFrame:
    """Usage per affiliation attribute, by the affiliations valid on each day.

    ``affiliations`` holds ``username``, ``department_id``, the dates and the key columns; equal
    rows count once.

    The join is outer and unmatched usage is dropped after the sum.  An inner join would push "user
    is not null" into the events, and the total beside it, a sum over the same rollup without that
    filter, could then no longer reuse its shuffle and would read the events again.
    """
    dated = affiliations.withColumnRenamed("username", "_user").distinct()
    valid = valid_at_day(
        F.col("day"), F.col("at_midnight"), F.col("start_date"), F.col("end_date")
    )
    matched = user_days.join(dated, (F.col("user") == F.col("_user")) & valid, "left")
    sums = matched.groupBy(*keys).agg(
        F.sum("units").alias("units"), F.count("_user").alias("_matches")
    )
    return sums.filter("_matches > 0").drop("_matches")
