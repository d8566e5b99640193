"""Account holders of the event system: all, and those active in a period."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions.period import Period
from tallyforge.operators.directory import Directory, affiliations_of, is_open, memberships, people, places
from tallyforge.operators.filters import all_of, in_period

Pairs = Iterable[tuple[str, object]]


def active_usernames(events: DataFrame, period: Period) -> DataFrame:
    """Users with an event of any type in the period, each once.

    The duplicate removal combines before its shuffle, so a heavy user sends one row per task.
    """
    return (
        in_period(events, period)
        .select(F.col("user").alias("username"))
        .distinct()
    )


def _count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("users"))


def open_affiliations(directory: Directory, filters: Pairs = ()) -> DataFrame:
    """Open affiliation rows of the event system that meet every filter."""
    return memberships(directory, V.EVENT_SYSTEM).filter(is_open() & all_of(filters))


def users_count(directory: Directory, filters: Pairs = ()) -> DataFrame:
    """Number of open affiliations, a user with two of them counting twice."""
    return _count(open_affiliations(directory, filters))


def active_users_count(
    directory: Directory, events: DataFrame, period: Period, filters: Pairs = ()
) -> DataFrame:
    rows = open_affiliations(directory, filters)
    return _count(rows.join(active_usernames(events, period), "username", "left_semi"))


def department_rows(directory: Directory, department_id: int, system_id: int) -> DataFrame:
    """Affiliations with one department, open or closed, of the users of a system."""
    rows = directory.affiliations.filter(F.col("department_id") == department_id)
    return rows.join(directory.system_users(system_id), "user_id")


def department_users_count(
    directory: Directory, department_id: int = V.HOME_DEPARTMENT_ID
) -> DataFrame:
    return _count(department_rows(directory, department_id, V.EVENT_SYSTEM))


def department_active_count(
    directory: Directory,
    events: DataFrame,
    period: Period,
    department_id: int = V.HOME_DEPARTMENT_ID,
) -> DataFrame:
    rows = department_rows(directory, department_id, V.EVENT_SYSTEM)
    named = rows.join(people(directory).select("user_id", "username"), "user_id")
    return _count(named.join(active_usernames(events, period), "username", "left_semi"))


def astronomers_by_department(
    directory: Directory, other_than: str | None = None
) -> DataFrame:
    """Open affiliations per astronomy department, labelled by institution, largest first.

    ``other_than`` leaves one institution out; by default none is.
    """
    if directory.frame is not None:
        rows = directory.frame.filter(is_open() & F.col("placed") & (F.col("is_astronomy") == V.ASTRONOMY))
        if other_than is not None:
            rows = rows.filter(F.col("institution") != other_than)
        counts = rows.groupBy("department_id", "institution").agg(F.count("user_id").alias("users"))
        return counts.orderBy(F.desc("users"), "department_id")
    rows = directory.affiliations.filter(is_open())
    counts = rows.groupBy("department_id").agg(F.count("user_id").alias("users"))
    astronomy = places(directory).filter(F.col("is_astronomy") == V.ASTRONOMY)
    if other_than is not None:
        astronomy = astronomy.filter(F.col("institution") != other_than)
    return (
        counts.join(astronomy, "department_id")
        .select("department_id", "institution", "users")
        .orderBy(F.desc("users"), "department_id")
    )


def account_holders(
    directory: Directory,
    events: DataFrame,
    period: Period,
    department_id: int = V.HOME_DEPARTMENT_ID,
    home: str = "Home department",
) -> DataFrame:
    """Total and active account holders: all, men, women, students and the home department.

    The ten counts are one conditional aggregate over one pass of the directory and of the events.
    """
    return account_holders_of(
        directory, active_usernames(events, period), department_id, home
    )


def account_holders_of(
    directory: Directory,
    active_users: DataFrame,
    department_id: int = V.HOME_DEPARTMENT_ID,
    home: str = "Home department",
) -> DataFrame:
    """``account_holders`` for users already known to be active, each once."""
    active = active_users.withColumn("active", F.lit(True))
    rows = affiliations_of(directory, V.EVENT_SYSTEM).filter("system_rows IS NOT NULL")
    rows = rows.join(active, "username", "left")
    described = is_open() & F.col("known") & F.col("placed")
    astronomy = described & all_of([("is_astronomy", V.ASTRONOMY)])
    lines = (
        (V.LABEL_ALL, described),
        (V.LABEL_MALE, astronomy & all_of([("gender", V.MALE)])),
        (V.LABEL_FEMALE, astronomy & all_of([("gender", V.FEMALE)])),
        (V.LABEL_STUDENT, astronomy & all_of([("is_student", V.STUDENT)])),
        (home, F.col("department_id") == department_id),
    )
    cells = []
    for i, (_, condition) in enumerate(lines, 1):
        # A user entered twice in the system counts twice.
        for name, counted in (("total", condition), ("active", condition & F.col("active"))):
            number = F.sum(F.when(counted, F.col("system_rows")))
            cells.append(F.coalesce(number, F.lit(0)).cast("bigint").alias(f"{name}_{i}"))
    return unpivot_lines(rows.agg(*cells), [label for label, _ in lines])


def unpivot_lines(one_row: DataFrame, labels: list[str]) -> DataFrame:
    """One row of total_i and active_i columns as numbered, labelled lines."""
    lines = F.array(
        *[
            F.struct(
                F.lit(i).cast("bigint").alias("line"),
                F.lit(label).alias("label"),
                F.col(f"total_{i}").alias("total"),
                F.col(f"active_{i}").alias("active"),
            )
            for i, label in enumerate(labels, 1)
        ]
    )
    return one_row.select(F.inline(lines))
