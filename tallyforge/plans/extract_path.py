"""Usage from a per-user summary file (the extract) and the users of its system."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions import shares as S
from tallyforge.operators.directory import (
    Directory,
    affiliations_of,
    is_open,
    labelled_users,
    latest_affiliation,
    memberships,
    people,
)
from tallyforge.operators.filters import all_of, discard_accounts
from tallyforge.plans.event_path import by_criterion
from tallyforge.plans.user_counts import department_rows, unpivot_lines

Pairs = Iterable[tuple[str, object]]


def charged_usage(
    extract: DataFrame, discarded: Iterable[str] = V.DISCARDED_ACCOUNTS
) -> DataFrame:
    """Login, account and units of the extract without administrative accounts."""
    kept = discard_accounts(extract, discarded)
    return kept.select("login", "account", F.col("used").alias("units"))


def total_usage(charged: DataFrame) -> DataFrame:
    return charged.agg(S.exact_sum(F.col("units")).cast("double").alias("total_units"))


def usage_by_login(charged: DataFrame) -> DataFrame:
    return charged.groupBy(S.named("login").alias("username")).agg(F.sum("units").alias("units"))


def active_logins(charged: DataFrame) -> DataFrame:
    return charged.select(F.col("login").alias("username")).distinct()


def percent_by_project(
    charged: DataFrame, directory: Directory, prefix: str = V.EXTRACT_PROJECT_PREFIX
) -> DataFrame:
    """Share of each project of the extract system whose code has the prefix, in code order."""
    projects = directory.projects.filter(
        (F.col("system_id") == V.EXTRACT_SYSTEM) & F.lower("code").startswith(prefix.lower())
    ).select("id", "code")
    sums = charged.groupBy(S.named("account").alias("code")).agg(F.sum("units").alias("units"))
    pct = S.percent(F.col("units"), S.scalar_total(sums, "units"), 3)
    return (
        projects.join(sums, "code", "left")
        .select("code", pct.alias("percentage"))
        .withColumn("percentage_text", S.percent_text(F.col("percentage")))
        .orderBy("code")
    )


def current_affiliations(directory: Directory, filters: Pairs = ()) -> DataFrame:
    """Per user of the extract system the open affiliation that started last."""
    rows = memberships(directory, V.EXTRACT_SYSTEM).filter(is_open() & all_of(filters))
    return latest_affiliation(
        rows.select("user_id", "username", "department_id", "institution", "start_date")
    )


def percent_by_institution(charged: DataFrame, directory: Directory) -> DataFrame:
    """Share of each institution by current affiliation; institutions without usage show 0."""
    users = current_affiliations(directory).select("username", "institution")
    by_login = usage_by_login(charged)
    used = users.join(by_login, "username", "left")
    sums = used.groupBy("institution").agg(S.exact_sum(F.col("units")).alias("units"))
    pct = S.percent(F.col("units"), S.scalar_total(by_login, "units"), 3)
    return (
        sums.select("institution", pct.alias("percentage"))
        .withColumn("percentage_text", S.percent_text(F.col("percentage")))
        .orderBy(F.desc("percentage"), "institution")
    )


def percent_by_demographic(charged: DataFrame, directory: Directory) -> DataFrame:
    """Share by gender (male and female only), student, astronomy and nationality."""
    users = labelled_users(directory, V.EXTRACT_SYSTEM)
    by_login = usage_by_login(charged)
    used = users.join(by_login, "username", "left")
    genders = [V.GENDER_LABELS[V.MALE], V.GENDER_LABELS[V.FEMALE]]
    rows = by_criterion(used, "units").filter(
        F.col("grp").isNotNull() & ((F.col("criterion") != "gender") | F.col("grp").isin(genders))
    )
    sums = rows.groupBy("criterion_no", "criterion", "grp").agg(
        S.exact_sum(F.col("units")).alias("units")
    )
    pct = S.percent(F.col("units"), S.scalar_total(by_login, "units"), 2)
    return sums.select("criterion_no", "criterion", "grp", pct.alias("percentage"))


def _open_of_active(directory: Directory, charged: DataFrame) -> DataFrame:
    rows = memberships(directory).filter(is_open())
    return rows.join(active_logins(charged), "username", "left_semi")


def active_users_count(charged: DataFrame, directory: Directory, filters: Pairs = ()) -> DataFrame:
    """Open affiliations, on any system, of users who appear in the extract."""
    rows = _open_of_active(directory, charged).filter(all_of(filters))
    return rows.agg(F.count("*").alias("users"))


def department_active_count(
    charged: DataFrame, directory: Directory, department_id: int = V.HOME_DEPARTMENT_ID
) -> DataFrame:
    rows = department_rows(directory, department_id, V.EXTRACT_SYSTEM)
    named = rows.join(people(directory).select("user_id", "username"), "user_id")
    active = named.join(active_logins(charged), "username", "left_semi")
    return active.agg(F.count("*").alias("users"))


def users_count(directory: Directory, filters: Pairs = ()) -> DataFrame:
    """Distinct usernames with an open affiliation."""
    rows = memberships(directory, V.EXTRACT_SYSTEM).filter(is_open() & all_of(filters))
    return rows.agg(F.count_distinct("username").alias("users"))


def department_users_count(
    directory: Directory, department_id: int = V.HOME_DEPARTMENT_ID
) -> DataFrame:
    rows = department_rows(directory, department_id, V.EXTRACT_SYSTEM)
    return rows.agg(F.count_distinct("user_id").alias("users"))


def astronomers_by_institution(directory: Directory, other_than: str | None = None) -> DataFrame:
    """Users per institution by current astronomy affiliation, largest first."""
    users = current_affiliations(directory, [("is_astronomy", V.ASTRONOMY)])
    if other_than is not None:
        users = users.filter(F.col("institution") != other_than)
    counts = users.groupBy("institution").agg(F.count("user_id").alias("users"))
    return counts.orderBy(F.desc("users"), "institution")


def account_holders(
    charged: DataFrame,
    directory: Directory,
    department_id: int = V.HOME_DEPARTMENT_ID,
    home: str = "Home department",
) -> DataFrame:
    """Total and active astronomy account holders of the extract system.

    Totals are distinct users of the system; active counts are affiliation rows on any system.
    Distinct users are first folded to one row of flags per username, so the totals need one
    aggregation by user rather than one distinct set per line.
    """
    active = active_logins(charged).withColumn("active", F.lit(True))
    rows = affiliations_of(directory, V.EXTRACT_SYSTEM).join(active, "username", "left")
    astronomy = is_open() & F.col("username").isNotNull() & all_of([("is_astronomy", V.ASTRONOMY)])
    conditions = (
        (V.LABEL_ALL, astronomy),
        (V.LABEL_MALE, astronomy & all_of([("gender", V.MALE)])),
        (V.LABEL_FEMALE, astronomy & all_of([("gender", V.FEMALE)])),
        (V.LABEL_STUDENT, astronomy & all_of([("is_student", V.STUDENT)])),
    )
    at_home = F.col("department_id") == department_id
    flags = []
    for i, (_, condition) in enumerate(conditions, 1):
        counted = condition & F.col("system_rows").isNotNull()
        flags.append(F.max(F.when(counted, 1)).alias(f"user_{i}"))
        flags.append(F.count_if(condition & F.col("active")).alias(f"active_{i}"))
    flags.append(F.max(F.when(at_home & F.col("system_rows").isNotNull(), 1)).alias("user_5"))
    flags.append(F.sum(F.when(at_home & F.col("active"), F.col("system_rows"))).alias("active_5"))

    per_user = rows.groupBy("username", F.when(at_home, F.col("user_id")).alias("home_id")).agg(*flags)
    per_name = per_user.groupBy("username").agg(
        *[F.max(f"user_{i}").alias(f"user_{i}") for i in range(1, 5)],
        F.sum("user_5").alias("user_5"),
        *[F.sum(f"active_{i}").alias(f"active_{i}") for i in range(1, 6)],
    )
    cells = []
    for i in range(1, 6):
        cells.append(F.coalesce(F.sum(f"user_{i}"), F.lit(0)).cast("bigint").alias(f"total_{i}"))
        cells.append(F.coalesce(F.sum(f"active_{i}"), F.lit(0)).cast("bigint").alias(f"active_{i}"))
    return unpivot_lines(per_name.agg(*cells), [label for label, _ in conditions] + [home])
