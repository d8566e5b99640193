"""Usage from per-job events.

Functions take the finished usage of a period, raw (``finished_usage``) or rolled up
(``daily_usage``), so a whole report can share one rollup while a single question stays one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions import labels as L
from tallyforge.functions import shares as S
from tallyforge.operators.attribution import attribute_usage, valid_at_day
from tallyforge.operators.directory import Directory, memberships
from tallyforge.operators.residual import residual_percent

PERSON_KEYS = ["first_name", "last_name", "user", "institution"]
ATTRIBUTED_KEYS = PERSON_KEYS + ["country", "gender", "is_student", "is_astronomy"]
PLACE_COLUMNS = ["username", "department_id", "department", "institution"]
PERSON_COLUMNS = PLACE_COLUMNS + ["country", "is_astronomy", "gender", "is_student", "first_name", "last_name"]


def total_usage(usage: DataFrame) -> DataFrame:
    """Total units; 0 for a period without usage."""
    return usage.agg(S.exact_sum(F.col("units")).cast("double").alias("total_units"))


def usage_by_account(usage: DataFrame) -> DataFrame:
    """Units per account in thousands, ordered by account."""
    sums = usage.groupBy("account").agg(F.sum("units").alias("units"))
    return sums.select("account", S.thousands(F.col("units")).alias("usage_thousands")).orderBy(
        "account"
    )


def usage_by_account_text(by_account: DataFrame) -> DataFrame:
    """One fixed-width line per account: the code in 15 columns, then the amount."""
    line = F.format_string("%-15s %.6f ", F.coalesce("account", F.lit("")), "usage_thousands")
    return by_account.select("account", line.alias("line"))


def usage_by_user(usage: DataFrame) -> DataFrame:
    return usage.groupBy("user").agg(F.sum("units").alias("units"))


def percent_by_project(usage: DataFrame, directory: Directory) -> DataFrame:
    """Share of every project of the event system; a project without usage has none.

    Accounts are summed before the outer join, which then meets one row per account; the total is
    the sum of those rows.
    """
    projects = directory.projects.filter(F.col("system_id") == V.EVENT_SYSTEM).select("id", "code")
    sums = usage.groupBy(S.named("account").alias("code")).agg(F.sum("units").alias("units"))
    pct = S.percent(F.col("units"), S.scalar_total(sums, "units"), 3)
    shares = projects.join(sums, "code", "left").select("code", pct.alias("percentage"))
    return shares.withColumn("percentage_text", S.percent_text(F.col("percentage")))


def percent_by_institution(usage: DataFrame, directory: Directory) -> DataFrame:
    """Share of each institution, by the affiliation valid when a job was recorded.

    Overlapping affiliations count a job once each, so the shares may add up to more than 100.
    """
    dated = memberships(directory, V.EVENT_SYSTEM).select(
        "username", "department_id", "department", "institution", "start_date", "end_date"
    )
    return institution_shares(attribute_usage(usage, dated, ["institution"]), usage)


def institution_shares(sums: DataFrame, usage: DataFrame) -> DataFrame:
    """Units per institution as shares of the whole usage, largest first."""
    pct = S.percent(F.col("units"), S.scalar_total(usage, "units"), 2)
    return (
        sums.select("institution", pct.alias("percentage"))
        .withColumn("percentage_text", S.percent_text(F.col("percentage")))
        .orderBy(F.desc("percentage"), "institution")
    )


def _person_shares(usage: DataFrame, affiliations: DataFrame, keys: list[str]) -> DataFrame:
    return _shares_of(attribute_usage(usage, affiliations, keys), usage, keys)


def _shares_of(sums: DataFrame, usage: DataFrame, keys: list[str]) -> DataFrame:
    pct = S.percent(F.col("units"), S.scalar_total(usage, "units"), 2)
    return sums.select(*keys, pct.alias("percentage"))


def percent_by_national_user(usage: DataFrame, directory: Directory) -> DataFrame:
    """Share of each user of an astronomy department in the home country."""
    national = memberships(directory).filter(
        (F.col("is_astronomy") == V.ASTRONOMY) & (F.col("country") == V.NATIONAL_COUNTRY)
    )
    dated = national.select(
        "username", "department_id", "department", "institution", "first_name", "last_name",
        "start_date", "end_date",
    )
    return (
        _person_shares(usage, dated, PERSON_KEYS)
        .select(
            L.full_name(F.col("first_name"), F.col("last_name")).alias("name"),
            "institution",
            F.col("user").alias("username"),
            "percentage",
        )
        .orderBy(F.desc("percentage"), "username", "institution")
    )


def percent_by_national_user_text(shares: DataFrame) -> DataFrame:
    """One fixed-width line per user: name, institution, username and share."""
    line = F.format_string(
        "%-30s %-50s %-20s %s ", "name", "institution", "username", F.col("percentage").cast("string")
    )
    return shares.select("username", "institution", line.alias("line"))


def percent_by_person(usage: DataFrame, directory: Directory) -> DataFrame:
    """Share per user and attributes at event time, rounded to two places, codes as labels."""
    dated = memberships(directory).select(*PERSON_COLUMNS, "start_date", "end_date")
    return person_labels(_person_shares(usage, dated, ATTRIBUTED_KEYS))


def person_labels(shares: DataFrame) -> DataFrame:
    return shares.select(
        F.col("user").alias("username"),
        L.full_name(F.col("first_name"), F.col("last_name")).alias("name"),
        "institution",
        "country",
        L.gender_label(F.col("gender")).alias("gender"),
        L.student_label(F.col("is_student")).alias("student"),
        L.astronomy_label(F.col("is_astronomy")).alias("is_astronomy"),
        L.nationality_label(F.col("country")).alias("is_australia"),
        "percentage",
    )


def attributed_usage(usage: DataFrame, directory: Directory) -> DataFrame:
    """Usage per person and attributes at event time, from one join with a prepared directory.

    ``units`` are those of the person under any system.  ``system_units`` are those by which the
    institution is credited: of users of the event system, an affiliation that several user rows
    share counting once.  Both sections of a report then add up these few rows.
    """
    in_system = F.col("rows_in_system_%d" % V.EVENT_SYSTEM).isNotNull()
    rows = directory.frame.filter("known AND placed").groupBy(*PERSON_COLUMNS, "start_date", "end_date")
    dated = rows.agg(F.max(in_system).alias("in_system"))
    same_place = Window.partitionBy(*PLACE_COLUMNS, "start_date", "end_date").orderBy(
        F.desc("in_system"), "first_name", "last_name", "gender", "is_student", "country", "is_astronomy"
    )
    dated = dated.withColumn("credited", F.col("in_system") & (F.row_number().over(same_place) == 1))
    valid = valid_at_day(F.col("day"), F.col("at_midnight"), F.col("start_date"), F.col("end_date"))
    joined = usage.join(dated.withColumnRenamed("username", "_user"), (F.col("user") == F.col("_user")) & valid)
    return joined.groupBy(*ATTRIBUTED_KEYS).agg(
        F.sum("units").alias("units"),
        F.sum(F.when(F.col("credited"), F.col("units"))).alias("system_units"),
        F.count_if("credited").alias("credits"),
    )


def attributed_by_institution(attributed: DataFrame, usage: DataFrame) -> DataFrame:
    """``percent_by_institution`` from attributed usage."""
    sums = attributed.filter("credits > 0").groupBy("institution").agg(F.sum("system_units").alias("units"))
    return institution_shares(sums, usage)


def attributed_by_person(attributed: DataFrame, usage: DataFrame) -> DataFrame:
    """``percent_by_person`` from attributed usage."""
    return person_labels(_shares_of(attributed, usage, ATTRIBUTED_KEYS))


CRITERIA = ("gender", "student", "is_astronomy", "is_australia")


def by_criterion(rows: DataFrame, *kept: str) -> DataFrame:
    """One row per demographic criterion: ``criterion``, its number and the row's ``grp``."""
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("criterion_no"), F.lit(c).alias("criterion"), F.col(c).alias("grp"))
            for i, c in enumerate(CRITERIA, 1)
        ]
    )
    return rows.select(*kept, F.inline(pairs))


def percent_by_demographic(persons: DataFrame) -> DataFrame:
    """Roll the rounded personal shares up by gender, student, astronomy and nationality.

    Groups stand in the order a list of persons by descending share first shows them.  That order
    needs only the leading person of each group, a mergeable minimum, so persons are never ranked
    in one task.
    """
    share = F.col("percentage").cast("decimal(18,2)")
    rank = F.struct((-share).alias("share"), "username", "institution", "is_astronomy")
    rows = persons.filter(F.col("percentage").isNotNull()).select(
        *CRITERIA, share.alias("share"), rank.alias("rank")
    )
    groups = (
        by_criterion(rows, "share", "rank")
        .groupBy("criterion_no", "criterion", "grp")
        .agg(F.sum("share").alias("share"), F.min("rank").alias("first_seen"))
    )
    return residual_percent(groups).select(
        "criterion_no",
        "criterion",
        F.col("position").cast("bigint").alias("position"),
        "grp",
        F.col("share").cast("double").alias("share"),
        "residual_pct",
    )
