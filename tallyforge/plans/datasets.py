"""Activity of the dataset-query service."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import shares as S
from tallyforge.functions.labels import dataset_family
from tallyforge.functions.period import Period
from tallyforge.operators.filters import excluding
from tallyforge.operators.latest import first_by


def counted_jobs(jobs: DataFrame, period: Period, admins: Iterable[str] | DataFrame) -> DataFrame:
    """Latest job versions inserted in the period, administrative users excluded."""
    latest = jobs.filter(F.col("latestjobversion") & period.covers(F.col("insertdate")))
    return excluding(latest, "username", admins)


def jobs_count(counted: DataFrame) -> DataFrame:
    return counted.agg(F.count("*").alias("jobs"))


def registered_users_count(
    site_users: DataFrame, admins: Iterable[str] | DataFrame
) -> DataFrame:
    return excluding(site_users, "username", admins).agg(F.count("*").alias("registered_users"))


def active_users_count(counted: DataFrame) -> DataFrame:
    return counted.agg(F.count_distinct("username").alias("active_users"))


def data_returned(counted: DataFrame) -> DataFrame:
    """Size and number of records returned, as numbers and as display text."""
    sums = counted.agg(
        F.coalesce(F.sum("filesize"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("recordscount"), F.lit(0)).alias("records"),
    )
    return _size_columns(sums)


def _size_columns(sums: DataFrame) -> DataFrame:
    others = [c for c in sums.columns if c != "bytes"]
    return (
        sums.withColumn("gigabytes", S.gigabytes(F.col("bytes")))
        .withColumn("size_text", S.gigabytes_text(F.col("gigabytes")))
        .withColumn("records_text", S.grouped_digits(F.col("records")))
        .select(*others, "gigabytes", "size_text", "records_text")
    )


def jobs_by_family(counted: DataFrame) -> DataFrame:
    """Jobs per dataset family; jobs without a database name are left out."""
    named = counted.select(dataset_family(F.col("database")).alias("family"))
    return named.filter("family IS NOT NULL").groupBy("family").agg(F.count("*").alias("jobs"))


def active_user_profiles(counted: DataFrame, site_users: DataFrame) -> DataFrame:
    """Profile of each active user, from the other source; users without one are left out."""
    active = counted.select("username").distinct()
    profiles = first_by(
        site_users.select("username", "gender", "institution", "country", "is_student"),
        ["username"],
        ["institution", "country", "gender", "is_student"],
    )
    return active.join(profiles, "username")


def service_summary(
    counted: DataFrame, site_users: DataFrame, admins: Iterable[str] | DataFrame
) -> DataFrame:
    """Jobs, active users, records, size and registered users on one row.

    Jobs are summed per user first, so counts, sums and distinct users come from one pass.
    """
    per_user = counted.groupBy("username").agg(
        F.count("*").alias("jobs"),
        F.sum("filesize").alias("filesize"),
        F.sum("recordscount").alias("recordscount"),
    )
    registered = registered_users_count(site_users, admins)
    sums = per_user.agg(
        F.coalesce(F.sum("jobs"), F.lit(0)).alias("jobs"),
        F.count("*").alias("active_users"),
        F.coalesce(F.sum("recordscount"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("filesize"), F.lit(0)).alias("bytes"),
    )
    return _size_columns(sums).withColumn("registered_users", registered.scalar())
