"""Projects whose members come from several countries or several national institutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.operators.directory import Directory, labelled_users


def project_members(directory: Directory, system_id: int = V.EVENT_SYSTEM) -> DataFrame:
    """Project code and username of each membership of a system's projects."""
    projects = directory.projects.filter(F.col("system_id") == system_id).select(
        F.col("id").alias("project_id"), F.col("code").alias("project_code")
    )
    users = directory.users.select(F.col("id").alias("user_id"), "username")
    return (
        directory.project_users.join(projects, "project_id")
        .join(users, "user_id")
        .select("project_code", "username")
    )


def _several(value: Column) -> Column:
    """More than one distinct value, nulls aside: the smallest differs from the largest.

    Two mergeable values per project in place of a set of all its members' values.
    """
    return F.coalesce(F.min(value) < F.max(value), F.lit(False))


def by_project(directory: Directory) -> DataFrame:
    """Each project with members; one whose members have no profile is neither kind.

    Members are first counted by project, institution and country, an aggregate by hash that combines
    before its shuffle.  The smallest and largest values, which need sorted rows, are then taken of a
    few combinations a project, not of all its members.
    """
    profiles = labelled_users(directory, V.EVENT_SYSTEM).select("username", "institution", "country")
    rows = project_members(directory).join(profiles, "username", "left")
    rows = rows.groupBy("project_code", "institution", "country").agg(F.count("institution").alias("members"))
    national = F.when(F.col("country") == V.NATIONAL_COUNTRY, F.col("institution"))
    return rows.groupBy("project_code").agg(
        F.sum("members").alias("members_with_profile"),
        _several(F.col("country")).alias("international"),
        _several(national).alias("several_national_institutions"),
    )


def summary(projects: DataFrame) -> DataFrame:
    """Counts of both kinds and their share of all projects with members."""
    total = F.count("*")
    national = F.count_if(F.col("several_national_institutions"))
    international = F.count_if(F.col("international"))
    return projects.agg(
        total.alias("projects"),
        national.alias("several_national"),
        F.try_divide(national * F.lit(100.0), total).alias("several_national_pct"),
        international.alias("international"),
        F.try_divide(international * F.lit(100.0), total).alias("international_pct"),
    )
