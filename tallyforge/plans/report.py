"""Quarterly reports as ordered, labelled rows and as fixed-width text.

Rows are ordered by section, then by descending ``order_key``, then by label.  The order is part of
the data, so a report of any length is sorted in parallel and no section is numbered in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions.period import Period
from tallyforge.operators.attribution import activity_rollup, usage_of
from tallyforge.operators.directory import Directory
from tallyforge.operators.materialize import materialize
from tallyforge.plans import datasets, event_path, extract_path, user_counts


def section(
    number: int,
    title: str,
    rows: DataFrame,
    order_key: Column,
    label: Column,
    value: Column,
    active_value: Column | None = None,
) -> DataFrame:
    """Rows of one section in the report schema."""
    return rows.select(
        F.lit(number).alias("section_no"),
        F.lit(title).alias("section"),
        order_key.cast("double").alias("order_key"),
        label.alias("label"),
        value.alias("value"),
        (F.lit(None).cast("string") if active_value is None else active_value).alias("active_value"),
    )


def report_rows(sections: Iterable[DataFrame]) -> DataFrame:
    """One report of several sections."""
    return reduce(DataFrame.unionByName, sections)


def in_order(report: DataFrame) -> DataFrame:
    """The reading order, a range sort over all rows."""
    return report.orderBy("section_no", F.desc_nulls_last("order_key"), "label")


def _account_holders(number: int, lines: DataFrame) -> DataFrame:
    return section(
        number, V.TITLE_ACCOUNT_HOLDERS, lines, -F.col("line"), F.col("label"),
        F.col("total").cast("string"), F.col("active").cast("string"),
    )


def _percentages(number: int, title: str, rows: DataFrame, label: str, key: Column) -> DataFrame:
    return section(number, title, rows, key, F.col(label), F.col("percentage_text"))


def joined_groups(demographic: DataFrame) -> DataFrame:
    """One row per criterion: its group names and percentages, each joined by colons.

    A criterion has at most the labels of its code table, so the lists are bounded.
    """
    pairs = F.array_sort(
        F.collect_list(
            F.struct("position", F.coalesce("grp", F.lit("")).alias("grp"), "residual_pct")
        )
    )
    lists = demographic.groupBy("criterion_no", "criterion").agg(pairs.alias("pairs"))
    return lists.select(
        "criterion_no",
        "criterion",
        F.array_join(F.col("pairs.grp"), ":").alias("groups"),
        F.array_join(F.col("pairs.residual_pct").cast("array<string>"), ":").alias("percentages"),
    )


def dataset_sections(
    first_number: int,
    counted: DataFrame,
    site_users: DataFrame,
    admins: Iterable[str] | DataFrame,
    period: Period,
    service: str = "dataset service",
) -> list[DataFrame]:
    """General usage and the breakdown by family of the dataset service."""
    start, end = period.display()
    totals = datasets.service_summary(counted, site_users, admins)
    lines = F.array(
        *[
            F.struct(F.lit(-i).alias("line"), F.lit(label).alias("label"), value.alias("value"))
            for i, (label, value) in enumerate(
                (
                    (V.LABEL_JOBS, F.col("jobs").cast("string")),
                    (V.LABEL_ACTIVE_USERS, F.col("active_users").cast("string")),
                    (V.LABEL_RECORDS, F.col("records_text")),
                    (V.LABEL_SIZE, F.col("size_text")),
                    (V.LABEL_REGISTERED, F.col("registered_users").cast("string")),
                ),
                1,
            )
        ]
    )
    usage = section(
        first_number,
        V.TITLE_DATASET_USAGE.format(service=service, start=start, end=end),
        totals.select(F.inline(lines)),
        F.col("line"), F.col("label"), F.col("value"),
    )
    families = section(
        first_number + 1,
        V.TITLE_DATASET_FAMILIES.format(start=start, end=end),
        datasets.jobs_by_family(counted),
        F.col("jobs"), F.col("family"), F.col("jobs").cast("string"),
    )
    return [usage, families]


@dataclass(frozen=True)
class DatasetService:
    """What a report needs to know of the dataset service."""

    jobs: DataFrame
    site_users: DataFrame
    admins: Iterable[str] | DataFrame
    period: Period
    name: str = "dataset service"

    def sections(self, first_number: int) -> list[DataFrame]:
        counted = datasets.counted_jobs(self.jobs, self.period, self.admins)
        return dataset_sections(first_number, counted, self.site_users, self.admins, self.period, self.name)


def event_report(
    events: DataFrame,
    directory: Directory,
    period: Period,
    home: str = "Home department",
    other_than: str | None = None,
    service: DatasetService | None = None,
) -> DataFrame:
    """The report of the event system, with the sections of the dataset service if one is given.

    The events are read once, for one rollup; the directory tables are joined once, for one frame of
    affiliations; and usage is attributed to affiliations once, for the sections by institution and
    by demographic group.  All three are written to the shared folder.  ``other_than`` leaves one
    institution out of the section of other institutions.
    """
    directory = directory.prepared()
    rollup = materialize(activity_rollup(events, period), "rollup")
    usage = usage_of(rollup)
    attributed = materialize(event_path.attributed_usage(usage, directory), "attributed")
    active = rollup.select(F.col("user").alias("username")).distinct()
    persons = event_path.attributed_by_person(attributed, usage)
    groups = joined_groups(event_path.percent_by_demographic(persons))
    return report_rows(
        [
            _percentages(
                1, V.TITLE_INSTITUTION_USAGE, event_path.attributed_by_institution(attributed, usage),
                "institution", F.col("percentage"),
            ),
            _account_holders(2, user_counts.account_holders_of(directory, active, home=home)),
            section(
                3, V.TITLE_ASTRONOMERS.format(home=home),
                user_counts.astronomers_by_department(directory, other_than),
                F.col("users"), F.col("institution"), F.col("users").cast("string"),
            ),
            _percentages(
                4, V.TITLE_PROJECT_USAGE, event_path.percent_by_project(usage, directory),
                "code", F.lit(0),
            ),
            section(
                5, V.TITLE_DEMOGRAPHIC, groups,
                -F.col("criterion_no"), F.col("groups"), F.col("percentages"),
            ),
            *(service.sections(6) if service else []),
        ]
    )


def extract_report(
    extract: DataFrame,
    directory: Directory,
    home: str = "Home department",
    discarded: Iterable[str] = V.DISCARDED_ACCOUNTS,
    other_than: str | None = None,
    service: DatasetService | None = None,
) -> DataFrame:
    """The report of the extract system, sharing its directory as ``event_report`` does."""
    directory = directory.prepared()
    charged = materialize(extract_path.charged_usage(extract, discarded), "charged")
    demographic = extract_path.percent_by_demographic(charged, directory)
    group_text = F.format_string("%s:  %s%%", "grp", F.col("percentage").cast("string"))
    return report_rows(
        [
            _percentages(
                1, V.TITLE_INSTITUTION_USAGE, extract_path.percent_by_institution(charged, directory),
                "institution", F.col("percentage"),
            ),
            _account_holders(2, extract_path.account_holders(charged, directory, home=home)),
            section(
                3, V.TITLE_ASTRONOMERS.format(home=home),
                extract_path.astronomers_by_institution(directory, other_than),
                F.col("users"), F.col("institution"), F.col("users").cast("string"),
            ),
            _percentages(
                4, V.TITLE_PROJECT_USAGE, extract_path.percent_by_project(charged, directory),
                "code", F.lit(0),
            ),
            section(
                5, V.TITLE_DEMOGRAPHIC, demographic,
                -F.col("criterion_no"), F.col("criterion"), group_text,
            ),
            *(service.sections(6) if service else []),
        ]
    )


# Title of a section up to its first blank to fill in, label width, value width.  The
# account table and the demographic groups have formats of their own.
TEXT_LAYOUTS = (
    (V.TITLE_INSTITUTION_USAGE, 100, ""),
    (V.TITLE_ASTRONOMERS, 70, 5),
    (V.TITLE_PROJECT_USAGE, 50, ""),
    (V.TITLE_DATASET_USAGE, 50, ""),
    (V.TITLE_DATASET_FAMILIES, 50, ""),
)
# Joined groups are parted by a bare colon; one before a blank belongs to the text.
_JOINED = ":(?! )"


def _titled(template: str) -> Column:
    """Sections under a title, whatever fills its blanks; the numbers of sections don't matter."""
    parts = re.split(r"\{\w+\}", template)
    return F.col("section").rlike("^" + ".*".join(map(re.escape, parts)) + "$")


def report_text(report: DataFrame) -> DataFrame:
    """Fixed-width lines, with the columns that order them, for the sections of every report."""
    label, value = F.coalesce("label", F.lit("")), F.coalesce("value", F.lit(""))
    line = F.when(
        _titled(V.TITLE_ACCOUNT_HOLDERS),
        F.format_string("%-15s%s/%s ", F.concat(label, F.lit(":")), value, "active_value"),
    )
    for title, width, value_width in TEXT_LAYOUTS:
        line = line.when(_titled(title), F.format_string(f"%-{width}s %{value_width}s ", label, value))
    slashed = F.format_string(
        "%s %s ", F.regexp_replace(label, _JOINED, "/"), F.regexp_replace(value, _JOINED, "/")
    )
    return report.select("section_no", "order_key", "label", line.otherwise(slashed).alias("line"))


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the rows in reading order as ``parquet`` or ``csv``."""
    in_order(report).write.mode("overwrite").format(fmt).save(path)


def write_report_text(report: DataFrame, path: str) -> None:
    """Write the lines in reading order, each section under its title.

    The files of the folder, taken by name, hold the report in order.  The rows are written once
    before, as both lines and titles are taken from them.
    """
    report = materialize(report, "report")
    lines = report_text(report).select("section_no", F.lit(1).alias("part"), "order_key", "label", "line")
    titles = report.select("section_no", "section").distinct().select(
        "section_no",
        F.lit(0).alias("part"),
        F.lit(None).cast("double").alias("order_key"),
        F.lit(None).cast("string").alias("label"),
        F.concat("section", F.lit(": ")).alias("line"),
    )
    ordered = lines.unionByName(titles).orderBy(
        "section_no", "part", F.desc_nulls_last("order_key"), "label"
    )
    ordered.select(F.col("line").alias("value")).write.mode("overwrite").text(path)
