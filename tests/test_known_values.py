"""Counts known beforehand for the smallest given tables, independent of query and twin."""

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.events import parse_events
from tallyforge.functions.labels import gender_label
from tallyforge.functions.shares import percent
from tallyforge.operators.attribution import finished_usage
from tallyforge.plans import event_path
from verification.registry import QUERIES
from verification.views import PERIOD, Views

VIEW_ROWS = {
    "institutions": 25, "departments": 50, "users": 150, "user_systems": 175, "affiliations": 194,
    "projects": 10, "project_users": 1444, "events": 6000, "usage_extract": 104, "dataset_jobs": 1000,
    "site_users": 150, "roster": 150, "file_listing": 25, "file_ledger": 18, "log_lines": 6000,
}


@pytest.fixture
def views(spark, given):
    if not given.endswith("sf0.001"):
        pytest.skip("values are those of sf0.001")
    return Views(spark, given)


def result(views, name):
    return QUERIES[name](views.spark, views.folder)


def test_view_rows(views):
    assert {name: getattr(views, name)().count() for name in VIEW_ROWS} == VIEW_ROWS


def test_usage_in_the_period(views):
    assert finished_usage(views.events(), PERIOD).count() == 106
    assert result(views, "use_total").first()[0] == 2777.0


def test_account_holders(views):
    first = result(views, "rpt_account_holders").filter("line = 1").first()
    assert (first.total, first.active) == (82, 67)


def test_residual_by_gender_of_plain_user_sums(views):
    """The rule on usage by user, before affiliations count a job more than once."""
    sums = event_path.usage_by_user(finished_usage(views.events(), PERIOD))
    users = views.users().select(F.col("username").alias("user"), gender_label(F.col("gender")).alias("gender"))
    same = [F.lit("x").alias(c) for c in ("institution", "student", "is_astronomy", "is_australia")]
    persons = sums.join(users, "user").select(
        F.col("user").alias("username"), "gender", *same,
        percent(F.col("units"), F.lit(2777), 2).alias("percentage"),
    )
    rows = event_path.percent_by_demographic(persons).filter("criterion = 'gender'")
    assert [(r.grp, r.residual_pct) for r in rows.orderBy("position").collect()] == [
        ("Male", 38), ("None", 62), ("Female", 0),
    ]


def test_file_plan(views):
    states = result(views, "snk_ledger_plan").groupBy("state").count()
    assert dict(tuple(r) for r in states.collect()) == {"changed": 12, "new": 7, "unchanged": 6}


def test_roster(views):
    row = result(views, "rec_summary").first()
    assert (row.roster_users, row.found_users, row.student_mismatches, row.gender_mismatches) == (
        150, 142, 8, 13,
    )


def test_accepted_log_lines(views):
    assert parse_events(views.log_lines()).count() == 2680
