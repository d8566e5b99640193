"""A user with a third of all events spreads over tasks, without help from adaptive execution."""

import re

import pytest
from pyspark.sql import functions as F

from tallyforge import schemas
from tallyforge.operators.attribution import affiliation_at_event, valid_at
from tallyforge.operators.directory import TABLES, Directory, affiliation_frame, memberships
from tallyforge.plans import report
from tallyforge.sources.tables import ParquetSource

from tests.conftest import sorted_rows
from tests.test_datasets_and_reports import PERIOD, jobs, site_users  # noqa: F401
from tests.test_directory_and_extract import extract
from tests.test_usage import QUARTER, events, small


@pytest.fixture
def busy(spark):
    """30,000 events over 90 days, every third one of the same user, in the same month and at the same hour."""
    third = F.col("id") % 3 == 0
    return spark.range(0, 30_000, 1, 6).select(
        "id",
        F.when(third, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("user"),
        F.when(third, F.lit("1997-08-10 10:00:00").cast("timestamp_ntz")).otherwise(
            F.timestamp_add("HOUR", (F.col("id") % 2160).cast("int"), F.lit("1997-07-01 00:00:00").cast("timestamp_ntz"))
        ).alias("time"),
    )


@pytest.fixture
def dated(spark):
    rows = [(f"u{i}", d, start, end) for i in range(0, 500, 2) for d, start, end in ((1, "1997-01-01", "1997-08-10"), (2, "1997-08-10", None))]
    rows += [("hot", 1, "1997-01-01", None), ("hot", 2, "1997-08-10", "1997-08-11"), ("hot", 3, "1997-08-11", None), ("gone", 1, "1990-01-01", "1991-01-01")]
    frame = spark.createDataFrame(rows, "username string, department_id int, start_date string, end_date string")
    return frame.select("username", "department_id", F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date"))


@pytest.mark.parametrize("hot_rows", [500, 1_000_000])
def test_same_as_a_join_by_user(spark, busy, dated, hot_rows):
    plain = busy.join(dated.withColumnRenamed("username", "user"), "user")
    plain = plain.filter(valid_at(F.col("time"), F.col("start_date"), F.col("end_date")))
    got = affiliation_at_event(busy, dated, hot_rows)
    assert got.columns == plain.columns
    assert sorted_rows(got.select("id", "department_id")) == sorted_rows(plain.select("id", "department_id"))


def test_the_hot_user_is_dealt_over_tasks(spark, busy, dated):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        counts = {}
        for hot_rows in (100, 1_000_000):
            joined = affiliation_at_event(busy, dated, hot_rows)
            rows = joined.groupBy(F.spark_partition_id()).count().collect()
            counts[hot_rows] = sorted(r["count"] for r in rows)
        assert sum(counts[100]) == sum(counts[1_000_000])
        assert counts[1_000_000][-1] > 20_000  # the user's events, twice, in one task
        assert len(counts[100]) == 8 and counts[100][-1] < 2 * sum(counts[100]) / 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture
def stored_directory(spark, make_directory, tmp_path):
    directory = small(make_directory)
    for attribute, (name, _) in TABLES.items():
        getattr(directory, attribute).write.parquet(str(tmp_path / "tables" / name))
    return str(tmp_path / "tables")


def scans(df, folder):
    """How often each table of a folder is read in a plan."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")
    found = re.findall(rf"file:{re.escape(folder)}/(\w+)\]", text)
    return {name: found.count(name) for name in set(found)}


def test_a_prepared_directory_reads_each_table_once(spark, stored_directory):
    directory = Directory.load(spark, ParquetSource(stored_directory))
    once = {"user": 1, "department": 1, "institution": 1, "userdepartment": 1, "usersystem": 1}
    assert scans(affiliation_frame(directory, (1, 2)), stored_directory) == once
    prepared = directory.prepared()
    for system in (None, 1, 2):
        names = memberships(directory, system).columns
        assert sorted_rows(memberships(prepared, system).select(*names)) == sorted_rows(memberships(directory, system))
        assert scans(memberships(prepared, system), stored_directory) == {}


def test_reports_read_only_projects_beside_the_prepared_directory(spark, stored_directory, make_events):
    directory = Directory.load(spark, ParquetSource(stored_directory))
    rows = report.event_report(events(make_events), directory, QUARTER, home="Alpha")
    assert scans(rows, stored_directory) == {"project": 1}
    rows = report.extract_report(extract(spark, ("ann", "oz1", 30)), directory, home="Alpha")
    assert scans(rows, stored_directory) == {"project": 1}


def test_a_user_entered_twice_in_a_system_counts_twice(spark, make_directory):
    twice = small(make_directory, user_systems=[(1, 1), (1, 1), (2, 1)])
    names = ["user_id", "department_id"]
    assert sorted_rows(memberships(twice.prepared(), 1).select(*names)) == sorted_rows(memberships(twice, 1).select(*names))


def test_whole_reports_with_the_dataset_service(spark, make_directory, make_events, site_users, tmp_path):  # noqa: F811
    table = jobs(spark, ("ann", "x_multidark_1", True, "2024-01-02T00:00:00", 1024**3, 1000), ("root", "bolshoi", True, "2024-01-02T00:00:00", 1, 1))
    service = report.DatasetService(table, site_users, ["root"], PERIOD, "catalogue")
    whole = {
        "event": report.event_report(events(make_events), small(make_directory), QUARTER, "Alpha", "Alpha", service),
        "extract": report.extract_report(
            extract(spark, ("ann", "oz1", 30), ("bob", "oz1", 70)), small(make_directory), "Alpha", other_than="Alpha", service=service
        ),
    }
    for name, rows in whole.items():
        assert rows.schema.names == schemas.REPORT.names
        found = [(r.section_no, r.label, r.value) for r in report.in_order(rows).collect()]
        assert (6, "Number of jobs", "1") in found and (7, "Multidark", "1") in found
        assert not [f for f in found if f[:2] == (3, "Alpha")] and [f for f in found if f[0] == 3]
        report.write_report_text(rows, str(tmp_path / name))
        text = "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*"))).splitlines()
        assert "General catalogue Usage (total for 01/01/2024 to 15/01/2024): " in text
        assert f"{'Total data-size returned':50s} 1.000 GB " in text and f"{'Multidark':50s} 1 " in text
    lines = [r.line for r in report.report_text(whole["extract"]).collect()]
    assert "gender Male:  70.0% " in lines and f"{'oz1':50s} 100.0% " in lines
