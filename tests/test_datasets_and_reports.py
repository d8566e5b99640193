import datetime as dt

import pytest

from tallyforge import fixed_values as V
from tallyforge import schemas
from tallyforge.functions.period import Period
from tallyforge.plans import datasets, reconcile, report
from tallyforge.sources.files import read_roster
from tallyforge.sources.tables import legacy_users

from tests.conftest import rows_of, sorted_rows
from tests.test_directory_and_extract import extract
from tests.test_usage import QUARTER, events, small

PERIOD = Period.of("2024-01-01", "2024-01-15")
GB = 1024**3


def jobs(spark, *rows):
    typed = [
        (user, database, latest, dt.datetime.fromisoformat(at), size, records)
        for user, database, latest, at, size, records in rows
    ]
    return spark.createDataFrame(typed, schemas.DATASET_JOBS)


@pytest.fixture
def counted(spark):
    table = jobs(
        spark,
        ("ann", "x_multidark_1", True, "2024-01-01T00:00:00", GB, 1000),
        ("ann", "multidark_2", True, "2024-01-15T23:59:59", GB // 2, 2_000_000),
        ("bob", "vishnu_bolshoi", True, "2024-01-02T00:00:00", 0, 1),
        ("bob", "bolshoi_planck_z", True, "2024-01-02T00:00:00", 0, 1),
        ("bob", "bolshoi", True, "2024-01-02T00:00:00", 0, 1),
        ("bob", "mini_millennium", True, "2024-01-02T00:00:00", 0, 1),
        ("cat", "anything", True, "2024-01-02T00:00:00", None, None),
        ("cat", "", True, "2024-01-02T00:00:00", 0, 0),
        ("cat", None, True, "2024-01-02T00:00:00", 0, 0),
        ("cat", "bolshoi", False, "2024-01-02T00:00:00", GB, 1),
        ("admin", "bolshoi", True, "2024-01-02T00:00:00", GB, 1),
        (None, "bolshoi", True, "2024-01-02T00:00:00", GB, 1),
        ("ann", "bolshoi", True, "2024-01-16T00:00:00", GB, 1),
        ("ann", "bolshoi", True, "2023-12-31T23:59:59", GB, 1),
    )
    return datasets.counted_jobs(table, PERIOD, ["admin"])


@pytest.fixture
def site_users(spark):
    rows = [
        ("ann", 1, "Alpha", "AU", 0), ("ann", 1, "Beta", "NZ", 0), ("bob", 0, "Beta", "NZ", 1),
        ("admin", 0, "Alpha", "AU", 0), ("zed", 0, "Alpha", "AU", 0),
    ]
    return spark.createDataFrame(rows, schemas.SITE_USERS)


def test_dataset_counts(counted, site_users):
    assert datasets.jobs_count(counted).first()[0] == 9
    assert datasets.active_users_count(counted).first()[0] == 3
    assert datasets.registered_users_count(site_users, ["admin"]).first()[0] == 4
    assert rows_of(datasets.data_returned(counted)) == [
        (2001004, 1.5, "1.500 GB", "2,001,004")
    ]


def test_dataset_families(counted):
    assert dict(rows_of(datasets.jobs_by_family(counted))) == {
        "Bolshoi": 1, "Bolshoi Planck": 1, "Millennium": 1, "Multidark": 2, "Ready-Made": 1,
        "Vishnu Bolshoi": 1,
    }


def test_profiles_are_one_per_user(counted, site_users):
    assert sorted_rows(datasets.active_user_profiles(counted, site_users)) == [
        ("ann", 1, "Alpha", "AU", 0), ("bob", 0, "Beta", "NZ", 1),
    ]


def test_no_jobs_at_all(spark, site_users):
    none = datasets.counted_jobs(jobs(spark), PERIOD, [])
    assert rows_of(datasets.data_returned(none)) == [(0, 0.0, "0.000 GB", "0")]
    parts = report.dataset_sections(1, none, site_users, [], PERIOD)
    assert [r.value for r in report.in_order(report.report_rows(parts)).collect()] == [
        "0", "0", "0", "0.000 GB", "5",
    ]


def test_dataset_sections(counted, site_users):
    parts = report.dataset_sections(6, counted, site_users, ["admin"], PERIOD, service="catalogue")
    rows = report.in_order(report.report_rows(parts)).collect()
    assert [(r.label, r.value) for r in rows[:6]] == [
        ("Number of jobs", "9"), ("Number of active users", "3"),
        ("Total records returned", "2,001,004"), ("Total data-size returned", "1.500 GB"),
        ("Registered users", "4"), ("Multidark", "2"),
    ]
    assert rows[0].section == "General catalogue Usage (total for 01/01/2024 to 15/01/2024)"
    assert rows[5].section == "General Data access breakdown per database (01/01/2024 to 15/01/2024)"


def test_reconciliation(spark, tmp_path):
    (tmp_path / "list").write_text(
        "ann SUT - F N\n\n  bob Beta x  M Y \ncat MON - F N\ndan ZZZ - - N\neve MEL - M Q\nzed SUT - M N\n"
    )
    roster = read_roster(spark, str(tmp_path / "list"))
    known = legacy_users(
        spark.createDataFrame(
            [(1, "ann", 0, 1), (2, "bob", 0, 2), (3, "cat", 0, 2), (4, "dan", 0, 0), (5, "eve", 1, None)],
            schemas.LEGACY_USERS,
        ),
        spark.createDataFrame(
            [(1, "Swinburne"), (2, "Beta"), (3, "UM"), (4, "late")], schemas.LEGACY_INSTITUTIONS
        ),
        spark.createDataFrame(
            [(1, 1), (2, 2), (3, 2), (4, 3), (5, 3), (1, 4)], schemas.LEGACY_USER_INSTITUTIONS
        ),
    )
    matches = reconcile.user_matches(roster, known)
    assert sorted_rows(matches) == [
        ("ann", True, True, True, True), ("bob", True, False, True, True),
        ("cat", True, True, False, False), ("dan", True, True, False, True),
        ("eve", True, False, True, False), ("zed", False, None, None, None),
    ]
    assert rows_of(reconcile.summary(matches)) == [(6, 5, 2, 2, 2)]
    table = spark.createDataFrame(list(V.INSTITUTION_CODES.items()), "code string, mapped_code string")
    assert sorted_rows(reconcile.user_matches(roster, known, table)) == sorted_rows(matches)


def test_event_report_in_order(spark, make_directory, make_events, tmp_path):
    rows = report.event_report(events(make_events), small(make_directory), QUARTER, home="Alpha")
    ordered = [(r.section_no, r.label, r.value, r.active_value) for r in report.in_order(rows).collect()]
    assert ordered == [
        (1, "Alpha", "40.0%", None), (1, "Beta", "30.0%", None), (1, "Gamma", "25.0%", None),
        (2, "All", "4", "4"), (2, "Male", "1", "1"), (2, "Female", "1", "1"),
        (2, "PhD Student", "1", "1"), (2, "Alpha", "2", "2"),
        (3, "Beta", "2", None), (3, "Alpha", "1", None),
        (4, "p001", "70.0%", None), (4, "p002_big", "-", None),
        (5, "Female:Male:None", "40:60:0", None), (5, "Staff:Student", "45:55", None),
        (5, "Astronomy:Non-astronomy", "65:35", None), (5, "Other:National Astronomy", "55:45", None),
    ]
    assert rows.schema.names == schemas.REPORT.names
    report.write_report(rows, str(tmp_path / "rows"), "csv")
    assert spark.read.csv(str(tmp_path / "rows")).count() == len(ordered)

    report.write_report_text(rows, str(tmp_path / "text"))
    text = [
        line
        for part in sorted((tmp_path / "text").glob("part-*"))
        for line in part.read_text().splitlines()
    ]
    assert len(text) == len(ordered) + 5
    assert text[0] == "Usage by Institution: "
    assert text[1] == f"{'Alpha':100s} 40.0% "
    assert "All:           4/4 " in text
    assert f"{'Beta':70s}     2 " in text
    assert f"{'p002_big':50s} - " in text
    assert "Female/Male/None 40/60/0 " in text


def test_extract_report(spark, make_directory):
    table = extract(spark, ("ann", "oz1", 30), ("ann", "root", 500), ("bob", "oz1", 70))
    rows = report.in_order(report.extract_report(table, small(make_directory), home="Alpha")).collect()
    found = [(r.section_no, r.label, r.value, r.active_value) for r in rows]
    assert found[:2] == [(1, "Gamma", "70.0%", None), (1, "Beta", "30.0%", None)]
    assert (4, "oz1", "100.0%", None) in found
    assert (5, "gender", "Male:  70.0%", None) in found


def test_fiscal_quarters():
    assert Period.fiscal_quarter(1, 2017) == Period.of("2017-07-01", "2017-09-30")
    assert Period.fiscal_quarter(2, 2017) == Period.of("2017-10-01", "2017-12-31")
    assert Period.fiscal_quarter(3, 2016) == Period.of("2016-01-01", "2016-03-31")
    assert Period.fiscal_quarter(4, 2017) == Period.of("2017-04-01", "2017-06-30")
    assert Period.last_completed(dt.date(2019, 4, 1)) == Period.of("2019-01-01", "2019-03-31")
    assert Period.last_completed(dt.date(2019, 3, 31)) == Period.of("2018-10-01", "2018-12-31")
    assert Period.last_completed(dt.date(2019, 12, 31)) == Period.of("2019-07-01", "2019-09-30")
