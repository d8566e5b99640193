import datetime as dt
from decimal import Decimal

import pytest

from tallyforge import schemas
from tallyforge.functions.events import parse_events
from tallyforge.operators import directory as dirs
from tallyforge.operators.filters import all_of
from tallyforge.plans import collaboration, extract_path
from tallyforge.sources.files import read_usage_extract, usage_extract_rejects
from tallyforge.sources.tables import JdbcSource, ParquetSource, load_events, load_table

from tests.conftest import rows_of, sorted_rows
from tests.test_event_lines import line, lines
from tests.test_usage import small

D = dt.date


def extract(spark, *rows):
    typed = [("c1", login, login, account, Decimal(str(used)), 0.0) for login, account, used in rows]
    return spark.createDataFrame(typed, schemas.USAGE_EXTRACT)


def usage(spark):
    return extract_path.charged_usage(
        extract(
            spark, ("ann", "oz1", 30), ("ann", "hpcadmin", 500), ("bob", "oz1", 20),
            ("ghost", "oz9", 40), ("bob", None, 10), ("root", "root", 1), ("tess", "testers", 1),
        )
    )


def test_latest_affiliation_is_an_open_row_and_ties_go_to_the_smaller_department(make_directory):
    directory = small(
        make_directory,
        affiliations=[
            (1, 8, D(1997, 1, 1), None), (1, 6, D(1997, 1, 1), None),
            (1, 7, D(1996, 1, 1), None),
            (2, 9, D(1997, 5, 1), D(1997, 6, 1)), (2, 6, D(1997, 5, 1), None),
            (4, 6, D(1997, 5, 1), D(1997, 6, 1)),
        ],
    )
    current = extract_path.current_affiliations(directory)
    assert sorted_rows(current.select("username", "department_id")) == [("ann", 6), ("bob", 6)]


def test_labels(make_directory):
    users = dirs.labelled_users(small(make_directory), 2)
    assert sorted_rows(users) == [
        ("ann", "Ann One", "Female", "Staff", "Astronomy", "Beta", "NZ", "Other"),
        ("bob", "Bob Two", "Male", "Student", "Non-astronomy", "Gamma", None, "Other"),
        ("dan", "Four", "Male", "Staff", "Astronomy", "Beta", "NZ", "Other"),
    ]


def test_projects(make_directory):
    assert rows_of(dirs.projects_with_admin(small(make_directory))) == [
        ("oz1", "", "R", None), ("p001", "", "P", "ann@x"), ("p002", "big", "Q", "bob@x"),
    ]


def test_filters_take_only_known_columns():
    with pytest.raises(ValueError, match="not a filter column: end_date; drop"):
        all_of([("gender", 1), ("end_date; drop", 1)])


def test_discarded_accounts_and_total(spark):
    assert rows_of(extract_path.total_usage(usage(spark))) == [(100.0,)]
    nothing = extract_path.charged_usage(extract(spark))
    assert rows_of(extract_path.total_usage(nothing)) == [(0.0,)]


def test_extract_projects(spark, make_directory):
    directory = small(
        make_directory,
        projects=[(1, "oz1", "A", 1, 2), (2, "OZ2", "B", 1, 2), (3, "oz9", "C", 1, 1), (4, "p1", "D", 1, 2)],
    )
    shares = extract_path.percent_by_project(usage(spark), directory)
    assert rows_of(shares) == [("OZ2", None, "-"), ("oz1", 50.0, "50.0%")]


def test_extract_institutions_keep_zero_and_lose_unknown_logins(spark, make_directory):
    shares = extract_path.percent_by_institution(usage(spark), small(make_directory))
    # ann and dan are now at Beta, bob at Gamma; ghost's 40 is in the total only.
    assert rows_of(shares) == [("Beta", 30.0, "30.0%"), ("Gamma", 30.0, "30.0%")]
    idle = extract_path.charged_usage(extract(spark, ("ann", "oz1", 1)))
    assert ("Gamma", 0.0, "0.0%") in rows_of(
        extract_path.percent_by_institution(idle, small(make_directory))
    )


def test_extract_demographic_has_no_third_gender_row(spark, make_directory):
    directory = small(make_directory, user_systems=[(1, 2), (2, 2), (3, 2)])
    rows = extract_path.percent_by_demographic(usage(spark), directory).orderBy("criterion_no", "grp")
    assert rows_of(rows.drop("criterion_no")) == [
        ("gender", "Female", 30.0), ("gender", "Male", 30.0),
        ("student", "Staff", 30.0), ("student", "Student", 30.0),
        ("is_astronomy", "Astronomy", 30.0), ("is_astronomy", "Non-astronomy", 30.0),
        ("is_australia", "National Astronomy", 0.0), ("is_australia", "Other", 60.0),
    ]


def test_extract_counts_agree_with_the_one_pass_table(spark, make_directory):
    directory = small(
        make_directory,
        affiliations=[
            (1, 6, D(1997, 1, 1), None), (1, 8, D(1997, 1, 1), None), (2, 6, D(1997, 1, 1), None),
            (3, 6, D(1997, 1, 1), None), (4, 6, D(1996, 1, 1), D(1997, 1, 1)),
        ],
    )
    charged = usage(spark)
    table = extract_path.account_holders(charged, directory).orderBy("line")
    found = {r.label: (r.total, r.active) for r in table.collect()}
    wanted = {
        "All": [("is_astronomy", 1)],
        "Male": [("is_astronomy", 1), ("gender", 0)],
        "Female": [("is_astronomy", 1), ("gender", 1)],
        "PhD Student": [("is_astronomy", 1), ("is_student", 1)],
    }
    for label, pairs in wanted.items():
        total = extract_path.users_count(directory, pairs).first()[0]
        active = extract_path.active_users_count(charged, directory, pairs).first()[0]
        assert found[label] == (total, active)
    assert found["Female"] == (1, 2)  # one woman with two affiliations
    assert found["Home department"] == (
        extract_path.department_users_count(directory).first()[0],
        extract_path.department_active_count(charged, directory).first()[0],
    ) == (3, 2)
    nobody = extract_path.charged_usage(extract(spark))
    assert extract_path.active_users_count(nobody, directory).first()[0] == 0
    assert rows_of(extract_path.astronomers_by_institution(directory)) == [("Alpha", 2)]


def test_collaboration_ignores_missing_countries_and_counts_projects_without_profiles(make_directory):
    directory = small(
        make_directory,
        institutions=[(1, "Alpha", "AU"), (2, "Beta", "NZ"), (3, "Gamma", None), (4, "Delta", "AU")],
        departments=[(6, 1, "A", 1), (8, 2, "B", 1), (9, 3, "C", 0), (10, 4, "D", 0)],
        users=[(i, f"u{i}", "f", "l", None, 0, 0) for i in range(1, 6)],
        user_systems=[(i, 1) for i in range(1, 5)],
        affiliations=[(i, d, D(1997, 1, 1), None) for i, d in [(1, 6), (2, 8), (3, 9), (4, 10)]],
        projects=[(i, f"p{i}", "P", 1, 1) for i in range(1, 5)] + [(9, "oz", "P", 1, 2)],
        project_users=[
            (1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 2, 3), (5, 3, 1), (6, 3, 4), (7, 4, 5), (8, 9, 1),
        ],
    )
    projects = collaboration.by_project(directory)
    assert sorted_rows(projects) == [
        ("p1", 2, True, False), ("p2", 2, False, False), ("p3", 2, False, True),
        ("p4", 0, False, False),
    ]
    assert rows_of(collaboration.summary(projects)) == [(4, 1, 25.0, 1, 25.0)]


def test_extract_file(spark, tmp_path):
    (tmp_path / "use.txt").write_text("c1|ann|Ann One|oz1|12.5|3\nc1|bob|Bob|oz2|0.000001|\n")
    rows = rows_of(read_usage_extract(spark, str(tmp_path)))
    assert rows == [
        ("c1", "ann", "Ann One", "oz1", Decimal("12.500000"), 3.0),
        ("c1", "bob", "Bob", "oz2", Decimal("0.000001"), None),
    ]


def test_unreadable_extract_lines_are_not_lost(spark, tmp_path):
    bad = ["c1|ann|Ann|oz1|much|3", "c1|bob|Bob|oz1", "c1|cy|Cy|oz1|1e40|", "c1|di|Di|oz1||3"]
    (tmp_path / "use.txt").write_text("\n".join(["c1|eve|Eve|oz1|0.0000001|3", *bad]))
    with pytest.raises(Exception, match="unreadable line of the usage extract"):
        read_usage_extract(spark, str(tmp_path)).collect()
    kept = read_usage_extract(spark, str(tmp_path), strict=False).collect()
    assert [(r["login"], r["used"]) for r in kept] == [("eve", Decimal("0.0000001"))]
    assert sorted(r["login"] for r in usage_extract_rejects(spark, str(tmp_path)).collect()) == ["ann", "bob", "cy", "di"]


def test_fact_table_needs_a_partition_column(spark):
    with pytest.raises(ValueError, match="partition column"):
        load_events(spark, JdbcSource("jdbc:none"))


def test_relational_event_table(spark, tmp_path):
    parsed = parse_events(lines(spark, line()))
    as_stored = parsed.withColumnRenamed("event_id", "ID").drop("cpu_seconds")
    as_stored.write.parquet(str(tmp_path / "job_event"))
    loaded = load_events(spark, ParquetSource(str(tmp_path)))
    assert loaded.schema.simpleString() == schemas.EVENT.simpleString()
    assert rows_of(loaded) == rows_of(parsed)


def test_directory_from_parquet(spark, tmp_path, make_directory):
    directory = small(make_directory)
    for attribute, (name, _) in dirs.TABLES.items():
        getattr(directory, attribute).write.parquet(str(tmp_path / f"my_{name}"))
    loaded = dirs.Directory.load(spark, ParquetSource(str(tmp_path)), prefix="my_")
    assert sorted_rows(dirs.memberships(loaded, 1)) == sorted_rows(dirs.memberships(directory, 1))
    raw = load_table(spark, "my_user", ParquetSource(str(tmp_path)))
    assert raw.count() == 4
    with pytest.raises(AttributeError):
        loaded.nothing
