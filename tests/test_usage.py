import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tallyforge.functions.period import Period
from tallyforge.operators.attribution import (
    activity_rollup,
    affiliation_at_event,
    daily_usage,
    finished_usage,
    usage_of,
)
from tallyforge.operators.residual import residual_percent
from tallyforge.operators.directory import memberships
from tallyforge.plans import event_path, user_counts

from tests.conftest import rows_of, sorted_rows

QUARTER = Period.of("1997-07-01", "1997-09-30")
D = dt.date


def small(make_directory, **more):
    tables = {
        "institutions": [(1, "Alpha", "AU"), (2, "Beta", "NZ"), (3, "Gamma", None)],
        "departments": [(6, 1, "A", 1), (7, 1, "A2", 0), (8, 2, "B", 1), (9, 3, "C", 0)],
        "users": [
            (1, "ann", "Ann", "One", "ann@x", 1, 0), (2, "bob", "Bob", "Two", "bob@x", 0, 1),
            (3, "cat", "Cat", "Three", None, 2, 0), (4, "dan", None, "Four", "dan@x", 0, 0),
        ],
        "user_systems": [(1, 1), (2, 1), (3, 1), (1, 2), (2, 2), (4, 2)],
        "affiliations": [
            (1, 6, D(1997, 1, 1), D(1997, 7, 31)), (1, 8, D(1997, 8, 1), None),
            (2, 6, D(1997, 1, 1), None), (2, 9, D(1997, 9, 1), None),
            (3, 7, D(1997, 1, 1), None), (4, 8, D(1997, 1, 1), None),
        ],
        "projects": [(1, "p001", "P", 1, 1), (2, "p002_big", "Q", 2, 1), (3, "oz1", "R", 3, 2)],
    }
    return make_directory(**{**tables, **more})


def events(make_events):
    return make_events(
        [
            ("ann", "p001", "1997-07-31T00:00:00", "JOBEND", 10),
            ("ann", "p001", "1997-07-31T00:00:01", "JOBEND", 20),
            ("ann", "p001", "1997-08-01T00:00:00", "JOBEND", 30),
            ("ann", "p001", "1997-08-01T05:00:00", "JOBSTART", 999),
            ("bob", "root", "1997-09-30T23:59:59", "JOBEND", 25),
            ("cat", None, "1997-07-01T00:00:00", "JOBEND", 5),
            (None, "p001", "1997-07-02T00:00:00", "JOBEND", 10),
            ("bob", "root", "1997-10-01T00:00:00", "JOBEND", 999),
            ("bob", "root", "1997-06-30T23:59:59", "JOBEND", 999),
            ("cat", "p009", "1997-08-01T00:00:00", "JOBSTART", 7),
        ]
    )


def test_last_day_counts_whole_and_other_types_do_not(make_events):
    usage = finished_usage(events(make_events), QUARTER)
    assert rows_of(event_path.total_usage(usage)) == [(100.0,)]


def test_empty_period_gives_zero_and_no_shares(make_directory, make_events):
    directory, empty = small(make_directory), Period.of("2001-01-01", "2001-03-31")
    none = finished_usage(events(make_events), empty)
    assert rows_of(event_path.total_usage(none)) == [(0.0,)]
    shares = event_path.percent_by_project(none, directory)
    assert sorted_rows(shares) == [("p001", None, "-"), ("p002_big", None, "-")]
    days = daily_usage(events(make_events), empty)
    assert rows_of(event_path.percent_by_institution(days, directory)) == []


def test_usage_by_account_keeps_a_missing_account(make_events):
    usage = finished_usage(events(make_events), QUARTER)
    by_account = event_path.usage_by_account(usage)
    assert rows_of(by_account) == [(None, 0.005), ("p001", 0.07), ("root", 0.025)]
    lines = [r["line"] for r in event_path.usage_by_account_text(by_account).collect()]
    assert lines[1] == "p001            0.070000 "


def test_percent_by_project(make_directory, make_events):
    usage = finished_usage(events(make_events), QUARTER)
    shares = event_path.percent_by_project(usage, small(make_directory))
    assert sorted_rows(shares) == [("p001", 70.0, "70.0%"), ("p002_big", None, "-")]


def test_institution_at_event_time(make_directory, make_events):
    """An end date is its first instant; the job one second later belongs to nobody."""
    days = daily_usage(events(make_events), QUARTER)
    shares = event_path.percent_by_institution(days, small(make_directory))
    # Alpha: ann at midnight 10, bob 25, cat 5.  Beta: ann 30.  Gamma: bob again, overlapping.
    assert rows_of(shares) == [
        ("Alpha", 40.0, "40.0%"), ("Beta", 30.0, "30.0%"), ("Gamma", 25.0, "25.0%"),
    ]


def test_rollup_gives_the_same_shares(make_directory, make_events):
    directory = small(make_directory)
    rollup = activity_rollup(events(make_events), QUARTER)
    for query in (event_path.percent_by_institution, event_path.percent_by_national_user):
        days = daily_usage(events(make_events), QUARTER)
        assert rows_of(query(usage_of(rollup), directory)) == rows_of(query(days, directory))
    assert rollup.filter("user = 'cat'").count() == 2


def test_national_users(make_directory, make_events):
    days = daily_usage(events(make_events), QUARTER)
    shares = event_path.percent_by_national_user(days, small(make_directory))
    assert rows_of(shares) == [
        ("Bob Two", "Alpha", "bob", 25.0), ("Ann One", "Alpha", "ann", 10.0),
    ]


def test_demographic_residual(make_directory, make_events):
    days = daily_usage(events(make_events), QUARTER)
    persons = event_path.percent_by_person(days, small(make_directory))
    rows = event_path.percent_by_demographic(persons).orderBy("criterion_no", "position")
    found = [(r.criterion, r.grp, r.share, r.residual_pct) for r in rows.collect()]
    # ann 30 at Beta and 10 at Alpha, bob 25 at Alpha and 25 at Gamma, cat 5.
    assert found == [
        ("gender", "Female", 40.0, 40), ("gender", "Male", 50.0, 60), ("gender", "None", 5.0, 0),
        ("student", "Staff", 45.0, 45), ("student", "Student", 50.0, 55),
        ("is_astronomy", "Astronomy", 65.0, 65), ("is_astronomy", "Non-astronomy", 30.0, 35),
        ("is_australia", "Other", 55.0, 55), ("is_australia", "National Astronomy", 40.0, 45),
    ]


def test_residual_rule_cases(spark):
    def percents(*shares):
        rows = [("c", f"g{i}", Decimal(str(s)), i) for i, s in enumerate(shares)]
        groups = spark.createDataFrame(
            rows, "criterion string, grp string, share decimal(18,2), first_seen int"
        )
        return [r["residual_pct"] for r in residual_percent(groups).orderBy("position").collect()]

    assert percents(62.9, 30, 7) == [62, 38, 0]
    assert percents(0.7, 60.2, 39) == [0, 60, 40]
    assert percents(100, 20) == [100, 0]
    assert percents(130.5, 20, 3) == [130, -30, 0]
    assert percents(0.3, 0.4) == [0, 0]
    assert percents(55.5) == [55]


def test_against_brute_force(spark, make_directory, make_events):
    """Random overlapping affiliations and times around every boundary; one user has most rows."""
    rng = random.Random(5)
    days = [D(1997, 6, 29) + dt.timedelta(days=i) for i in range(10)]
    users = [f"u{i}" for i in range(8)]
    affiliations = []
    for i in range(8):
        for _ in range(rng.randint(0, 4)):
            start, end = sorted(rng.sample(days, 2))
            affiliations.append((i, rng.choice([6, 7, 8, 9]), start, rng.choice([end, None])))
    rows = []
    for n in range(600):
        user = "u1" if n % 3 == 0 else rng.choice(users + ["stranger"])
        clock = rng.choice(["00:00:00", "00:00:01", "12:00:00", "23:59:59"])
        kind = rng.choice(["JOBEND", "JOBEND", "JOBSTART"])
        rows.append((user, "a", f"{rng.choice(days)}T{clock}", kind, rng.randint(1, 50)))
    directory = small(
        make_directory,
        users=[(i, u, u, u, None, i % 3, i % 2) for i, u in enumerate(users)],
        user_systems=[(i, 1) for i in range(8)],
        affiliations=affiliations,
    )
    period = Period.of("1997-07-01", "1997-07-06")
    institution = {6: "Alpha", 7: "Alpha", 8: "Beta", 9: "Gamma"}
    sums, total = defaultdict(int), 0
    for user, _, time, kind, units in rows:
        at = dt.datetime.fromisoformat(time)
        if kind != "JOBEND" or not period.start <= at.date() <= period.end:
            continue
        total += units
        held = {(d, s, e) for i, d, s, e in affiliations if f"u{i}" == user}
        for department, start, end in held:
            after = at >= dt.datetime.combine(start, dt.time())
            if after and (end is None or at <= dt.datetime.combine(end, dt.time())):
                sums[institution[department]] += units
    expected = {k: round(v * 100.0 / total, 2) for k, v in sums.items()}

    found = event_path.percent_by_institution(daily_usage(make_events(rows), period), directory)
    assert {r.institution: r.percentage for r in found.collect()} == expected

    dated = memberships(directory).select("username", "department_id", "start_date", "end_date").distinct()
    joined = affiliation_at_event(finished_usage_with_time(make_events(rows), period), dated)
    assert joined.agg(F.sum("service_units")).first()[0] == sum(sums.values())


def finished_usage_with_time(events_df, period):
    from tallyforge.operators.filters import finished_in

    return finished_in(events_df, period)


def test_counts(make_directory, make_events):
    directory, seen = small(make_directory), events(make_events)
    table = user_counts.account_holders(directory, seen, QUARTER, department_id=6)
    assert rows_of(table.orderBy("line").drop("line")) == [
        ("All", 4, 4), ("Male", 1, 1), ("Female", 1, 1), ("PhD Student", 1, 1),
        ("Home department", 2, 2),
    ]
    men = [("is_astronomy", 1), ("gender", 0)]
    assert user_counts.users_count(directory, men).first()[0] == 1
    assert user_counts.active_users_count(directory, seen, QUARTER, men).first()[0] == 1
    assert user_counts.department_users_count(directory).first()[0] == 2
    assert user_counts.department_active_count(directory, seen, QUARTER).first()[0] == 2
    nobody = Period.of("2001-01-01", "2001-01-01")
    assert user_counts.active_users_count(directory, seen, nobody).first()[0] == 0
    # Only a start was recorded in these days, which is activity all the same.
    start_only = Period.of("1997-08-01", "1997-08-01")
    assert user_counts.active_usernames(seen.filter("user = 'cat'"), start_only).count() == 1
    assert rows_of(user_counts.astronomers_by_department(directory)) == [
        (8, "Beta", 2), (6, "Alpha", 1),
    ]
    assert rows_of(user_counts.astronomers_by_department(directory, "Alpha")) == [(8, "Beta", 2)]
