"""Reading tables from a file database through its Python driver."""

import datetime as dt
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import schemas
from tallyforge.functions.period import Period
from tallyforge.operators.attribution import finished_usage
from tallyforge.operators.directory import TABLES, Directory, memberships
from tallyforge.operators.filters import finished_in
from tallyforge.plans import datasets
from tallyforge.sources.tables import DbApiSource, load_events, load_table

from tests.conftest import sorted_rows
from tests.test_usage import small

KINDS = {"string": "TEXT", "bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "date": "TEXT", "timestamp_ntz": "TEXT", "boolean": "INTEGER"}


def fill(path, name, schema, rows):
    columns = ", ".join(f'"{f.name}" {KINDS.get(f.dataType.simpleString(), "TEXT")}' for f in schema.fields)
    plain = [[v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat() if isinstance(v, dt.date) else v for v in r] for r in rows]
    with sqlite3.connect(path) as held:
        held.execute(f'CREATE TABLE "{name}" ({columns})')
        held.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(schema))})', plain)


def source(path, schemas_, **more):
    return DbApiSource("sqlite3", {"database": str(path)}, schemas_, text_moments=True, **more)


EVENTS = T.StructType([T.StructField("ID", T.StringType())] + [f for f in schemas.EVENT.fields if f.name not in ("event_id", "cpu_seconds")] + [T.StructField("number", T.LongType())])


@pytest.fixture
def events(tmp_path):
    rows = []
    for i in range(500):
        at = dt.datetime(2020, 1, 1) + dt.timedelta(hours=12 * i)
        kept = {"ID": f"e{i}", "time": at, "type": "JOBEND" if i % 3 else "JOBSTART", "user": f"u{i % 7}", "account": "p1", "service_units": i / 4, "number": None if i == 9 else i}
        rows.append([kept.get(f.name) for f in EVENTS.fields])
    fill(tmp_path / "db", "job_event", EVENTS, rows)
    return rows, source(tmp_path / "db", {"job_event": EVENTS}, partitions={"job_event": ("number", 4)})


def test_every_row_once_in_parts(spark, events):
    rows, database = events
    table = database.read(spark, "job_event")
    assert table.rdd.getNumPartitions() == 4
    assert sorted(r["ID"] for r in table.collect()) == sorted(r[0] for r in rows)
    found = load_events(spark, database).filter("event_id = 'e41'").first()
    assert (found["time"], found["service_units"], found["cpu_seconds"]) == (dt.datetime(2020, 1, 21, 12), 10.25, 36900)
    alone = source(database.connect["database"], database.schemas)
    with pytest.raises(ValueError, match="partition column"):
        load_events(spark, alone)
    assert alone.read(spark, "job_event").count() == 500


def test_the_period_is_asked_from_the_database(spark, events):
    rows, database = events
    period = Period.of("2020-02-01", "2020-02-10")
    frame = finished_in(load_events(spark, database), period)
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in text  # none is left to Spark
    wanted = [r for r in rows if dt.datetime(2020, 2, 1) <= r[1] < dt.datetime(2020, 2, 11) and r[2] == "JOBEND"]
    assert sorted(r["event_id"] for r in frame.collect()) == sorted(r[0] for r in wanted)
    assert finished_usage(load_events(spark, database), period).count() == len(wanted)


@pytest.mark.parametrize("condition", [
    "number = 7", "number > 480", "number >= 480", "number < 3", "number <= 3", "number IS NULL", "number IS NOT NULL", "user IN ('u1', 'u9')",
    "user = 'u1' AND time >= TIMESTAMP_NTZ'2020-05-01 00:00:00'", "user LIKE 'u1%' OR number = 3", "user LIKE '%1'", "NOT number = 3", "service_units > 120.5",
    "`user` = 'u''1'", "upper(type) = 'JOBEND'", "number <=> 3",
])
def test_filters_give_what_spark_gives(spark, events, condition):
    rows, database = events
    given = spark.createDataFrame(rows, EVENTS)
    assert sorted_rows(database.read(spark, "job_event").filter(condition).select("ID")) == sorted_rows(given.filter(condition).select("ID"))


def test_the_directory_of_a_database(spark, make_directory, tmp_path):
    given = small(make_directory)
    for attribute, (name, schema) in TABLES.items():
        fill(tmp_path / "db", name, schema, [tuple(r) for r in getattr(given, attribute).collect()])
    database = source(tmp_path / "db", {name: schema for name, schema in TABLES.values()})
    directory = Directory.load(spark, database)
    assert sorted_rows(memberships(directory, 1)) == sorted_rows(memberships(given, 1))
    assert directory.project_users.collect() == []


def test_dataset_jobs_of_a_database(spark, tmp_path):
    rows = [("ann", "bolshoi", True, dt.datetime(2024, 1, 2), 5, 1), ("bob", None, False, dt.datetime(2024, 1, 2), None, 1), ("cat", "x", True, dt.datetime(2024, 3, 1), 5, 1)]
    fill(tmp_path / "db", "job", schemas.DATASET_JOBS, rows)
    jobs = load_table(spark, "job", source(tmp_path / "db", {"job": schemas.DATASET_JOBS}), schemas.DATASET_JOBS)
    assert sorted_rows(jobs) == sorted(rows, key=repr)
    counted = datasets.counted_jobs(jobs, Period.of("2024-01-01", "2024-01-15"), ["zed"])
    assert [r["username"] for r in counted.collect()] == ["ann"]


def test_an_empty_table(spark, tmp_path):
    fill(tmp_path / "db", "job_event", EVENTS, [])
    database = source(tmp_path / "db", {"job_event": EVENTS}, partitions={"job_event": ("number", 4)})
    assert load_events(spark, database).agg(F.count("*")).first()[0] == 0
