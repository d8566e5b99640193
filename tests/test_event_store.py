import re

from pyspark.sql import functions as F

from tallyforge.operators import event_store
from tallyforge.operators.filters import drop_admin_usage, excluding
from tallyforge.sources.files import log_glob, read_event_log
from tallyforge.functions.period import Period
from tallyforge.operators.attribution import activity_rollup, daily_usage
from tallyforge.plans.user_counts import active_usernames
from tallyforge.streaming.ingest import REJECTS, current_ledger, ingest_changed_files, ingest_stream

from tests.conftest import sorted_rows
from tests.test_event_lines import line


def event(number, user="ann", **changes):
    return line(time_and_id=f"{900000000 + number}:e{number}", user=user, **changes)


def stored(spark, path):
    return sorted_rows(event_store.read_stored(spark, path).select("event_id", "user"))


def test_first_row_of_an_id_wins_in_file_order(spark, tmp_path):
    (tmp_path / "events_b").write_text("\n".join([event(1, "late"), event(2, "bob")]))
    (tmp_path / "events_a").write_text("\n".join([event(1, "early"), event(1, "second"), event(3)]))
    table = str(tmp_path / "table")
    assert ingest_changed_files(spark, f"{tmp_path}/events_*", table, str(tmp_path / "ledger")) == 2
    assert stored(spark, table) == [("e1", "early"), ("e2", "bob"), ("e3", "ann")]


def test_position_order_survives_small_blocks(spark, tmp_path):
    """Many blocks per file, packed into tasks by size, still order as in the file."""
    text = "\n".join(event(7, f"u{i:04d}") for i in range(3000))
    (tmp_path / "events_a").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        lines = read_event_log(spark, f"{tmp_path}/events_a")
        assert lines.rdd.getNumPartitions() > 10
        users = [r["value"].split()[7] for r in lines.orderBy("file", "block", "row").collect()]
        assert users == [f"u{i:04d}" for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_grown_file_adds_only_its_tail(spark, tmp_path):
    log, table, ledger = tmp_path / "events_a", str(tmp_path / "table"), str(tmp_path / "ledger")
    glob = f"{tmp_path}/events_*"
    log.write_text(event(1) + "\n")
    assert ingest_changed_files(spark, glob, table, ledger, admins=["root"]) == 1
    assert ingest_changed_files(spark, glob, table, ledger, admins=["root"]) == 0
    with log.open("a") as more:
        more.write("\n".join([event(1, "again"), event(2), event(3, "root"), event(4, cpus="bad")]))
    assert ingest_changed_files(spark, glob, table, ledger, admins=["root"]) == 1
    assert stored(spark, table) == [("e1", "ann"), ("e2", "ann")]
    sizes = {r["size"] for r in current_ledger(spark, ledger).collect()}
    assert sizes == {log.stat().st_size}


def test_stream_loads_new_files_once_and_the_ledger_finds_what_it_misses(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    table, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")

    def stream(checkpoint):
        query = ingest_stream(
            spark, str(logs), table, str(tmp_path / checkpoint), ["root"],
            rejects=str(tmp_path / "rejects"), files_per_batch=1,
        )
        query.awaitTermination()

    (logs / "events_jan").write_text("\n".join([event(1), event(2, "root"), "short", event(1, "dup")]))
    stream("c1")
    (logs / "events_old").write_text(event(9) + "\n" + event(1, "later"))
    stream("c1")
    assert stored(spark, table) == [("e1", "ann"), ("e9", "ann")]
    assert [r["reason"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["short line"]

    with (logs / "events_jan").open("a") as more:
        more.write("\n" + event(5))
    stream("c1")
    assert len(stored(spark, table)) == 2
    assert ingest_changed_files(spark, f"{logs}/*", table, ledger, ["root"]) == 2
    stream("c2")  # a lost checkpoint loads every file again and stores nothing twice
    assert stored(spark, table) == [("e1", "ann"), ("e5", "ann"), ("e9", "ann")]


def test_ids_bound_to_their_date_read_only_its_partition(spark, tmp_path):
    table, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")

    def load(name, *events_, **options):
        (tmp_path / name).write_text("\n".join(events_))
        ingest_changed_files(spark, f"{tmp_path}/{name}", table, ledger, **options)

    load("events_a", event(1), event(86400 * 3))
    load("events_b", event(1, "dup"), event(2), event(86400 * 5), id_fixes_date=True)
    assert stored(spark, table) == [
        ("e1", "ann"), ("e2", "ann"), ("e259200", "ann"), ("e432000", "ann"),
    ]


def test_stored_table_is_pruned_by_date(spark, tmp_path):
    (tmp_path / "events_a").write_text("\n".join(event(86400 * i) for i in range(4)))
    table = str(tmp_path / "table")
    ingest_changed_files(spark, f"{tmp_path}/events_a", table, str(tmp_path / "ledger"))
    one_day = event_store.read_stored(spark, table).filter("event_date = DATE'1998-07-10'")
    assert one_day.count() == 1
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_period_queries_open_only_the_dates_of_the_period(spark, tmp_path, make_directory):
    (tmp_path / "events_a").write_text("\n".join(event(86400 * i) for i in range(4)))
    table = str(tmp_path / "table")
    ingest_changed_files(spark, f"{tmp_path}/events_a", table, str(tmp_path / "ledger"))
    events, period = event_store.reported_events(spark, table, ["root"]), Period.of("1998-07-10", "1998-07-11")
    for frame in (daily_usage(events, period), activity_rollup(events, period), active_usernames(events, period)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        (filters,) = set(re.findall(r"PartitionFilters: \[([^]]*)\]", plan))
        assert "event_date" in filters and ">= 1998-07-10" in filters and "<= 1998-07-11" in filters
    assert sum(r["finished"] for r in activity_rollup(events, period).collect()) == 2


def test_a_later_administrator_is_left_out_of_reports(spark, tmp_path):
    (tmp_path / "events_a").write_text("\n".join([event(1, "ann"), event(2, "bob")]))
    table, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    ingest_changed_files(spark, f"{tmp_path}/events_a", table, ledger)
    assert [r["user"] for r in event_store.reported_events(spark, table, ["ann"]).collect()] == ["bob"]


def test_first_row_of_an_id_blocks_later_ones_even_if_an_administrators(spark, tmp_path):
    (tmp_path / "events_a").write_text("\n".join([event(1, "root"), event(1, "ann"), event(2, "ann")]))
    table = str(tmp_path / "table")
    ingest_changed_files(spark, f"{tmp_path}/events_a", table, str(tmp_path / "ledger"), admins=["root"])
    assert stored(spark, table) == [("e2", "ann")]


def test_rejects_of_a_grown_file_are_kept_once_and_staging_goes(spark, tmp_path):
    table, ledger, rejects = (str(tmp_path / x) for x in ("table", "ledger", "rejects"))
    log = tmp_path / "ev_f[1]*"
    for text in (["broken", event(1)], ["broken", event(1), "broken", "other", event(2)]):
        log.write_text("\n".join(text))
        assert ingest_changed_files(spark, f"{tmp_path}/ev_*", table, ledger, rejects=rejects) == 1
    kept = spark.read.schema(REJECTS).parquet(rejects).groupBy("value").agg(F.sum("times")).collect()
    assert sorted(map(tuple, kept)) == [("broken", 2), ("other", 1)]
    assert stored(spark, table) == [("e1", "ann"), ("e2", "ann")]
    assert not list(tmp_path.glob("table.staging*"))


def test_file_plan(spark):
    files = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, size bigint")
    ledger = spark.createDataFrame([("a", 1), ("b", 1), ("z", 9)], "name string, size bigint")
    plan = event_store.plan_files(files, ledger).select("name", "state")
    assert sorted_rows(plan) == [("a", "unchanged"), ("b", "changed"), ("c", "new")]
    after = event_store.next_ledger(files, ledger)
    assert sorted_rows(after) == [("a", 1), ("b", 2), ("c", 3), ("z", 9)]


def test_admin_lists(spark):
    events = spark.createDataFrame([("root",), ("ann",), (None,)], "user string")
    names = spark.createDataFrame([(" root ",)], "admin string")
    for admins in (["root"], [" root "], names):
        assert sorted_rows(drop_admin_usage(events, admins)) == [("ann",), (None,)]
        assert sorted_rows(excluding(events, "user", admins)) == [("ann",)]
    assert drop_admin_usage(events, []).count() == 3
    assert excluding(events, "user", []).count() == 2


def test_log_glob():
    assert log_glob("/logs/events*") == "/logs/events*"
    assert log_glob("/logs/events*", "Mar", 2017) == "/logs/events*Mar*2017*"


def test_one_id_holding_most_rows(spark):
    """A hot event ID is combined before the shuffle: no task receives its copies."""
    batch = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("id").alias("row"),
    )
    first = event_store.first_per_event(batch)
    assert first.count() == 20001
    assert first.filter("event_id = 'hot'").first()["row"] == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
