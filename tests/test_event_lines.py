import datetime as dt
import io
import re
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions.events import parse_events, quarantine
from tallyforge.operators.attribution import units_sum

BASE = {
    "time_and_id": "900000000:e1", "object": "job", "job_id": "j7", "type": "JOBEND", "nodes": "2",
    "cpus": "8", "user": "ann", "group": "grp", "reqwall": "3600", "queue": "[fast:1]",
    "submit_time": "899990000", "start_time": "899996400", "end_time": "900000000",
    "features": "-", "qos": "normal:-", "account": "oz1", "partition": "base", "memory": "2048M",
    "rsv": "-", "eligible_time": "899990060",
}


def line(separator=" ", tokens=56, **changes):
    words = ["x"] * 56
    for name, value in {**BASE, **changes}.items():
        words[V.EVENT_TOKENS[name]] = value
    return separator.join(words[:tokens])


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_every_column(spark):
    row = parse_events(lines(spark, line())).first().asDict()
    at = dt.datetime.fromtimestamp
    utc = lambda s: at(s, dt.timezone.utc).replace(tzinfo=None)
    assert row == {
        "event_id": "e1", "time": utc(900000000), "type": "JOBEND", "nodes": 2, "cpus": 8,
        "user": "ann", "group": "grp", "account": "oz1", "job_id": "j7",
        "submit_time": utc(899990000), "start_time": utc(899996400), "end_time": utc(900000000),
        "eligible_time": utc(899990060), "queue": "fast", "reqwall": 3600, "features": "",
        "memory": 2048, "partition": "base", "rsv": "", "qos_requested": "normal",
        "qos_delivered": "", "service_units": 8.0, "cpu_seconds": Decimal(28800),
    }


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Australia/Melbourne")
        assert parse_events(lines(spark, line())).first()["time"] == dt.datetime(1998, 7, 9, 16)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "text, reason",
    [
        ("a b", "short line"),
        (line(tokens=4), "short line"),
        (line(tokens=55), "short line"),
        (line(object="node"), "not a job"),
        (line(type="JOBSTART"), "not a finished job"),
        (line(time_and_id="900000000"), "no event id"),
        (line(qos="-"), "no delivered QOS"),
        (line(cpus="bad"), "unreadable number"),
        (line(cpus="1.5"), "unreadable number"),
        (line(nodes="9" * 20), "unreadable number"),
        (line(memory="M"), "unreadable number"),
        (line(end_time="-"), "unreadable number"),
        (line(end_time="9" * 18), "unreadable number"),
    ],
)
def test_rejected_lines(spark, text, reason):
    data = lines(spark, text, line())
    assert [r["reason"] for r in quarantine(data).collect()] == [reason]
    assert parse_events(data).count() == 1


def test_large_jobs_are_kept_exactly(spark):
    big = line(memory="3000000000M", nodes="99999999999", cpus="9000000000000000000",
               start_time="-253402300799", end_time="253402300799")
    row = parse_events(lines(spark, big)).select("memory", "nodes", "cpu_seconds").first()
    assert (row["memory"], row["nodes"]) == (3_000_000_000, 99_999_999_999)
    assert row["cpu_seconds"] == Decimal(2 * 253402300799 * 9_000_000_000_000_000_000)


def test_seconds_are_summed_before_they_are_divided(spark):
    second = line(start_time="899999999", end_time="900000000", cpus="1")
    events = parse_events(lines(spark, *[second] * 3600))
    assert events.agg(units_sum(events)).first()[0] == 1


def test_blank_lines_are_neither_events_nor_rejected(spark):
    data = lines(spark, "", "   ", "\t\r\n", line())
    assert quarantine(data).count() == 0
    assert parse_events(data).count() == 1


def test_white_space_of_any_kind_separates(spark):
    data = lines(spark, "  " + line("\t ") + " \r\n", line(memory="16"))
    assert [r["memory"] for r in parse_events(data).select("memory").collect()] == [2048, 16]


def test_other_columns_ride_along(spark):
    data = lines(spark, line()).withColumn("file", F.lit("f1"))
    assert parse_events(data).columns[0] == "file"
    assert quarantine(data).columns == ["value", "file", "reason"]


def test_every_line_is_accepted_or_rejected(spark):
    words = ["job", "node", "JOBEND", "1:a", "1", "-", "x", "n:h"]

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.lists(st.sampled_from(words), min_size=1, max_size=60), min_size=1, max_size=40))
    def check(generated):
        data = lines(spark, *[" ".join(g) for g in generated])
        assert parse_events(data).count() + quarantine(data).count() == len(generated)

    check()


def test_generated_code_stays_compilable(spark):
    """The JVM does not compile methods over 8000 bytes; parsing must stay below that."""
    plan = io.StringIO()
    with redirect_stdout(plan):
        parse_events(lines(spark, line())).explain("codegen")
    sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", plan.getvalue())]
    assert sizes and max(sizes) < 8000
