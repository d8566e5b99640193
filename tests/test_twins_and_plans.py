"""Every registered query against its SQL twin, and the shape of the plans."""

import re

import pytest

from tallyforge.functions.period import Period
from tallyforge.operators.attribution import finished_usage
from verification.check import differences
from verification.registry import QUERIES
from verification.twins import TWINS
from verification.views import Views


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check_plan(text):
    """No cross joins, no Python, and windows only over the few labels of a criterion.

    A criterion that is a constant is folded away and leaves the order column first.
    """
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval"):
        assert unwanted not in text
    keys = re.findall(r"Window \[.*?\], \[(\w+)#", text)
    assert set(keys) <= {"criterion", "first_seen"}
    assert text.count("Window [") == 0 or keys


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_twin(spark, given, name):
    frame = QUERIES[name](spark, given)
    check_plan(plan(frame))
    assert differences(spark, given, name, frame) is None


def test_period_reaches_the_scan(spark, given):
    usage = finished_usage(Views(spark, given).events(), Period.of("1997-07-01", "1997-09-30"))
    text = usage.groupBy("account").sum("units")
    scan = [line for line in plan(text).splitlines() if "lineitem" in line][0]
    assert "GreaterThanOrEqual(l_shipdate,1997-07-01T00:00)" in scan
    assert "l_extendedprice" not in scan


@pytest.mark.parametrize(
    "name", ["use_pct_by_institution", "use_pct_by_person", "use_pct_by_project"]
)
def test_shares_and_total_read_the_events_once(spark, given, name):
    """The total reuses the shuffle of the sums it divides."""
    df = QUERIES[name](spark, given)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    executed = text.split("== Initial Plan ==")
    stages = [m for part in executed for m in re.findall(r"ReusedExchange", part)]
    assert stages


def test_sort_merge_fallback_gives_the_same(spark, given):
    """Nothing depends on a side being small enough to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        for name in ("use_pct_by_institution", "rpt_account_holders", "ext_account_holders"):
            df = QUERIES[name](spark, given)
            assert "Broadcast" not in plan(df).replace("BroadcastMode", "")
            assert differences(spark, given, name) is None
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_entry(spark):
    import __spark_entry__ as entry_point

    assert entry_point.entry(spark).columns == ["institution", "percentage", "percentage_text"]
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(QUERIES) == set(TWINS) <= set(entry_point.oracle_sql())


def test_log_lines_become_text_after_they_are_dealt(spark, given, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from verification import registry

    plans = []
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path, **named: plans.append(plan(self._df)))
    registry.write_log_files(Views(spark, given))
    (text,) = plans
    # Read from the bottom: the exchange and the sort see numbers and the month, the text is made above them.
    lines = text.split("\n\n")[0].splitlines()
    made = max(i for i, line in enumerate(lines) if "concat_ws" in line)
    assert made < min(i for i, line in enumerate(lines) if "Exchange" in line or "Sort" in line)
