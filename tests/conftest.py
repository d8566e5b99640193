import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyforge import schemas  # noqa: E402
from tallyforge.operators.directory import TABLES, Directory  # noqa: E402
from tallyforge.session import build_session  # noqa: E402

GIVEN = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def given():
    if not GIVEN.exists():
        pytest.skip(f"no test tables at {GIVEN}")
    return str(GIVEN)


@pytest.fixture
def make_directory(spark):
    """A directory from lists of tuples; tables not given are empty."""

    def make(**rows):
        return Directory(
            lambda table: spark.createDataFrame(rows.get(table, []), TABLES[table][1])
        )

    return make


@pytest.fixture
def make_events(spark):
    """Events from (user, account, time, type, units) tuples; times as ISO text."""
    import datetime as dt
    from decimal import Decimal

    from pyspark.sql import types as T

    wanted = ("user", "account", "time", "type", "service_units")
    # Events of another source: exact hours, no CPU seconds.
    fields = {f.name: f for f in schemas.EVENT.fields}
    fields["service_units"] = T.StructField("service_units", T.DecimalType(18, 6))
    schema = T.StructType([fields[n] for n in wanted])

    def make(rows):
        typed = [
            (user, account, dt.datetime.fromisoformat(time), kind, Decimal(str(units)))
            for user, account, time, kind, units in rows
        ]
        return spark.createDataFrame(typed, schema)

    return make


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def sorted_rows(df):
    return sorted(rows_of(df), key=repr)
