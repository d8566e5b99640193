"""Run queries and their SQL twins on one folder of given tables and compare the rows."""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from tallyforge.session import build_session
from verification.registry import QUERIES
from verification.twins import TWINS


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(spark, folder: str, name: str, frame=None) -> str | None:
    """None when query and twin agree, else what differs."""
    frame = QUERIES[name](spark, folder) if frame is None else frame
    ours = _normal(frame.columns, [tuple(r) for r in frame.collect()])
    database = duckdb.connect()
    for table in Path(folder).glob("*.parquet"):
        database.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    result = database.execute(TWINS[name])
    columns = [c[0] for c in result.description]
    theirs = _normal(columns, result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    unequal = [(a, b) for a, b in zip(ours[1], theirs[1]) if repr(a) != repr(b)]
    if unequal:
        return f"{len(unequal)} of {len(ours[1])} rows, first {unequal[0]}"
    return None


def main() -> None:
    folder = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        begun = time.time()
        try:
            problem = differences(spark, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - begun:6.2f}s {problem or 'same'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
