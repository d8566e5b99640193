import re
from itertools import permutations

import pytest
from pyspark.sql import types as T

from tallyforge.llm import filter_audit as A
from tallyforge.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, source string, hash string, fails string, part string, slot string, n string"


def brute(rows, labels):
    """The audit by applying every order to the rows themselves."""
    failed = []
    for i, (key, text, source) in enumerate(rows):
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": key is not None and any(k is not None and k < key and (u or "") == t for k, u, _ in rows),
        }
        good = any(k == key and q == 1 for k, q, _ in labels if key is not None)
        toxic = any(k == key and x == 1 for k, _, x in labels if key is not None)
        failed.append((source or "", fails, good, toxic))
    out, shares = {}, {}
    for part in {p for p, *_ in failed}:
        own = [f for f in failed if f[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if f[1][letter]]
                left = [f for f in left if not f[1][letter]]
                shares[part, letter] = shares.get((part, letter), 0) + len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[1][letter] for f in own) - len(gone),
                    sum(f[1][letter] and sum(f[1].values()) == 1 for f in own),
                    sum(f[2] for f in gone), sum(f[3] for f in gone), letter,
                ]
    return sorted((*k, *v[:-1], shares[k[0], v[-1]]) for k, v in out.items())


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], DOCS).repartition(3)
    told = spark.createDataFrame([(*r, "y") for r in labels], "doc_id bigint, quality int, toxic int, good string")
    return sorted(tuple(r) for r in A.audit_filters(docs, told).collect())


MANY = " ".join(f"w{i}" for i in range(220))


@pytest.mark.parametrize("per_slot", [1, 1_000])
def test_orders_over_odd_rows(spark, monkeypatch, per_slot):
    monkeypatch.setattr(A, "COPIES_PER_SLOT", per_slot)
    rows = [
        (1, MANY, "s"), (2, MANY, "s"), (3, MANY, "t"), (3, MANY, "t"), (None, MANY, "s"), (None, MANY, None),
        (4, None, "s"), (5, "", None), (6, "A" * 10, "s"), (7, MANY + " 5%", "t"), (8, "one " * 300, "t"), (8, "x|y", "s"),
        (9, "é" * 49 + "A", "s"), (10, "é" * 48 + "AA", "s"), (11, MANY + " " + "LONG TEXT # " * 20_000, "t"), (12, "a\x0bb\x1cc d", "u"),
    ] + [(100 + i, "same copy", "hot") for i in range(50)]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 1, None), (None, 1, 1), (8, None, 1), (120, 1, 1), (999, 1, 1)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert audited(spark, [], []) == []
    assert audited(spark, [(1, "x", "s")], []) == brute([(1, "x", "s")], [])


def test_given_table(spark, given):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{given}/{name}.parquet").select(*c).collect()]
    expected = brute(read("documents", "doc_id", "text", "source"), read("labels", "doc_id", "quality", "toxic"))
    got = QUERIES["op11_filter_audit"](spark, given)
    assert got.schema["kept"].dataType == T.LongType() and got.schema["step"].dataType == T.IntegerType()
    assert sorted(tuple(r) for r in got.collect()) == expected
