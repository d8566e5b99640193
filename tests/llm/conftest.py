import re
from collections import Counter

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    # Columns of a caller that the operators must not stumble over.
    + [T.StructField(c, T.StringType()) for c in ("score", "block", "id", "kept", "size", "n_bytes", "lang")]
)


@pytest.fixture
def make_docs(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(i, t, *["x"] * 7) for i, t in rows], DOCS).repartition(parts)

    return make


@pytest.fixture
def given_docs(spark, given):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{given}/documents.parquet").select("doc_id", "text").collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []


def similarity(a, b):
    a, b = Counter(a), Counter(b)
    both = sum((a & b).values())
    return both / (a.total() + b.total() - both) if both else 0.0


class Joined:
    """Union-find over keys; the root is the smallest."""

    def __init__(self, keys):
        self.parent = {k: k for k in keys}

    def root(self, k):
        while self.parent[k] != k:
            k = self.parent[k]
        return k

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
