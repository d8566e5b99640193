"""Training-data pipeline over ``documents``: quality, near duplicates, repeats, benchmarks, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``.  All but the last return the columns of ``docs``, other columns
than the known ones included.  Rows with a null ``doc_id`` cannot be named, so the stages that decide
by document keep them.  An empty table passes through all stages and gives no pieces.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import decontamination, near_duplicates, packing, quality, repeats
from tallyforge.llm.common import table
from tallyforge.operators.materialize import materialize

#: Documents that score less are rejected.
PASSING = 0.3


def _free_name(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def by_plain_names(stage):
    """The stage under names that need no quotes: a caller's column may hold a dot, a blank or a backtick."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        taken = {c.lower() for c in docs.columns}
        plain = {}
        for number, name in enumerate(docs.columns):
            if not (name.isascii() and name.isidentifier()):
                plain[name] = f"column_{number}"
                while plain[name] in taken:
                    plain[name] += "_"
        given = {v: k for k, v in plain.items()}
        out = stage(spark, docs.toDF(*[plain.get(c, c) for c in docs.columns]), sf_dir)
        return out.toDF(*[given.get(c, c) for c in out.columns])

    return run


@by_plain_names
def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model scores at 0.3 or more; null and empty texts are scored too."""
    model = quality.learn_quality(docs, table(spark, sf_dir, "labels"))
    name = _free_name(docs, "score")
    scored = quality.score_quality(docs, model, keep=tuple(docs.columns), score=name)
    return scored.where(F.col(name) >= PASSING).drop(name)


@by_plain_names
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each component; rows that repeat an id are one document.

    Null and empty texts and null ids are linked with nothing and stay.
    """
    judged = near_duplicates.near_duplicates(docs)
    gone = materialize(judged.where("doc_id is not null and not kept").select("doc_id").distinct(), "copies")
    return docs.join(decontamination.sent(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


@by_plain_names
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that an earlier document has; characters cut in part go whole.

    ``n_chars`` is counted anew.  A document of which nothing is left is dropped; one that was empty
    before stays.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    name = _free_name(docs, "n_bytes")
    cut = repeats.cut_texts(docs, carry=others, size=name)
    left = cut.where((F.length("text") > 0) | (F.col(name) == 0)).drop(name)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.length("text").cast(kind))
    return left.select(*docs.columns)


@by_plain_names
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; null and empty texts hold none, repeated rows all stay or go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


@by_plain_names
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens, with their ids.

    A null or empty text is its end-of-text id alone; repeated rows are packed each for itself.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Attention weights, signatures and byte-pair ids have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces made of ``documents`` by all stages."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
