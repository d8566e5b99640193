"""Token-ID output in training order: a keyed permutation gives every sequence a global slot.

Documents are encoded and run together into records of a fixed number of ids, once, into a table in
the shared folder.  Records are numbered from 0 by the counts of the tasks that made them.  A Feistel
network over the smallest even number of bits, walked until it lands below the number of records, maps
number to slot one to one, so the order is as good as shuffled but follows from key and number alone.
Records are then dealt by range of slots to shards and sorted: record k of shard s is slot
``s * records_per_shard + k``, at byte ``k * stride`` of its file.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import mixed, need, schema
from tallyforge.llm.tokens import END_OF_TEXT, VOCABULARY, Encoder
from tallyforge.operators.materialize import materialize

TOKENS, RECORDS_PER_SHARD, ROUNDS, KEY = 1024, 8192, 6, 20_240_601
#: Ids of these vocabularies are below 65,536; two bytes hold one.
ID_BYTES = 2
#: Records that a task hands on at a time.
HANDED_ON = 256
#: First numbers of up to this many tasks are sent to all executors (some 20 MB), more are joined.
SENT_TASKS = 1_000_000


def permuted(numbers: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """The slots of numbers below ``size``, a bijection onto 0..size-1."""
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mixed(mixed(np.full(ROUNDS, key % 2**64, np.uint64)) + np.arange(ROUNDS, dtype=np.uint64))

    def network(x):
        left, right = x >> np.uint64(half), x & low
        for round_key in keys:
            left, right = right, left ^ (mixed(right + round_key) & low)
        return left << np.uint64(half) | right

    slots = network(numbers.astype(np.uint64))
    while (outside := slots >= np.uint64(size)).any():
        slots[outside] = network(slots[outside])
    return slots.astype(np.int64)


def records(docs: DataFrame, key: str = "doc_id", tokens: int = TOKENS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Fixed-length records of ids in task order; the last one of a task is padded with id 0."""

    def fill(batches):
        encoder, task = Encoder(vocabulary, special=True), TaskContext.get().partitionId()
        stride, number, begun = 4 * tokens, 0, 0
        held = bytearray()
        within: list[int] = []  # documents with ids in what is held, and where each ends
        ends: list[int] = []
        out: list[tuple] = []

        def cut(last: bool):
            nonlocal held, begun, number, within, ends
            while len(held) - begun >= stride or last and len(held) > begun:
                piece = bytes(held[begun : begun + stride])
                used = sum(1 for e in ends if e <= begun + len(piece))
                parts = within[: used + (used < len(within) and (ends[used - 1] if used else 0) < begun + len(piece))]
                ids = np.frombuffer(piece, "<u4")
                if ids.max() >= 1 << 8 * ID_BYTES:
                    raise ValueError(f"id {ids.max()} of the vocabulary does not fit {ID_BYTES} bytes")
                ids = ids.astype("<u2").tobytes()
                out.append((task, number, len(piece) // 4, parts, ids.ljust(ID_BYTES * tokens, b"\0")))
                within, ends = within[used:], ends[used:]
                begun += len(piece)
                number += 1
            del held[:begun]
            ends = [e - begun for e in ends]
            begun = 0

        def handed():
            columns = [pa.array(c, t) for c, t in zip(zip(*out), KINDS)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["task", "number", "n_tokens", "docs", "ids"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                held += encoder.ids(text.as_py() or "") + END_OF_TEXT
                within.append(doc.as_py())
                ends.append(len(held))
                if len(held) >= stride:
                    cut(False)
                if len(out) >= HANDED_ON:
                    yield handed()
        cut(True)
        if out:
            yield handed()

    given = need(docs, key, "text").withColumn(key, F.col(key).cast("bigint"))
    return given.mapInArrow(
        fill, schema("task int, number bigint, n_tokens int, docs array<bigint>, ids binary")
    )


KINDS = (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary())


def in_training_order(
    docs: DataFrame,
    key: str = "doc_id",
    tokens: int = TOKENS,
    records_per_shard: int = RECORDS_PER_SHARD,
    permutation_key: int = KEY,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """One row per record: slot, shard, place in the shard's file, its documents and its ids.

    A null or empty text is the end-of-text id alone; repeated rows are written each for itself; null
    keys stay null in ``docs``; an empty table has no records.  The ids are encoded once and shuffled
    once.  Slots are a permutation, so ranges of slots are even whatever the input looks like.
    """
    made = materialize(records(docs, key, tokens, vocabulary), "token-records")
    spark = made.sparkSession
    # One row per task that made records.
    counts = made.groupBy("task").agg(F.count("*").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    if counts.count() <= SENT_TASKS:
        firsts = F.broadcast(firsts)
    size = made.count()

    @F.pandas_udf("bigint")
    def slot_of(number: pd.Series) -> pd.Series:
        return pd.Series(permuted(number.to_numpy(), size, permutation_key))

    shards = max(1, -(-size // records_per_shard))
    stride = ID_BYTES * tokens
    placed = (
        made.join(firsts, "task")
        .withColumn("slot", slot_of(F.col("first") + F.col("number")))
        .withColumn("shard", F.floor(F.col("slot") / records_per_shard).cast("int"))
        .select(
            "slot",
            "shard",
            ((F.col("slot") % records_per_shard) * stride).alias("byte_offset"),
            "n_tokens",
            "docs",
            "ids",
        )
    )
    parts = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartitionByRange(parts, "slot").sortWithinPartitions("slot")


def checksum(path: str) -> int:
    """crc32 of a file, read a megabyte at a time."""
    crc = 0
    with open(path, "rb") as held:
        while data := held.read(1 << 20):
            crc = zlib.crc32(data, crc)
    return crc


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Write ``shard-NNNNNN.bin`` files to a folder that all executors reach as local files.

    Each shard is dealt to one task, written beside its place and renamed when whole; a shard that is
    there already with the same size and crc32 is left as it is, any other is replaced.
    Returns one row per shard: path, records, bytes and crc32.
    """

    def write(batches):
        os.makedirs(folder, exist_ok=True)
        at, file, path, count, crc = None, None, "", 0, 0

        def close():
            file.close()
            size = os.path.getsize(file.name)
            if os.path.exists(path) and os.path.getsize(path) == size and checksum(path) == crc:
                os.unlink(file.name)
            else:
                os.replace(file.name, path)
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([at], pa.int32()), "path": [path], "records": [count], "bytes": [size], "crc32": [crc]}
            )

        for batch in batches:
            for shard, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard != at:
                    if file:
                        yield close()
                    at, path, count, crc = shard, f"{folder}/shard-{shard:06d}.bin", 0, 0
                    attempt = TaskContext.get().taskAttemptId()
                    file = open(f"{path}.part-{attempt}", "wb")  # noqa: SIM115
                data = ids.as_py()
                file.write(data)
                count, crc = count + 1, zlib.crc32(data, crc)
        if file:
            yield close()

    shards = ordered.select("shard", "slot", "ids")
    shards = shards.repartitionByRange(F.col("shard")).sortWithinPartitions("shard", "slot")
    return shards.select("shard", "ids").mapInArrow(
        write, schema("shard int, path string, records bigint, bytes bigint, crc32 bigint")
    )
