"""Packing: several context sizes, each packed in turn, gaps of long windows filled from short pieces.

A document is its ids followed by one end-of-text id.  What fills whole windows of the longest tier
goes there at once.  The rest of the document is routed to the smallest tier that holds it.  Tiers are
packed from the longest down: a piece opens a window of its tier, the gap is filled with the largest
shorter pieces that fit, and what is still open is filled by cutting one piece.  Every window is then
exactly full.  Only what is left at the end of a task is cut into ever shorter tiers, and less than
the shortest tier is padded.

Windows are dealt to step groups, each to the group with the fewest tokens so far, longest first, so
that the groups of a buffer hold about the same tokens of every tier.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Sequence
from dataclasses import dataclass
from heapq import heapify, heapreplace

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import need, schema
from tallyforge.llm.tokens import END_OF_TEXT, VOCABULARY, Encoder

TIERS = (128, 256, 512, 1024)
#: Tokens that wait in a task before they are packed, and tokens of a step group.
BUFFER_TOKENS, STEP_TOKENS = 1_000_000, 64 * 1024
#: A task numbers its sequences from its own number times this.
TASK_STRIDE = 1 << 33


@dataclass(order=True)
class Piece:
    length: int
    order: int
    doc: int
    start: int
    ids: bytes
    doc_tokens: int

    def cut(self, tokens: int) -> tuple[Piece, Piece]:
        """The first ``tokens`` ids and the rest."""
        head = Piece(tokens, self.order, self.doc, self.start, self.ids[: 4 * tokens], self.doc_tokens)
        rest = self.length - tokens
        tail = Piece(rest, self.order, self.doc, self.start + tokens, self.ids[4 * tokens :], self.doc_tokens)
        return head, tail


class Packer:
    """Packs the pieces of one task; ``take`` and ``finish`` give lists of (tier, pieces)."""

    def __init__(self, tiers: Sequence[int] = TIERS, buffer_tokens: int = BUFFER_TOKENS):
        self.tiers = sorted(tiers)
        self.buffer_tokens = buffer_tokens
        self.waiting: list[Piece] = []
        self.tokens = self.taken = 0
        self.full: list[tuple[int, list[Piece]]] = []

    def take(self, doc: int, ids: bytes) -> list[tuple[int, list[Piece]]]:
        tokens, window = len(ids) // 4, self.tiers[-1]
        whole = tokens // window * window
        for start in range(0, whole, window):
            piece = Piece(window, self.taken, doc, start, ids[4 * start : 4 * (start + window)], tokens)
            self.full.append((window, [piece]))
        if tokens > whole:
            self.waiting.append(Piece(tokens - whole, self.taken, doc, whole, ids[4 * whole :], tokens))
        self.tokens += tokens
        self.taken += 1
        return self._pack() if self.tokens >= self.buffer_tokens else []

    def _pack(self) -> list[tuple[int, list[Piece]]]:
        """Pack what waits; pieces that cannot fill a window of their tier wait on."""
        ready, self.full = self.full, []
        pieces = sorted(self.waiting)
        left = sum(p.length for p in pieces)
        for tier, shorter in zip(self.tiers[::-1], [*self.tiers[-2::-1], 0]):
            while pieces and pieces[-1].length > shorter and left >= tier:
                window, gap = [], tier
                while gap:
                    at = bisect_right(pieces, gap, key=lambda p: p.length)
                    if at:
                        piece = pieces.pop(at - 1)
                    else:  # all are longer than the gap
                        piece, rest = pieces.pop(0).cut(gap)
                        insort(pieces, rest)
                    window.append(piece)
                    gap -= piece.length
                left -= tier
                ready.append((tier, window))
        self.waiting, self.tokens = pieces, left
        return ready

    def finish(self) -> list[tuple[int, list[Piece]]]:
        """Pack the rest; the last window is padded."""
        ready = self._pack()
        for tier in self.tiers[::-1]:
            while sum(p.length for p in self.waiting) >= tier:
                window, gap = [], tier
                while gap:
                    piece = self.waiting.pop()
                    if piece.length > gap:
                        piece, rest = piece.cut(gap)
                        self.waiting.append(rest)
                    window.append(piece)
                    gap -= piece.length
                ready.append((tier, window))
        if self.waiting:
            ready.append((self.tiers[-1], self.waiting))
        self.waiting, self.tokens = [], 0
        return ready


def step_groups(lengths: Sequence[int], step_tokens: int) -> list[int]:
    """A group for each window: the lightest so far, longest windows first."""
    loads = [(0, g) for g in range(max(1, sum(lengths) // step_tokens))]
    heapify(loads)
    group = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        load, group[i] = loads[0]
        heapreplace(loads, (load + lengths[i], group[i]))
    return group


OUTPUT = (
    "`{key}` bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, window int, step_group bigint"
)


def pack_documents(
    docs: DataFrame,
    key: str = "doc_id",
    tiers: Sequence[int] = TIERS,
    vocabulary: str = VOCABULARY,
    buffer_tokens: int = BUFFER_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids.

    ``ids`` are little-endian unsigned 32-bit values; ``window`` is the padded length of the sequence.
    A null or empty text is the end-of-text id alone.  Rows with a null key are packed too.  Repeated
    rows are packed each for itself; an empty table has no pieces.  One narrow pass: no shuffle, and
    a task holds one buffer and one document.  Sequence numbers depend on how the input is split in
    tasks, not on which executor runs them, so a task that runs again gives the same rows.
    """

    def pack(batches):
        encoder, packer = Encoder(vocabulary, special=True), Packer(tiers, buffer_tokens)
        first = TaskContext.get().partitionId() * TASK_STRIDE
        sequence = groups = first

        def rows(ready):
            nonlocal sequence, groups
            dealt = step_groups([tier for tier, _ in ready], step_tokens)
            columns = [[] for _ in range(9)]
            for (tier, pieces), group in zip(ready, dealt):
                offset = 0
                for p in pieces:
                    row = (p.doc, p.start, p.length, p.ids, p.doc_tokens, sequence, offset, tier, groups + group)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += p.length
                sequence += 1
            groups += max(dealt, default=-1) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, KINDS)], names=[key, *NAMES]
            )

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for row in range(batch.num_rows):
                ready = packer.take(ids[row].as_py(), encoder.ids(texts[row].as_py() or "") + END_OF_TEXT)
                if ready:
                    yield rows(ready)
        if ready := packer.finish():
            yield rows(ready)

    given = need(docs, key, "text").withColumn(key, F.col(key).cast("bigint"))
    return given.mapInArrow(pack, schema(OUTPUT.format(key=key)))


NAMES = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window", "step_group")
KINDS = (*[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64())
