"""Embedding near-dedup by a forest of random-projection trees with spill overlap.

Equal vectors of a label are one class first.  Each tree splits space by random directions at the
median of a bounded sample, or beside it, until a leaf holds about ``LEAF`` classes; every class is then sent down
every tree, to both sides where it lies within the spill margin of a split.  A pair at the threshold
is parted by a split only if its difference along the direction exceeds twice the margin, which is set
from the threshold and the dimension, so a tree keeps nine pairs of ten at the threshold and all
closer ones, and six trees lose one in a million.

In a leaf, classes of one label are compared in double precision.  A pair is counted only in the first
leaf that both reached, so every link counts once although several trees find it; a leaf hands on a
count for each class and an edge to the root of its component, never the pairs.  A leaf that could not
be split without much overlap (a dense group) is compared in pairs of blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import need, schema
from tallyforge.llm.graph import components
from tallyforge.llm.near_duplicates import whole_groups
from tallyforge.operators.materialize import materialize

TREES, LEAF, BLOCK = 6, 4096, 2048
#: Vectors that the trees are fitted on at most, and the fewest of them that a node is split by.
SAMPLE, LEAST_SAMPLE = 20_000, 32
#: Half the width of the overlap, in standard deviations of a threshold pair's projected difference.
SPILL = 0.64
#: A split is tried again with another direction if both sides together hold more than this many times
#: the node; the most that the splits above a leaf may make of it together, which bounds a tree's copies.
OVERLAP, TRIES, OVERLAP_IN_ALL = 1.25, 4, 16.0
#: Where a direction is split, the first place that does; the others pass by a dense group at the median.
QUANTILES, LARGEST_SIDE = (0.5, 0.35, 0.65, 0.2, 0.8), 0.9


@dataclass
class Tree:
    """Nodes of a tree: direction and threshold of a split, its children; a leaf is -1 - its number."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    margin: float
    root: int

    def leaves(self, vectors: np.ndarray):
        """Rows and the numbers of the leaves that they reach."""
        rows, leaves, stack = [], [], [(self.root, np.arange(len(vectors)))]
        while stack:
            node, own = stack.pop()
            if not len(own):
                continue
            if node < 0:
                rows.append(own)
                leaves.append(np.full(len(own), -1 - node, np.int32))
                continue
            along = vectors[own] @ self.directions[node] - self.thresholds[node]
            stack.append((self.children[node, 0], own[along <= self.margin]))
            stack.append((self.children[node, 1], own[along >= -self.margin]))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate(rows), np.concatenate(leaves)


def fit_forest(sample: np.ndarray, total: int, threshold: float, trees: int = TREES, leaf: int = LEAF, seed: int = 11):
    """Trees on unit vectors, leaves numbered across all of them."""
    random = np.random.default_rng(seed)
    dimension = sample.shape[1]
    margin = SPILL * np.sqrt(max(0.0, 2 - 2 * threshold) / dimension)
    weight, numbered, forest = total / max(1, len(sample)), 0, []
    for _ in range(trees):
        directions, thresholds, children = [], [], []

        def grow(own, copies: float) -> int:
            nonlocal numbered
            if len(own) * weight > leaf and len(own) >= LEAST_SAMPLE:
                for _ in range(TRIES):
                    direction = random.standard_normal(dimension)
                    direction /= np.linalg.norm(direction)
                    along = sample[own] @ direction
                    for middle in np.quantile(along, QUANTILES):
                        left, right = own[along <= middle + margin], own[along >= middle - margin]
                        factor = (len(left) + len(right)) / len(own)
                        if (
                            factor > OVERLAP
                            or copies * factor > OVERLAP_IN_ALL
                            or max(len(left), len(right)) > LARGEST_SIDE * len(own)
                        ):
                            continue
                        node = len(directions)
                        directions.append(direction)
                        thresholds.append(float(middle))
                        children.append([0, 0])
                        children[node][0] = grow(left, copies * factor)
                        children[node][1] = grow(right, copies * factor)
                        return node
            numbered += 1
            return -numbered

        root = grow(np.arange(len(sample)), 1.0)
        forest.append(
            Tree(np.array(directions).reshape(-1, dimension), np.array(thresholds), np.array(children).reshape(-1, 2), margin, root)
        )
    return forest


def _matrix(blobs: list[bytes], kind: str, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones padded with zeros."""
    out = np.zeros((len(blobs), width))
    for row, blob in enumerate(blobs):
        vector = np.frombuffer(blob, kind)
        out[row, : len(vector)] = vector
    return out


def valid_vectors(vectors: DataFrame, key: str, kind: str) -> DataFrame:
    """id, label and the raw bytes of the vector; null bytes where it can link with nothing."""
    element = "<f4" if kind == "float" else "<f8"

    def read(batches):
        for batch in batches:
            column, raw = batch.column(2), []
            for row in range(len(column)):
                values = column[row].values
                good = values is not None and len(values) and not values.null_count
                array = values.to_numpy(zero_copy_only=False).astype(element) if good else None
                good = good and bool(np.isfinite(array).all()) and bool(array.any())
                raw.append(array.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["id", "label", "raw"]
            )

    given = need(vectors, key, "label", "embedding").select(
        F.col(key).cast("bigint").alias("id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast(f"array<{kind}>").alias("embedding"),
    )
    return given.mapInArrow(read, schema("id bigint, label string, raw binary"))


def link_embeddings(
    vectors: DataFrame,
    threshold: float = 0.93,
    key: str = "vec_id",
    trees: int = TREES,
    leaf: int = LEAF,
    sample_size: int = SAMPLE,
    seed: int = 11,
) -> DataFrame:
    """One row per vector: key, number of other vectors linked directly, component and whether it stays.

    Two vectors are linked if their labels are equal and not null, their lengths equal, and the cosine
    is at least ``threshold``.  A vector that is null, empty or zero, or has a null or non-finite
    component, or a null label or key, is linked with nothing and is its own component.  Rows that
    repeat a vector, with another key or the same, are linked.  An empty table gives an empty result.
    """
    array = vectors.schema["embedding"].dataType
    kind = "float" if array.elementType.simpleString() == "float" else "double"
    element, item = ("<f4", 4) if kind == "float" else ("<f8", 8)
    rows = materialize(valid_vectors(vectors, key, kind), "vectors")
    sound = rows.where("id is not null and label is not null and raw is not null")
    classes = sound.groupBy("label", "raw").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = classes.withColumn("kind", F.xxhash64("label", F.octet_length("raw")))
    classes = materialize(classes, "classes")
    size = classes.agg(F.count("*").alias("n"), F.max(F.octet_length("raw")).alias("bytes")).first()
    width = max(1, (size["bytes"] or 0) // item)
    share = min(1.0, sample_size / max(1, size["n"]))
    picked = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = [r["raw"] for r in classes.where(picked).select("raw").limit(2 * sample_size).collect()]
    sample = _unit(_matrix([bytes(x) for x in sample], element, width))
    forest = fit_forest(sample, size["n"], threshold, trees, leaf, seed)

    def send(batches):
        for batch in batches:
            blobs = batch.column(2).to_pylist()
            unit = _unit(_matrix(blobs, element, width))
            reached = [tree.leaves(unit) for tree in forest]
            row = np.concatenate([r for r, _ in reached])
            number = np.concatenate([n for _, n in reached])
            order = np.lexsort((number, row))
            row, number = row[order], number[order]
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = [number[a:b].astype("<i4").tobytes() for a, b in zip(ends[:-1], ends[1:])]
            for start in range(0, len(row), 8192):
                at = row[start : start + 8192]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        pa.array(number[start : start + 8192]),
                        batch.column(1).take(pa.array(at)),
                        batch.column(3).take(pa.array(at)),
                        pa.array([blobs[i] for i in at], pa.binary()),
                        pa.array([lists[i] for i in at], pa.binary()),
                    ],
                    names=["kind", "leaf", "id", "copies", "raw", "leaves"],
                )

    sent = classes.select("kind", "id", "raw", "copies").mapInArrow(
        send, schema("kind bigint, leaf int, id bigint, copies bigint, raw binary, leaves binary")
    )
    sent = materialize(sent, "leaves")
    crowds = sent.groupBy("kind", "leaf").agg(F.count("*").alias("crowd")).where("crowd > 1")
    n = F.ceil(F.col("crowd") / BLOCK)
    mine = F.pmod(F.xxhash64("id"), n)
    meets = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda o: F.least(o, mine) * n + F.greatest(o, mine))
    placed = sent.join(crowds, ["kind", "leaf"]).select(
        "kind", F.col("leaf").cast("bigint").alias("leaf"), F.explode(meets).alias("block"), mine.alias("own"),
        "id", "copies", "raw", "leaves",
    )
    placed = placed.repartition("kind", "leaf", "block").sortWithinPartitions("kind", "leaf", "block", "id")

    def compare(batches):
        for batch in whole_groups(batches, 3):
            key_columns = [batch.column(i).to_numpy() for i in range(3)]
            new = np.r_[True, np.any([c[1:] != c[:-1] for c in key_columns], axis=0)]
            begins = np.append(np.flatnonzero(new), batch.num_rows)
            found = [[], [], []]
            for a, b in zip(begins[:-1], begins[1:]):
                own, ids, copies = (batch.column(i).slice(a, b - a).to_numpy() for i in (3, 4, 5))
                matrix = _matrix(batch.column(6).slice(a, b - a).to_pylist(), element, width)
                lists = [np.frombuffer(x, "<i4") for x in batch.column(7).slice(a, b - a).to_pylist()]
                links, root = compare_leaf(matrix, lists, key_columns[1][a], own, copies, threshold)
                rows = np.flatnonzero(links)
                for column, values in zip(found, (ids[rows], links[rows], ids[root[rows]])):
                    column.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in found], names=["id", "links", "root"]
            )

    found = materialize(placed.mapInArrow(compare, schema("id bigint, links bigint, root bigint")), "links")
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    classed = classes.join(counted, "id", "left").join(roots.withColumnRenamed("vertex", "id"), "id", "left").select(
        "label",
        "raw",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
    )
    component = F.coalesce("component_id", "id")
    # Rows without a key must not meet the class of their vector.
    meeting = F.when(F.col("id").isNotNull(), F.col("raw"))
    return rows.withColumn("raw", meeting).join(classed, ["label", "raw"], "left").select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.maximum(np.abs(matrix).max(axis=1, keepdims=True, initial=0), np.finfo(float).tiny)
    return scaled / np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), np.finfo(float).tiny)


def compare_leaf(matrix, lists, leaf: int, own, copies, threshold: float):
    """Links that each row has in this leaf first, weighed by copies, and its root within the leaf.

    Rows are ascending by id.  Rows of one block meet each other only where the block meets itself,
    which is the case if all rows are of it.
    """
    n, unit = len(matrix), _unit(matrix)
    earlier = [x[x < leaf] for x in lists]
    numbers = np.unique(np.concatenate(earlier))
    before = np.zeros((n, len(numbers)), np.float32)
    before[np.repeat(np.arange(n), [len(x) for x in earlier]), np.searchsorted(numbers, np.concatenate(earlier))] = 1
    alone = (own == own[0]).all()
    linked = np.zeros((n, n), bool)
    for start in range(0, n, 512):
        part = slice(start, start + 512)
        hits = unit[part] @ unit.T >= threshold
        hits[np.arange(len(hits)), np.arange(start, start + len(hits))] = False
        if not alone:
            hits &= own[part, None] != own
        if len(numbers) and hits.any():
            hits &= before[part] @ before.T == 0
        linked[part] = hits
    linked |= linked.T  # the two halves of the product may round differently
    links = np.array([copies[row].sum() for row in linked], np.int64) if n else np.zeros(0, np.int64)
    root = np.arange(n)
    active = np.flatnonzero(links)
    while len(active):
        lowest = root.copy()
        for start in range(0, len(active), 512):
            rows = active[start : start + 512]
            lowest[rows] = np.minimum(root[rows], np.where(linked[rows], root, n).min(axis=1))
        lowest = lowest[lowest]
        if (lowest == root).all():
            break
        root = lowest
    return links, root
