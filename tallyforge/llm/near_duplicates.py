"""MinHash near-dedup by an LSH forest: sorted signature orders, neighbours by common prefix.

1.  A document is its set of word shingles, hashed to 64 bits; sets that are equal are one class.
2.  A class has a signature of ``TREES * DEPTH`` minima.  Each tree orders the classes by its own
    ``DEPTH`` minima.  Classes that agree in the first ``LEAST_DEPTH`` of a tree lie together in it;
    two sets of similarity 0.75 do so in none of 24 trees once in half a million.
3.  Such a region is read in sorted order, so neighbours are those of the longest common prefix: the
    depth follows the region, deep where it is crowded.  A region beyond ``REGION`` rows is dealt to
    blocks by hash, other ones in other trees.  Neighbours whose signatures agree well enough are
    candidates; every class keeps its best and its smallest one.
4.  Candidates are confirmed on their full sets and joined to components.
5.  What lies together in a region but not yet in one component is compared whole, in blocks of two
    groups of rows each: first signatures, which only mark the rows that may have a partner, then the
    full sets of those rows.  A block gives a spanning forest of the links it finds, never its pairs,
    and a pair is compared in the first tree where it meets.  So no link is lost to the choice in 3,
    and nothing written grows with the square of a group of copies or of a group of look-alikes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import keep_freed_arrays, mixed, need, schema, text_rounds
from tallyforge.llm.graph import components
from tallyforge.llm.words import shingle_hashes, word_hashes
from tallyforge.operators.materialize import materialize

SHINGLE, TREES, DEPTH, LEAST_DEPTH = 5, 24, 4, 3
MINIMA = TREES * DEPTH
#: Rows of a region that are compared in one place, and neighbours on either side in sorted order.
REGION, NEIGHBOURS = 256, 3
#: Rows and shingles of a group of the whole comparison (two groups meet in a block); a larger set is alone.
GROUP, GROUP_SHINGLES = 512, 1_000_000
#: Signatures of sets at the similarity asked for agree less than this once in a hundred thousand.
SLACK = 0.20
#: Bytes of text that a round takes: a worker holds many times as much for it, and keeps most of that afterwards.
ROUND_BYTES = 250_000
#: Keys up to this many are sent to all executors (16 MB), beyond it the join shuffles.
SENT_KEYS = 1_000_000
_FACTORS = mixed(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """Distinct shingle hashes of some texts, ascending in each, and where each text's begin."""
    hashes, where = shingle_hashes(*word_hashes(data, offsets), size)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(where))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(offsets)))


def signatures(hashes: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The minima of every set, 32 bits each; of an empty set the largest value."""
    full = np.flatnonzero(np.diff(where))
    out = np.full((len(where) - 1, MINIMA), 0xFFFFFFFF, "<u4")
    if len(full):
        product = np.empty_like(hashes)
        for number, factor in enumerate(_FACTORS):
            np.multiply(hashes, factor, out=product)
            out[full, number] = np.minimum.reduceat(product, where[full]) >> np.uint64(32)
    return out


def described(docs: DataFrame, key: str) -> DataFrame:
    """Per row: key, set size, two 64-bit sums that name the set, and its signature."""

    def describe(batches):
        keep_freed_arrays()
        for batch in batches:
            for first, end, data, offsets in text_rounds(batch.column(1), ROUND_BYTES):
                hashes, where = shingle_sets(data, offsets)
                sums = []
                for salt in (1, 2):
                    total = np.zeros(len(hashes) + 1, np.uint64)  # whole numbers throughout: equal sets, equal sums
                    np.cumsum(mixed(hashes + np.uint64(salt)), out=total[1:])
                    sums.append((total[where[1:]] - total[where[:-1]]).view(np.int64))
                signed = signatures(hashes, where)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:end],
                        pa.array(np.diff(where)),
                        *map(pa.array, sums),
                        pa.array([row.tobytes() for row in signed], pa.binary()),
                    ],
                    names=["id", "n", "name1", "name2", "signature"],
                )

    given = need(docs, key, "text").select(F.col(key).cast("bigint").alias("id"), "text")
    return given.mapInArrow(describe, schema("id bigint, n bigint, name1 bigint, name2 bigint, signature binary"))


def regions_of(minima: np.ndarray) -> np.ndarray:
    """The region of every signature in every tree."""
    minima = minima.reshape(-1, TREES, DEPTH)
    region = np.broadcast_to(np.arange(TREES, dtype=np.uint64), minima.shape[:2])
    for level in range(LEAST_DEPTH):
        region = mixed(region * np.uint64(31) + minima[:, :, level])
    return region


def forest_rows(classes: DataFrame) -> DataFrame:
    """A row for each class and tree: the region it lies in, and its next minimum for the order."""

    def grow(batches):
        for batch in batches:
            minima = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u4").reshape(-1, MINIMA)
            regions = regions_of(minima)
            for tree in range(TREES):
                deeper = minima[:, tree * DEPTH + LEAST_DEPTH].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:2],
                        pa.array(np.full(len(minima), tree, np.int32)),
                        pa.array(np.ascontiguousarray(regions[:, tree]).view(np.int64)),
                        pa.array(deeper),
                    ],
                    names=["id", "n", "tree", "region", "deeper"],
                )

    columns = schema("id bigint, n bigint, tree int, region bigint, deeper bigint")
    return classes.select("id", "n", "signature").mapInArrow(grow, columns)


def sketches_of(classes: DataFrame) -> DataFrame:
    """Per class: one byte of each minimum, and four bytes of its region in each tree."""

    def draw(batches):
        for batch in batches:
            minima = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(-1, MINIMA)
            low, high = minima.astype(np.uint8), (regions_of(minima) >> np.uint64(32)).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([row.tobytes() for row in x], pa.binary()) for x in (low, high))],
                names=["id", "sketch", "regions"],
            )

    return classes.select("id", "signature").mapInArrow(draw, schema("id bigint, sketch binary, regions binary"))


def whole_groups(batches, keys: int):
    """Batches cut so that rows equal in the first ``keys`` columns stay together (input sorted)."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        columns = [held.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        other = np.flatnonzero(np.any([c != c[-1] for c in columns], axis=0))
        if len(other) and other[-1] + 1 < held.num_rows:
            yield held.slice(0, other[-1] + 1)
            held = held.slice(other[-1] + 1)
    if held is not None:
        yield held


def neighbours(rows: DataFrame, reach: int, least: float) -> DataFrame:
    """For each id with a partner close to it in a block: the best and the smallest one, a row each.

    ``rows`` has region, block, deeper, id, sketch.  Up to ``reach`` places apart in sorted order are
    compared; a partner's sketch agrees in a share of ``least``.  Columns: a, the best b, how well it
    agrees, and the smallest.
    """

    def compare(batches):
        for batch in whole_groups(batches, 2):
            region, block, ids = (batch.column(i).to_numpy() for i in (0, 1, 3))
            sketch = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, MINIMA)
            best, partner = np.full(len(ids), -1.0), np.zeros(len(ids), np.int64)
            smallest = np.full(len(ids), np.iinfo(np.int64).max)
            for apart in range(1, min(reach, len(ids) - 1) + 1):
                same = (region[apart:] == region[:-apart]) & (block[apart:] == block[:-apart])
                left = np.flatnonzero(same & (ids[apart:] != ids[:-apart]))
                agreed = (sketch[left] == sketch[left + apart]).mean(1)
                left, agreed = left[agreed >= least], agreed[agreed >= least]
                for one, two in ((left, left + apart), (left + apart, left)):
                    better = agreed > best[one]
                    best[one] = np.where(better, agreed, best[one])
                    partner[one] = np.where(better, ids[two], partner[one])
                    smallest[one] = np.minimum(smallest[one], ids[two])
            has = np.flatnonzero(best >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[has]) for x in (ids, partner, best, smallest)], names=["a", "b", "agreed", "smallest"]
            )

    columns = ("region", "block", "deeper", "id", "sketch")
    placed = rows.select(*columns).repartition("region", "block").sortWithinPartitions("region", "block", "deeper", "id")
    return placed.mapInArrow(compare, schema("a bigint, b bigint, agreed double, smallest bigint"))


#: Columns of the whole comparison; a block is a region and two of its groups.
BLOCK_COLUMNS = "region bigint, x bigint, y bigint, id bigint, own bigint, part bigint, n bigint, tree int, sketch binary, regions binary"


class Block:
    """Rows of one block of the whole comparison, and which later rows each may be linked with."""

    def __init__(self, rows, percent: int):
        own, part, self.n, tree = (rows.column(i).to_numpy() for i in (4, 5, 6, 7))
        self.sketch, self.regions = (
            np.frombuffer(b"".join(rows.column(i).to_pylist()), kind).reshape(len(own), -1) for i, kind in ((8, np.uint8), (9, "<u4"))
        )
        self.own, self.tree, self.percent = own, int(tree[0]), percent
        self.one_group = rows.column(1)[0].as_py() == rows.column(2)[0].as_py()
        self.root = np.unique(part, return_inverse=True)[1]

    def partners(self, i: int, least: float) -> np.ndarray:
        """Later rows of other components that the sizes and sketches leave open and no earlier tree has met."""
        small, large = np.minimum(self.n[i], self.n[i + 1 :]), np.maximum(self.n[i], self.n[i + 1 :])
        fit = (self.root[i + 1 :] != self.root[i]) & (small > 0) & (100 * small >= self.percent * large)
        if not self.one_group:
            fit &= self.own[i + 1 :] != self.own[i]
        at = np.flatnonzero(fit) + i + 1
        at = at[(self.sketch[at] == self.sketch[i]).mean(1) >= least]
        return at[~(self.regions[at, : self.tree] == self.regions[i, : self.tree]).any(1)]


def blocks_of(batches):
    """The rows of each block, with more than one component and without repeated ids (input sorted)."""
    for batch in whole_groups(batches, 3):
        keys = [batch.column(i).to_numpy() for i in range(4)]
        new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
        if not new.all():
            batch = batch.take(pa.array(np.flatnonzero(new)))
            keys = [k[new] for k in keys]
        begins = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys[:3]], axis=0)])
        for first, end in zip(begins, np.r_[begins[1:], len(keys[0])]):
            part = batch.column(5).to_numpy()[first:end]
            if (part != part[0]).any():
                yield batch.slice(first, end - first)


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("region", "x", "y").sortWithinPartitions("region", "x", "y", "id")


def with_partners(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of the whole comparison that have at least one partner in their block by signature."""
    least = percent / 100 - SLACK

    def mark(batches):
        for rows in blocks_of(batches):
            block, has = Block(rows, percent), np.zeros(rows.num_rows, bool)
            for i in range(rows.num_rows - 1):
                at = block.partners(i, least)
                has[at] = True
                has[i] |= len(at) > 0
            if has.any():
                yield rows.take(pa.array(np.flatnonzero(has)))

    kinds = schema(BLOCK_COLUMNS)
    return _by_block(rows.select(*kinds.names)).mapInArrow(mark, kinds)


def linked_in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that tie components of a block, found on the full sets in the column ``shingles``."""
    least = percent / 100 - SLACK

    def link(batches):
        for rows in blocks_of(batches):
            block, ids = Block(rows, percent), rows.column(3).to_numpy()
            sets = rows.column(10).to_pylist()
            block.n = np.array([len(s) // 8 for s in sets])
            where = np.r_[0, np.cumsum(block.n)]
            number = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)[1]
            inside = np.zeros(int(number.max(initial=0)) + 1, bool)
            ties = []
            for i in range(len(ids) - 1):
                at = block.partners(i, least)
                if not len(at):
                    continue
                inside[number[where[i] : where[i + 1]]] = True
                begins = np.cumsum(block.n[at]) - block.n[at]
                own = np.repeat(where[at] - begins, block.n[at]) + np.arange(block.n[at].sum())
                both = np.add.reduceat(inside[number[own]].astype(np.int64), begins)
                inside[number[where[i] : where[i + 1]]] = False
                for j in at[100 * both >= percent * (block.n[i] + block.n[at] - both)]:
                    if block.root[i] != block.root[j]:
                        ties.append((i, j))
                        block.root[block.root == block.root[j]] = block.root[i]
            if ties:
                a, b = np.array(ties).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    kinds = schema(BLOCK_COLUMNS)
    return _by_block(rows.select(*kinds.names, "shingles")).mapInArrow(link, schema("a bigint, b bigint"))


def sets_of(docs: DataFrame, key: str, concerned: DataFrame) -> DataFrame:
    """The full shingle sets of some documents: id and the hashes as bytes."""

    def make(batches):
        keep_freed_arrays()
        for batch in batches:
            for first, end, data, offsets in text_rounds(batch.column(1), ROUND_BYTES):
                hashes, where = shingle_sets(data, offsets)
                blobs = [hashes[a:b].tobytes() for a, b in zip(where[:-1], where[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:end], pa.array(blobs, pa.binary())], names=["id", "shingles"])

    texts = need(docs, key, "text").select(F.col(key).cast("bigint").alias("id"), "text")
    return texts.join(concerned, "id", "left_semi").mapInArrow(make, schema("id bigint, shingles binary"))


def _sent(ids: DataFrame) -> DataFrame:
    """These ids, written, and to be sent to all executors if they are few."""
    ids = materialize(ids, "concerned")
    return F.broadcast(ids) if ids.count() <= SENT_KEYS else ids


def confirmed(docs: DataFrame, key: str, pairs: DataFrame, percent: int) -> DataFrame:
    """Those pairs whose full shingle sets have the similarity asked for."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("id"))
    concerned = _sent(ends.select("id").distinct())
    texts = need(docs, key, "text").select(F.col(key).cast("bigint").alias("id"), "text")
    texts = texts.join(concerned, "id", "left_semi").join(ends, "id")

    def check(batches):
        keep_freed_arrays()
        for batch in whole_groups(batches, 2):
            a, b, ids = (batch.column(i).to_numpy() for i in range(3))
            # A row that repeats a document is left out: the first of each end is enough.
            first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (ids[1:] != ids[:-1])]
            rows = np.flatnonzero(first)
            good = np.zeros(len(rows) // 2, bool)
            place = 0
            for _, _, data, offsets in text_rounds_in_pairs(batch.column(3).take(pa.array(rows))):
                hashes, where = shingle_sets(data, offsets)
                for left in range(0, len(where) - 1, 2):
                    one, two = hashes[where[left] : where[left + 1]], hashes[where[left + 1] : where[left + 2]]
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    good[place] = 100 * both >= percent * (len(one) + len(two) - both) and both > 0
                    place += 1
            rows = rows[::2][good]
            yield pa.RecordBatch.from_arrays([pa.array(a[rows]), pa.array(b[rows])], names=["a", "b"])

    paired = texts.select("a", "b", "id", "text").repartition("a", "b").sortWithinPartitions("a", "b", "id")
    return paired.mapInArrow(check, schema("a bigint, b bigint"))


def text_rounds_in_pairs(column: pa.Array):
    """Rounds of an even number of texts."""
    for start in range(0, len(column), 256):
        yield next(iter(_one_round(column.slice(start, 256))))


def _one_round(column: pa.Array):
    parts = list(text_rounds(column, ROUND_BYTES))
    shifts = np.cumsum([0] + [len(p[2]) for p in parts])
    offsets = np.concatenate([[0]] + [p[3][1:] + s for p, s in zip(parts, shifts)])
    yield 0, len(column), np.concatenate([p[2] for p in parts]), offsets.astype(np.int64)


def near_duplicates(docs: DataFrame, key: str = "doc_id", percent: int = 75) -> DataFrame:
    """One row per row: its key, set size, component (smallest key reachable) and whether it stays.

    Documents are linked when their sets share ``percent`` hundredths of their union.  Words are runs
    of anything but ASCII white space, A-Z lower-cased.  A document of fewer than five words has its
    whole sequence as one shingle; one without words, or with a null text, is linked with nothing.
    Rows that repeat a key are one document (its text must be the same) and each get its row; a row
    with a null key is linked with nothing, has no component and does not stay.  An empty table gives
    an empty result.
    """
    rows = materialize(described(docs, key), "signatures")
    named = rows.where("n > 0 and id is not null")
    classes = named.groupBy("name1", "name2").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.min("signature").alias("signature"))
    classes = materialize(classes, "classes")
    forest = forest_rows(classes)
    crowds = forest.groupBy("region").agg(F.count("*").alias("crowd")).where("crowd > 1")
    members = materialize(forest.join(crowds, "region"), "forest")
    sketches = sketches_of(classes)
    least = percent / 100 - SLACK
    blocks = F.ceil(F.col("crowd") / REGION)
    near = members.withColumn("block", F.pmod(F.xxhash64("id", "region"), blocks)).join(sketches, "id")
    found = neighbours(near, NEIGHBOURS, least)
    chosen = found.groupBy(F.col("a").alias("id")).agg(
        F.max(F.struct("agreed", -F.col("b"))).alias("best"), F.min("smallest").alias("smallest")
    )
    partner = F.explode(F.array(-F.col("best")["col2"], F.col("smallest"))).alias("partner")
    pairs = chosen.select("id", partner).select(F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b"))
    pairs = materialize(pairs.distinct(), "pairs")
    links = materialize(confirmed(docs, key, pairs, percent), "confirmed")
    roots = components(links)

    # What shares a region and not a component yet.
    open_rows = materialize(with_partners(_in_blocks(members, roots).join(sketches, "id"), percent), "open")
    sets = materialize(sets_of(docs, key, _sent(open_rows.select("id").distinct())), "sets")
    more = materialize(linked_in_blocks(open_rows.join(sets, "id"), percent), "confirmed")
    if not more.isEmpty():
        roots = components(roots.select(F.col("vertex").alias("a"), F.col("root").alias("b")).union(more))

    classed = classes.select("name1", "name2", F.col("id").alias("class")).join(
        roots.withColumnRenamed("vertex", "class"), "class", "left"
    )
    classed = classed.select("name1", "name2", F.coalesce("root", "class").alias("component"))
    own = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return rows.join(classed, ["name1", "name2"], "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.coalesce(own == F.col("id"), F.lit(False)).alias("kept"),
    )


def _in_blocks(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of regions that hold more than one component, dealt to blocks of two groups.

    The rows of the largest component of a region are dealt to groups, and so are all others.  A group
    of others meets itself and every group; groups of the largest component don't meet each other.
    """
    parts = members.join(roots.withColumnRenamed("vertex", "id"), "id", "left")
    parts = parts.withColumn("part", F.coalesce("root", "id")).drop("root")
    shares = parts.groupBy("region", "part").agg(F.count("*").alias("rows"), F.sum("n").alias("size"))
    totals = shares.groupBy("region").agg(
        F.count("*").alias("parts"),
        F.sum("rows").alias("rows"),
        F.sum("size").alias("size"),
        F.max(F.struct("rows", "part", "size")).alias("first"),
    )

    def groups(rows, size):
        return F.greatest(F.ceil(rows / GROUP), F.ceil(size / GROUP_SHINGLES))

    first = F.col("first")
    dealt = totals.where("parts > 1").select(
        "region",
        first["part"].alias("leading"),
        groups(first["rows"], first["size"]).alias("leads"),
        groups(F.col("rows") - first["rows"], F.col("size") - first["size"]).alias("others"),
    )
    rows = parts.join(dealt, "region").withColumn("leads_here", F.col("part") == F.col("leading"))
    place = F.xxhash64("id", "region")
    own = F.when(F.col("leads_here"), F.pmod(place, "leads")).otherwise(F.col("leads") + F.pmod(place, "others"))
    met = F.sequence(F.when(F.col("leads_here"), F.col("leads")).otherwise(F.lit(0)), F.col("leads") + F.col("others") - 1)
    rows = rows.withColumn("own", own).withColumn("met", F.explode(met))
    return rows.select(
        "region", F.least("own", "met").alias("x"), F.greatest("own", "met").alias("y"), "id", "own", "part", "n", "tree"
    )
