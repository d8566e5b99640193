"""Suffix-array dedup with a run-length index: bytes covered by strings that an earlier document has.

Whether a string of ``LENGTH`` bytes repeats is settled where all its occurrences meet.  Every window
of that length is named by the smallest hash of the ``GRAM``-byte strings in it, so equal windows have
equal names wherever they stand.  Consecutive windows of one name are one piece of text.

1.  Documents are dealt to blocks by hash.  A block tells each bucket which names it has; a bucket
    answers with the names that several blocks have.  All other pieces are unique and go no further.
2.  A block sends the distinct pieces whose names repeat, each with its smallest document, to the
    buckets of their names.  However often a piece occurs in a block, it is sent once.
3.  A bucket indexes the pieces of names that have more than one: it sorts their suffixes, takes the
    Burrows-Wheeler transform, and keeps of the suffix array only the samples at the ends of its runs.
    From these, neighbour and common prefix of every suffix are streamed in text order (between two
    samples the neighbour moves on by one and the prefix shrinks by one).  Windows whose common prefix
    with the neighbour is long enough are tied to it, and the smallest document of a tie is found.
4.  A block marks, in its own documents, the windows whose smallest document is a smaller one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import buckets_for, keep_freed_arrays, mixed, need, schema, text_rounds

# Bytes of a string that counts, and of the grams that name its windows, three words of eight.
LENGTH, GRAM = 50, 24
_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]
#: Windows of a piece at most, and bytes of text in a block.
LONGEST, BLOCK_BYTES = 35, 4_000_000
#: Bytes of text of which pieces are made at a time: the arrays of a round stay in a core's cache.
ROUND_BYTES = 125_000


def pieces(data: np.ndarray, offsets: np.ndarray, length: int):
    """First byte, number of windows, name and text number of the pieces of some texts."""
    windows = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if windows <= 0:
        return none, none, none.view(np.uint64), none
    grams = data.astype(np.uint64)
    for width in (1, 2, 4):
        grams = grams[:-width] | grams[width:] << np.uint64(8 * width)
    lowest = np.zeros(len(data) - GRAM + 1, np.uint64)
    for number, factor in enumerate(_FACTORS):
        lowest += grams[8 * number : 8 * number + len(lowest)] * factor
    lowest = mixed(lowest)
    wanted, span = length - GRAM + 1, 1
    while span < wanted:
        step = min(span, wanted - span)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        span += step
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    at = np.flatnonzero(offsets[1:][text] - np.arange(windows) >= length)
    if not len(at):
        return none, none, none.view(np.uint64), none
    name = lowest[at]
    first = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (at[1:] != at[:-1] + 1)])
    count = np.diff(np.r_[first, len(at)])
    parts = -(-count // LONGEST)
    part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(at[first], parts) + part * LONGEST
    count = np.minimum(np.repeat(count, parts) - part * LONGEST, LONGEST)
    return start, count, mixed(np.repeat(name[first], parts)), text[start]


#: The number of a bucket has 24 bits: at 4 MB a block that is 67 TB of text, beyond it blocks must be larger.
MOST_BLOCKS = 1 << 24


def named(names: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper 24 bits, 40 bits of the name below."""
    return (names % np.uint64(buckets)) << np.uint64(40) | names >> np.uint64(24)


def packed(names: np.ndarray) -> bytes:
    """The 40-bit parts, five bytes each."""
    return np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def run_length_index(text: np.ndarray, bounds: np.ndarray):
    """Samples (position, neighbour, common prefix) at the run ends of the transform of some strings.

    ``bounds`` has the first byte of each string and the end.  Every string ends in a sign of its own,
    smaller than any byte and ordered as the strings are.  Samples are ascending by position.
    """
    n, sizes = len(text), np.diff(bounds)
    left = np.repeat(bounds[1:], sizes) - np.arange(n)  # bytes to the end of the string
    bits = int(n).bit_length()
    # The eight bytes from each byte on, and the first few of them with how many are in the string:
    # an end sorts before any byte, also 0.
    held = np.zeros(n + 8, np.uint8)
    held[:n] = text
    eight = np.ndarray((n + 1,), "<u8", held, strides=(1,))
    depth = min(7, (61 - bits) // 8)
    key = eight[:n].byteswap() >> np.uint64(64 - 8 * depth)
    short = np.flatnonzero(left < depth)
    beyond = (8 * (depth - left[short])).astype(np.uint64)
    key[short] = key[short] >> beyond << beyond
    key = key << np.uint64(3) | np.minimum(left, depth).astype(np.uint64)
    # The rank of a suffix is the number of smaller ones; only tied suffixes are sorted on.
    rank, tied = _ranks(key, 8 * depth + 3, np.arange(n), None, bits)
    longest = int(sizes.max(initial=0))
    while depth < longest and len(tied):
        later = np.zeros(len(tied), np.uint64)
        inside = left[tied] > depth
        later[inside] = rank[tied[inside] + depth] + np.uint64(1)
        rank, tied = _ranks(rank[tied] << np.uint64(bits) | later, 2 * bits, tied, rank, bits)
        depth *= 2
    # Equal suffixes that end together are in the order of their strings.
    order = np.empty(n, np.int64)
    place = rank.astype(np.int64)
    tied = tied[np.lexsort((tied, place[tied]))]
    same = np.r_[False, place[tied][1:] == place[tied][:-1]] if len(tied) else np.zeros(0, bool)
    count = np.arange(len(tied))
    place[tied] += count - np.maximum.accumulate(np.where(same, 0, count))
    order[place] = np.arange(n)
    before = text[order - 1].astype(np.int64)
    at_start = np.zeros(n, bool)
    at_start[bounds[:-1]] = True
    before[at_start[order]] = -1 - order[at_start[order]]  # the signs all differ
    heads = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
    position = order[heads]
    neighbour = np.where(heads > 0, order[heads - 1], -1)
    prefix = np.zeros(len(heads), np.int64)
    going, reached = np.flatnonzero(heads > 0), 0
    while len(going):  # eight bytes at a time, only those that agreed so far
        differ = eight[position[going] + reached] ^ eight[neighbour[going] + reached]
        room = np.minimum(left[position[going]], left[neighbour[going]])
        on = (differ == 0) & (room > reached + 8)
        ended, differ = going[~on], differ[~on]
        agreed = np.zeros(len(ended), np.int64)
        for k in range(1, 9):
            agreed += differ << np.uint64(64 - 8 * k) == 0
        prefix[ended] = np.minimum(reached + agreed, room[~on])
        going, reached = going[on], reached + 8
    by_text = np.argsort(position)
    return position[by_text], neighbour[by_text], prefix[by_text]


def _ranks(key: np.ndarray, width: int, at: np.ndarray, rank: np.ndarray | None, bits: int):
    """Ranks with those of ``at`` settled by ``key``, and which of these are tied still.

    Of suffixes ranked before, the key has their rank above its lower ``bits``.
    """
    own = int(len(key)).bit_length()
    if width + own <= 64:  # number and key in one word sort several times faster
        both = np.sort(key << np.uint64(own) | np.arange(len(key), dtype=np.uint64))
        order = (both & np.uint64((1 << own) - 1)).astype(np.int64)
        key = both >> np.uint64(own)
    else:
        order = np.argsort(key)
        key = key[order]
    at = at[order]
    number = np.arange(len(key))
    new = np.r_[True, key[1:] != key[:-1]]
    first = np.maximum.accumulate(np.where(new, number, 0))
    if rank is None:
        rank, value = np.empty(len(key), np.uint64), first.astype(np.uint64)
    else:
        group = key >> np.uint64(bits)
        begun = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], number, 0))
        value = group + (first - begun).astype(np.uint64)
    rank[at] = value
    return rank, at[~new | np.r_[~new[1:], False]]


def smallest_documents(text: np.ndarray, bounds: np.ndarray, documents: np.ndarray, length: int) -> np.ndarray:
    """For each byte of the strings, the smallest document of any window equal to the one there.

    ``documents`` has one for each string.  Of use only where a window fits in the string.
    """
    position, neighbour, prefix = run_length_index(text, bounds)
    n, sizes = len(text), np.diff(bounds)
    lowest = np.repeat(documents, sizes)
    sampled = np.zeros(n, bool)
    sampled[position] = True
    sample = np.cumsum(sampled) - 1
    moved = np.arange(n) - position[sample]
    tied = np.flatnonzero(prefix[sample] - moved >= length)
    root = np.arange(n)
    root[tied] = neighbour[sample[tied]] + moved[tied]
    while ((further := root[root[tied]]) != root[tied]).any():
        root[tied] = further
    # Of a tie, those that a window fits into count; the root itself is one of them.
    concerned = np.unique(np.r_[tied, root[tied]])
    fits = concerned[np.repeat(bounds[1:], sizes)[concerned] - concerned >= length]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, root[fits], lowest[fits])
    lowest[fits] = least[root[fits]]
    return lowest


class _Block:
    """Pieces of the documents of one block."""

    def __init__(self, table: pa.Table, buckets: int, length: int):
        keep_freed_arrays()
        self.documents = table.column("doc").to_numpy()
        self.rounds = []
        for first, end, data, offsets in text_rounds(table.column("text"), ROUND_BYTES):
            start, count, names, text = pieces(data, offsets, length)
            self.rounds.append((first, end, data, offsets, start, count, named(names, buckets), text))
        self.names = np.concatenate([np.zeros(0, np.uint64), *[r[6] for r in self.rounds]])
        self.length = length

    def distinct(self, answered: np.ndarray):
        """Distinct repeated pieces by name and bytes, with name and smallest document, and per round
        which of its pieces these are, and the number of each."""
        seen, times = np.unique(self.names, return_counts=True)
        repeated = np.union1d(seen[times > 1], answered)
        lowest: dict[tuple[int, bytes], int] = {}
        found = []
        for first, _, data, _, start, count, names, text in self.rounds:
            if not len(repeated):
                break
            at = np.minimum(np.searchsorted(repeated, names), len(repeated) - 1)
            own = np.flatnonzero(repeated[at] == names)
            raw, ends = data.tobytes(), start[own] + count[own] + self.length - 1
            keys = [(name, raw[a:b]) for name, a, b in zip(names[own].tolist(), start[own].tolist(), ends.tolist())]
            for key, document in zip(keys, self.documents[first + text[own]].tolist()):
                if document < lowest.get(key, document + 1):
                    lowest[key] = document
            found.append((own, keys))
        order = sorted(lowest)
        number = {key: i for i, key in enumerate(order)}
        found = [(own, np.array([number[k] for k in keys], np.int64)) for own, keys in found]
        return order, [lowest[k] for k in order], found


def find_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES,
    carry: tuple[str, ...] = (),
    whole_characters: bool = False,
) -> DataFrame:
    """One row per document: key, bytes, removed spans (start and end bytes) and what is kept, as bytes.

    A byte is removed if a string of ``length`` bytes that covers it also stands in a document with a
    smaller key; strings are judged on the input.  Texts are UTF-8 bytes, a null text is empty; what
    is kept may begin or end inside a character.  Texts shorter than ``length`` are kept.  Rows that
    repeat a key do not count against each other.  A row with a null key is kept whole and counts
    against none.  An empty table gives an empty result.  Columns named in ``carry`` follow.
    With ``whole_characters`` what is kept is a text, and of a character that was cut in part nothing stays.
    """
    blocks = buckets_for(docs, "text", block_bytes)
    if blocks > MOST_BLOCKS:
        raise ValueError(f"{blocks} blocks are more than {MOST_BLOCKS}: take a larger block_bytes")
    carried = [f"carried {i}" for i in range(len(carry))]
    given = need(docs, key, "text", *carry).toDF("doc", "text", *carried).withColumn("doc", F.col("doc").cast("bigint"))
    # The same exchange serves all three passes over the text.
    block = F.pmod(F.xxhash64("doc", F.octet_length("text")), F.lit(blocks)).cast("int")
    dealt = given.where("doc is not null").withColumn("block", block).repartition(blocks, "block")

    def tell(table: pa.Table) -> pa.Table:
        own = _Block(table, blocks, length)
        return _by_bucket(np.unique(own.names), table.column("block")[0].as_py(), blocks)

    told = dealt.groupBy("block").applyInArrow(tell, schema("bucket int, block int, names binary"))

    def answer(table: pa.Table) -> pa.Table:
        lists = [unpacked(x) for x in table.column("names").to_pylist()]
        seen, times = np.unique(np.concatenate(lists), return_counts=True)
        several = seen[times > 1]
        bucket = table.column("bucket")[0].as_py()
        replies = [packed(x[np.isin(x, several, assume_unique=True)]) for x in lists]
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": pa.array([bucket] * len(lists), pa.int32()),
                "names": pa.array(replies, pa.binary()),
                "counts": pa.nulls(len(lists), pa.binary()),
                "documents": pa.nulls(len(lists), pa.binary()),
            }
        )

    reply = "block int, bucket int, names binary, counts binary, documents binary"
    answered = told.groupBy("bucket").applyInArrow(answer, schema(reply))

    def send(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = {"bucket": [], "block": [], "names": [], "sizes": [], "bytes": [], "documents": []}
        if table.num_rows:
            order, lowest, _ = _Block(table, blocks, length).distinct(_answers(replies))
            bucket_of = np.array([name >> 40 for name, _ in order], np.int64)
            edges = np.flatnonzero(np.r_[True, bucket_of[1:] != bucket_of[:-1], True]) if len(order) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                strings = [x for _, x in order[a:b]]
                rows["bucket"].append(int(bucket_of[a]))
                rows["block"].append(table.column("block")[0].as_py())
                rows["names"].append(packed(np.array([n for n, _ in order[a:b]], np.uint64)))
                rows["sizes"].append(np.array([len(x) for x in strings], "<u2").tobytes())
                rows["bytes"].append(b"".join(strings))
                rows["documents"].append(np.array(lowest[a:b], "<i8").tobytes())
        return pa.table(rows, pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *[(c, pa.binary()) for c in ("names", "sizes", "bytes", "documents")]]))

    sent = dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        send, schema("bucket int, block int, names binary, sizes binary, bytes binary, documents binary")
    )

    def settle(table: pa.Table) -> pa.Table:
        keep_freed_arrays()
        counts, documents = settled(
            [unpacked(x) for x in table.column("names").to_pylist()],
            [np.frombuffer(x, "<u2") for x in table.column("sizes").to_pylist()],
            table.column("bytes").to_pylist(),
            [np.frombuffer(x, "<i8") for x in table.column("documents").to_pylist()],
            length,
        )
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "names": pa.nulls(table.num_rows, pa.binary()),
                "counts": pa.array(counts, pa.binary()),
                "documents": pa.array(documents, pa.binary()),
            }
        )

    settled_rows = sent.groupBy("bucket").applyInArrow(settle, schema(reply))

    def mark(table: pa.Table, replies: pa.Table) -> pa.Table:
        result = {"doc": [], "n_bytes": [], "starts": [], "ends": [], "kept": []}
        if table.num_rows:
            own = _Block(table, blocks, length)
            order, _, found = own.distinct(_answers(replies))
            lowest = _window_documents(replies)
            windows = np.array([len(x) - length + 1 for _, x in order], np.int64)
            first_window = np.cumsum(windows) - windows
            for number, (first, end, data, offsets, start, count, _, text) in enumerate(own.rounds):
                cover = np.zeros(len(data) + 1, np.int32)
                if number < len(found):
                    rows, piece = found[number]
                    size = count[rows]
                    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    at = np.repeat(start[rows], size) + step
                    document = np.repeat(own.documents[first + text[rows]], size)
                    at = at[lowest[np.repeat(first_window[piece], size) + step] < document]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + length, -1)
                gone = np.cumsum(cover[:-1]) > 0
                for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                    edge = np.flatnonzero(np.diff(np.r_[False, gone[a:b], False]))
                    result["doc"].append(int(own.documents[first + row]))
                    result["n_bytes"].append(int(b - a))
                    result["starts"].append(edge[::2].tolist())
                    result["ends"].append(edge[1::2].tolist())
                    kept = data[a:b][~gone[a:b]].tobytes()
                    result["kept"].append(kept.decode("utf-8", "ignore") if whole_characters else kept)
        longs = pa.list_(pa.int64())
        kind = pa.string() if whole_characters else pa.binary()
        out = pa.table(result, pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("starts", longs), ("ends", longs), ("kept", kind)]))
        for column in carried:
            out = out.append_column(column, table.column(column))
        return out

    kept_as = "string" if whole_characters else "binary"
    marked = dealt.groupBy("block").cogroup(answered.union(settled_rows).groupBy("block")).applyInArrow(
        mark,
        T.StructType(
            [
                *schema(f"doc bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept {kept_as}").fields,
                *(T.StructField(c, given.schema[c].dataType) for c in carried),
            ]
        ),
    )
    text = F.coalesce("text", F.lit(""))
    nothing = F.array().cast("array<bigint>")
    unnamed = given.where("doc is null").select(
        "doc", F.octet_length(text).cast("bigint"), nothing, nothing, text.cast(kept_as), *map(F.col, carried)
    )
    return marked.union(unnamed).toDF(key, "n_bytes", "starts", "ends", "kept", *carry)


def cut_texts(docs: DataFrame, key: str = "doc_id", carry: tuple[str, ...] = (), size: str = "n_bytes", **options) -> DataFrame:
    """Key, text without the repeats of ``find_repeats``, bytes before (named ``size``), carried columns.

    Of a character that was cut in part nothing stays.  Null texts come back empty.  The texts are made where
    they are cut: a second Python function in the stage would be a second Python process for every task.
    """
    names = [f"carried {i}" for i in range(len(carry))]
    found = find_repeats(docs, key, carry=carry, whole_characters=True, **options)
    found = found.toDF("key", "size", "starts", "ends", "kept", *names)
    return found.select("key", "kept", "size", *names).toDF(key, "text", size, *carry)


def removed_bytes() -> Column:
    """How many bytes the spans of a row of ``find_repeats`` cover."""
    return F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("bigint"), lambda a, b: a + b)


def _by_bucket(names: np.ndarray, block: int, buckets: int) -> pa.Table:
    edges = np.searchsorted(names, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(40))
    full = [b for b in range(buckets) if edges[b] < edges[b + 1]]
    return pa.table(
        {
            "bucket": pa.array(full, pa.int32()),
            "block": pa.array([block] * len(full), pa.int32()),
            "names": pa.array([packed(names[edges[b] : edges[b + 1]]) for b in full], pa.binary()),
        }
    )


def _answers(replies: pa.Table) -> np.ndarray:
    """Repeated names of a block, from the answers of all buckets."""
    lists = [np.zeros(0, np.uint64)]
    for bucket, blob in zip(replies.column("bucket").to_pylist(), replies.column("names").to_pylist()):
        if blob is not None:
            lists.append(unpacked(blob) | np.uint64(bucket) << np.uint64(40))
    return np.concatenate(lists)


def _window_documents(replies: pa.Table) -> np.ndarray:
    """Smallest documents of all windows of a block's distinct pieces, in their order."""
    settled_ = [x for x in replies.to_pylist() if x["counts"] is not None]
    settled_.sort(key=lambda x: x["bucket"])
    counts = np.frombuffer(b"".join(x["counts"] for x in settled_), np.uint8)
    return np.repeat(np.frombuffer(b"".join(x["documents"] for x in settled_), "<i8"), counts)


def settled(names, sizes, strings, documents, length: int):
    """For each block's pieces in a bucket, runs of (windows, smallest document), as blobs.

    Pieces of a name that all blocks agree on have one document throughout.  The others are indexed.
    """
    number: dict[bytes, int] = {}
    of_block, lowest, name_of = [], [], []
    for own_names, own_sizes, blob, own in zip(names, sizes, strings, documents):
        ends = np.cumsum(own_sizes.astype(np.int64))
        row = np.empty(len(ends), np.int64)
        for i, (a, b, name, document) in enumerate(zip((ends - own_sizes).tolist(), ends.tolist(), own_names.tolist(), own.tolist())):
            piece = blob[a:b]
            at = number.setdefault(piece, len(number))
            if at == len(lowest):
                lowest.append(document)
                name_of.append(name)
            elif document < lowest[at]:
                lowest[at] = document
            row[i] = at
        of_block.append(row)
    lowest_of, name_array = np.array(lowest, np.int64), np.array(name_of, np.uint64)
    pieces_ = list(number)
    windows = np.array([len(x) - length + 1 for x in pieces_], np.int64)
    _, same, times = np.unique(name_array, return_inverse=True, return_counts=True)
    varied = np.flatnonzero(times[same] > 1)
    runs, first = np.ones(len(pieces_), np.int64), np.zeros(len(pieces_) + 1, np.int64)
    if len(varied):
        text = np.frombuffer(b"".join(pieces_[i] for i in varied), np.uint8)
        sizes_ = windows[varied] + length - 1
        bounds = np.r_[0, np.cumsum(sizes_)]
        found = smallest_documents(text, bounds, lowest_of[varied], length)
        step = np.arange(len(text)) - np.repeat(bounds[:-1], sizes_)
        fits = step < np.repeat(windows[varied], sizes_)
        piece, found, step = np.repeat(varied, sizes_)[fits], found[fits], step[fits]
        new = np.flatnonzero((step == 0) | np.r_[True, found[1:] != found[:-1]])
        runs[varied] = np.bincount(piece[new], minlength=len(pieces_))[varied]
    first[1:] = np.cumsum(runs)
    count, document = np.zeros(first[-1], np.uint8), np.zeros(first[-1], np.int64)
    count[first[:-1]], document[first[:-1]] = windows, lowest_of
    if len(varied):
        slots = np.repeat(first[:-1][varied], runs[varied]) + np.arange(len(new)) - np.repeat(np.cumsum(runs[varied]) - runs[varied], runs[varied])
        count[slots], document[slots] = np.diff(np.r_[new, len(piece)]), found[new]
    blobs = [], []
    for row in of_block:
        at = np.repeat(first[row] - np.r_[0, np.cumsum(runs[row])[:-1]], runs[row]) + np.arange(runs[row].sum())
        blobs[0].append(count[at].tobytes())
        blobs[1].append(document[at].astype("<i8").tobytes())
    return blobs
