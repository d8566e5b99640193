"""Phrase collocations: words that stand together more often than their parts would by chance.

Texts are lower-cased (A-Z), cut in pieces at ``.,;:!?`` and line ends, and pieces in words at blanks and
tabs.  Everything is counted per language.  A phrase of 2 to 5 words is a candidate if it occurs ``least``
times; its score is the lowest over its cuts in two parts of 1000 a n / (l r), a, l and r the counts of
the phrase and of the parts and n all words of the language, rounded down.  A candidate inside a longer
one that occurs as often is dropped.

1.  Texts are dealt to batches of a few megabytes.  A batch hashes all n-grams of 1 to 5 words at once:
    sums of a polynomial over the hashes of its words, of which the fingerprint of any run is a
    difference.  It sends each fingerprint once, with its count, sorted and as compressed differences.
2.  Ranges of fingerprints add the counts.  The batches that sent a fingerprint are the pointers to its
    occurrences: each is told which of its fingerprints are frequent, and one of them to spell it.
3.  A batch finds the told fingerprints in its texts again and verifies every occurrence, word for word,
    against its first one; occurrences of another phrase are counted apart.  It answers with a second,
    independent fingerprint of what the text says, and one batch with the phrase itself.
4.  Ranges add the answers by both fingerprints.  Where a count has no phrase, because phrases of
    different batches collide in the first fingerprint, all batches spell what they hold of it and
    the strings are counted.  So counts are exact unless two phrases agree in 120 bits.
5.  Parts of a frequent phrase are frequent, so cuts are joins of the table of frequent phrases.

No group depends on a phrase: batches are dealt by key and text, ranges by fingerprint.  Products are
decimals of 38 digits, exact up to 1e16 words of a language.

Defined results.  A null text is empty, a null language is ``und``.  Null and repeated keys and repeated
rows all count.  Texts of any length are read whole; a phrase never crosses texts.  An empty table gives
no rows.  Ties of score and count go to the smaller phrase in byte order.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import buckets_for, mixed, need, schema, text_rounds
from tallyforge.llm.words import BASE, INVERSE, _power, byte_classes
from tallyforge.operators.materialize import materialize

LONGEST = 5
BATCH_BYTES = 4_000_000
#: Bits of a fingerprint.  More cost shuffled bytes, fewer make collisions, each of which is spelled again.
PRINT_BITS = 56
BREAKS = b".,;:!?\n\v\f\r"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_CLASSES = byte_classes([0x20, 0x09, *BREAKS])
_BREAKING = np.zeros(256, bool)
_BREAKING[list(BREAKS)] = True
#: The polynomial over words, another than that over the bytes of a word.
WORD_BASE = 0xD1342543DE82EF95
WORD_INVERSE = pow(WORD_BASE, -1, 2**64)


CHECK_BASE = 0xAF251AF3B0F025B5
CHECK_INVERSE = pow(CHECK_BASE, -1, 2**64)


def _of_words(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, inverse: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(inverse, len(values) + 1)[starts])


@dataclass
class Words:
    """The words of a batch in order: where they are in ``low``, their hashes, pieces and texts."""

    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    piece: np.ndarray
    text: np.ndarray
    #: Second hashes, of another polynomial, if asked for.
    checks: np.ndarray

    @classmethod
    def read(cls, column: pa.Array, checked: bool = False) -> Words:
        parts, shift, pieces = [], 0, 0
        for first, _, data, offsets in text_rounds(column):
            values = _CLASSES[data]
            inside = values != 0
            edge = np.zeros(len(data) + 1, bool)
            edge[offsets] = True
            begins, stops = inside.copy(), inside.copy()
            begins[1:] &= ~inside[:-1] | edge[1:-1]
            stops[:-1] &= ~inside[1:] | edge[1:-1]
            starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
            hashes = _of_words(values, starts, ends, BASE, INVERSE)
            checks = _of_words(values, starts, ends, CHECK_BASE, CHECK_INVERSE) if checked else hashes[:0]
            breaks = np.cumsum(_BREAKING[data] | edge[:-1])[starts]
            text = np.searchsorted(offsets, starts, side="right") - 1 + first
            parts.append((_LOWER[data], starts + shift, ends + shift, hashes, breaks + pieces, text, checks))
            shift, pieces = shift + len(data), pieces + len(data) + 1
        if not parts:
            none = np.zeros(0, np.int64)
            return cls(none.astype(np.uint8), none, none, none.astype(np.uint64), none, none, none.astype(np.uint64))
        return cls(*map(np.concatenate, zip(*parts)))

    def runs(self, tongues: np.ndarray):
        """(n, first words, fingerprints) of all runs of n words inside a piece, for each n.

        ``tongues`` is a number for the language of each text, part of the fingerprint.
        """
        count = len(self.hashes)
        sums = np.zeros(count + 1, np.uint64)
        np.cumsum(self.hashes * _power(WORD_BASE, count), out=sums[1:])
        back, tongue = _power(WORD_INVERSE, count), tongues[self.text]
        for n in range(1, LONGEST + 1):
            at = np.flatnonzero(self.piece[n - 1 :] == self.piece[: count - n + 1]) if count >= n else np.zeros(0, np.int64)
            prints = mixed((sums[at + n] - sums[at]) * back[at] + mixed(tongue[at] + np.uint64(n)))
            yield n, at, prints >> np.uint64(64 - PRINT_BITS)

    def checked(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Second fingerprints of runs."""
        sums = np.zeros(len(self.checks) + 1, np.uint64)
        np.cumsum(self.checks * _power(WORD_BASE, len(self.checks)), out=sums[1:])
        return mixed((sums[at + size] - sums[at]) * _power(WORD_INVERSE, len(self.checks))[at] + size.astype(np.uint64))

    def spelled(self, first: int, n: int) -> bytes:
        return b" ".join(self.low[self.starts[k] : self.ends[k]].tobytes() for k in range(first, first + n))

    def numbers(self) -> np.ndarray:
        """Equal numbers for equal words: by hash, each occurrence compared with the first byte for byte."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        size, model = self.ends - self.starts, first[number]

        def same(some: slice) -> bool:
            length = size[some]
            within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            one, other = (np.repeat(w, length) + within for w in (self.starts[some], self.starts[model[some]]))
            return bool((self.low[one] == self.low[other]).all())

        if (size == size[model]).all() and all(same(slice(k, k + 50_000)) for k in range(0, len(size), 50_000)):
            return number
        known: dict[bytes, int] = {}
        return np.array([known.setdefault(self.spelled(k, 1), len(known)) for k in range(len(size))], np.int64)


def packed(values: np.ndarray) -> bytes:
    """Numbers with their bytes of equal rank together, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(data, decompressed_size=count * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, count).T).view(kind).reshape(-1)


def _sorted_packed(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.uint64(0)))


def _sorted_unpacked(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(unpacked(data, count, np.uint64), dtype=np.uint64)


def _tongues(table: pa.Table) -> np.ndarray:
    return np.asarray(table["tongue"].combine_chunks()).view(np.uint64)


_SENT = "batch int, bucket int, n bigint, prints binary, counts binary"
_TOLD = "batch int, bucket int, n bigint, prints binary, spell binary"
#: ``lead`` are the places of the prints whose language and phrase follow; ``langs`` and ``totals`` count all words.
_ANSWERS = """batch int, bucket int, n bigint, prints binary, checks binary, counts binary, lead binary,
    lead_langs array<string>, lead_phrases array<string>, langs array<string>, totals array<bigint>"""
#: A phrase with its count, all words of a language (phrase null), or a batch that must spell a print.
_SETTLED = "lang string, phrase string, f bigint, batch int, print bigint"
_SPELLED = "lang string, phrase string, f bigint"
_KINDS = {
    "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(),
    "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64()),
}


def _fingerprints(buckets: int):
    """For a batch of texts: its fingerprints in ranges, with counts."""
    width = -(-(1 << PRINT_BITS) // buckets)

    def fingerprints(key, table):
        runs = [prints for _, _, prints in Words.read(table["text"]).runs(_tongues(table))]
        prints, counts = np.unique(np.concatenate(runs), return_counts=True)
        edges = np.searchsorted(prints, np.array([i * width for i in range(1, buckets)], np.uint64))
        rows = []
        for bucket, (a, b) in enumerate(zip([0, *edges], [*edges, len(prints)])):
            if b > a:
                rows.append((bucket, b - a, _sorted_packed(prints[a:b]), packed(counts[a:b].astype(np.uint32))))
        return _table(_SENT, [(key[0].as_py(), *r) for r in rows])

    return fingerprints


def _frequent(least: int):
    """For a range of fingerprints: to each batch those of its own that are frequent over all batches."""

    def frequent(table):
        sent = [(r["batch"], r["bucket"], r["n"], r["prints"], r["counts"]) for r in table.to_pylist()]
        prints = [_sorted_unpacked(p, n) for _, _, n, p, _ in sent]
        counts = np.concatenate([unpacked(c, n, np.uint32) for _, _, n, _, c in sent]).astype(np.int64)
        every = np.concatenate(prints)
        order = np.argsort(every)
        every = every[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        often = every[first][np.add.reduceat(counts[order], first) >= least]
        rows, open_ = [], np.ones(len(often), bool)
        for (batch, bucket, *_), own in zip(sent, prints):
            held, place = _held(often, own)
            own, place = own[held], place[held]
            if len(own):
                # The first batch that has a fingerprint spells it.
                rows.append((batch, bucket, len(own), _sorted_packed(own), packed(open_[place])))
                open_[place] = False
        return _table(_TOLD, rows)

    return frequent


def _held(wanted: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are among the sorted ``wanted``, and their places there."""
    place = np.searchsorted(wanted, values)
    if not len(wanted):
        return np.zeros(len(values), bool), place
    place = np.minimum(place, len(wanted) - 1)
    return wanted[place] == values, place


def _occurrences(words: Words, tongues: np.ndarray, wanted: np.ndarray):
    """(first word, size, place in ``wanted``) of every occurrence; of each place the first; which agree with it."""
    found = []
    for n, at, prints in words.runs(tongues):
        held, place = _held(wanted, prints)
        found.append((at[held], np.full(held.sum(), n), place[held]))
    at, size, place = map(np.concatenate, zip(*found))
    number = words.numbers()
    _, first, group = np.unique(place, return_index=True, return_inverse=True)
    model = first[group]
    same = (size == size[model]) & (tongues[words.text[at]] == tongues[words.text[at[model]]])
    last = max(0, len(number) - 1)
    for step in range(LONGEST):
        equal = number[np.minimum(at + step, last)] == number[np.minimum(at[model] + step, last)]
        same &= equal | (size <= step)
    return at, size, place, first, group, same


def _by_phrase(words: Words, langs: list[str], at: np.ndarray, size: np.ndarray, some: np.ndarray) -> dict:
    """The places, among ``some``, of the occurrences of each (language, phrase)."""
    told: dict = {}
    for k in some.tolist():
        told.setdefault((langs[words.text[at[k]]], words.spelled(at[k], size[k])), []).append(k)
    return told


def _answer(texts, told):
    """For a batch of texts: what it holds of the fingerprints it was told of, in the same ranges."""
    if not texts.num_rows:
        return _table(_ANSWERS, [])
    langs, words, tongues = texts["lang"].to_pylist(), Words.read(texts["text"], checked=True), _tongues(texts)
    totals: Counter = Counter()
    for text, count in zip(*(v.tolist() for v in np.unique(words.text, return_counts=True))):
        totals[langs[text]] += count
    batch = texts["batch"][0].as_py()
    rows = [(batch, -1 - batch, 0, b"", b"", b"", b"", [], [], list(totals), list(totals.values()))]
    told = sorted(told.to_pylist(), key=lambda r: r["bucket"])
    if told:
        # Ranges in order make one sorted list.
        wanted = np.concatenate([_sorted_unpacked(r["prints"], r["n"]) for r in told])
        spell = np.concatenate([unpacked(r["spell"], r["n"], np.bool_) for r in told])
        at, size, place, first, group, same = _occurrences(words, tongues, wanted)
        # One entry a fingerprint, and one for each phrase that only shares it.
        entry, owner = [first], [place[first]]
        counts = [np.bincount(group[same], minlength=len(first))]
        for others in _by_phrase(words, langs, at, size, np.flatnonzero(~same)).values():
            for k in {int(place[k]) for k in others}:
                mine = [o for o in others if place[o] == k]
                entry.append(np.array(mine[:1]))
                owner.append(np.array([k]))
                counts.append(np.array([len(mine)]))
        entry, owner, counts = map(np.concatenate, (entry, owner, counts))
        order = np.argsort(owner, kind="stable")
        entry, owner, counts = entry[order], owner[order], counts[order]
        checks = words.checked(at[entry], size[entry])
        edges = np.searchsorted(owner, np.cumsum([r["n"] for r in told]))
        for r, a, b in zip(told, [0, *edges], edges):
            lead = np.flatnonzero(spell[owner[a:b]]) + a
            rows.append((
                batch, r["bucket"], int(b - a), _sorted_packed(wanted[owner[a:b]]), packed(checks[a:b]),
                packed(counts[a:b].astype(np.uint32)), packed((lead - a).astype(np.uint32)),
                [langs[words.text[at[k]]] for k in entry[lead]],
                [words.spelled(at[k], size[k]).decode() for k in entry[lead].tolist()], [], [],
            ))
    return _table(_ANSWERS, rows)


def _settle(least: int):
    """For a range of fingerprints: phrases with exact counts, and the batches that must spell the rest."""

    def settle(table):
        rows, prints, checks, counts, batches, phrase = [], [], [], [], [], {}
        for r in table.to_pylist():
            rows += [(lang, None, n, None, None) for lang, n in zip(r["langs"], r["totals"])]
            if r["n"]:
                prints.append(_sorted_unpacked(r["prints"], r["n"]))
                checks.append(unpacked(r["checks"], r["n"], np.uint64))
                counts.append(unpacked(r["counts"], r["n"], np.uint32).astype(np.int64))
                batches.append(np.full(r["n"], r["batch"]))
                lead = unpacked(r["lead"], len(r["lead_phrases"]), np.uint32)
                names = zip(prints[-1][lead].tolist(), checks[-1][lead].tolist())
                phrase |= zip(names, zip(r["lead_langs"], r["lead_phrases"]))
        if prints:
            prints, checks, counts, batches = map(np.concatenate, (prints, checks, counts, batches))
            order = np.lexsort((checks, prints))
            p, c = prints[order], checks[order]
            first = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])]))
            known, lost = [], set()
            for name, f in zip(zip(p[first].tolist(), c[first].tolist()), np.add.reduceat(counts[order], first).tolist()):
                if f >= least and name not in phrase:
                    lost.add(name[0])
                elif f >= least:
                    known.append((*phrase[name], f, None, None, name[0]))
            rows += [r[:-1] for r in known if r[-1] not in lost]
            lost = np.isin(prints, np.array(sorted(lost), np.uint64))
            rows += [(None, None, None, b, h) for b, h in {*zip(batches[lost].tolist(), prints[lost].view(np.int64).tolist())}]
        return _table(_SETTLED, rows)

    return settle


def _spell(texts, told):
    """Counts of every phrase of a batch that has one of the told prints."""
    if not texts.num_rows or not told.num_rows:
        return _table(_SPELLED, [])
    langs, words, tongues = texts["lang"].to_pylist(), Words.read(texts["text"]), _tongues(texts)
    wanted = np.sort(np.asarray(told["print"].combine_chunks()).view(np.uint64))
    at, size, *_ = _occurrences(words, tongues, wanted)
    held = _by_phrase(words, langs, at, size, np.arange(len(at)))
    return _table(_SPELLED, [(lang, phrase.decode(), len(places)) for (lang, phrase), places in held.items()])


def _table(ddl: str, rows: list[tuple]) -> pa.Table:
    fields = [f.split() for f in ddl.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table({name: pa.array(values, _KINDS[kind]) for (name, kind), values in zip(fields, columns)})


def _settled(rows: DataFrame, batches: int, least: int) -> DataFrame:
    sent = rows.groupBy("batch").applyInArrow(_fingerprints(-(-batches // 2)), schema(_SENT))
    told = sent.groupBy("bucket").applyInArrow(_frequent(least), schema(_TOLD))
    # The texts of a batch come from the shuffle that fed its fingerprints.
    answers = rows.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(_answer, schema(_ANSWERS))
    return answers.groupBy("bucket").applyInArrow(_settle(least), schema(_SETTLED))


def frequent_phrases(
    docs: DataFrame, least: int = 100, key: str = "doc_id", text: str = "text", lang: str = "lang", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """(lang, phrase, f): phrases of 1 to 5 words that occur ``least`` times, and with a null phrase all words."""
    rows = need(docs, key, text, lang).toDF("key", "text", "lang")
    rows = rows.select("key", F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    batches = buckets_for(rows, "text", batch_bytes)
    rows = rows.select(
        F.pmod(F.xxhash64("key", "text"), F.lit(batches)).cast("int").alias("batch"), "lang", F.xxhash64("lang").alias("tongue"), "text"
    )
    settled = materialize(_settled(rows, batches, least), "phrases")
    counts = settled.where("lang is not null").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    lost = settled.where("lang is null").select("batch", "print")
    if not lost.isEmpty():
        spelled = rows.groupBy("batch").cogroup(lost.groupBy("batch")).applyInArrow(_spell, schema(_SPELLED))
        spelled = spelled.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        counts = materialize(counts.union(spelled.where(F.col("f") >= least)), "phrases")
    return counts


def score_phrases(counts: DataFrame, within: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that no longer one holds ``within`` in a hundred times."""
    total = counts.where("phrase is null").select("lang", F.col("f").alias("n"))
    phrases = counts.where("phrase is not null")
    worded = phrases.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w")).where(F.size("w") > 1)

    def run(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = worded.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", run(F.lit(1), F.col("k")).alias("left"), run(F.col("k") + 1, F.size("w")).alias("right"))
    for part, f in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(f)), ["lang", part])
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    cuts = cuts.join(total, "lang").select(
        "lang", "phrase", "a", "k", "l", "r", "n",
        (F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"]).alias("above"), (exact["l"] * exact["r"]).alias("below"),
    )
    lowest = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(F.expr("above div below").alias("score"), "k", "a", "l", "r", "n")).alias("cut")
    )
    inner = worded.where(F.size("w") > 2).select(
        "lang", "a", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("size")
    )
    inner = inner.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("start"))
    inner = inner.groupBy("lang", run(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = lowest.join(inner, ["lang", "phrase"], "left").where("longer is null or 100 * longer < %d * cut.a" % within)
    return kept.select("lang", "phrase", *(F.col(f"cut.{c}").alias(c) for c in ("a", "l", "r", "n", "score")))


def mine_phrases(docs: DataFrame, least: int = 100, top: int = 2000, within: int = 100, **columns) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    Ranking cuts each task to ``top`` rows of a language before it shuffles.
    """
    counts = frequent_phrases(docs, least, **columns)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = score_phrases(counts, within).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
