"""Toxicity: votes of the nearest labelled examples by exact TF-IDF cosine, with evidence.

Words are runs of letters, lower-cased; the beginnings of words count as words of their own, for stems.
A bounded sample of labelled texts serves as examples, and every word of them is a term.  Document
frequencies are counted over all documents.  A term weighs its IDF times how far the share of toxic
examples among those that hold it lies from the share among all, beyond chance; none weighs nothing.
The cosine of a document with every example is summed in double precision, over a matrix for terms that
many examples hold and over postings for the others, so the k nearest are exact.  They vote by a power
of the cosine, each class weighed by how thinly it was sampled, against a prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import keep_freed_arrays, need, schema, text_rounds
from tallyforge.llm.quality import in_fold
from tallyforge.llm.words import LETTERS, word_hashes

#: Examples of each class, bytes of an example, bytes of word beginnings.
EXAMPLES_EACH, EXAMPLE_BYTES, BEGINNINGS = 4096, 65_536, (4, 5, 6)
#: Weight of a term that tells nothing, and standard errors that are taken for chance.
FLOOR, CHANCE = 0.02, 3.0
#: Neighbours that vote, power of their cosine, weight of the prior against them.
NEIGHBOURS, POWER, PRIOR_WEIGHT = 25, 6, 0.1
#: Terms at most in the matrix, those that most examples hold; documents multiplied with it at a time.
COMMON, TOGETHER = 2048, 256
#: Bytes of text of which words are counted at a time.
COUNTED_BYTES = 250_000
EVIDENCE = 3


def word_counts(data: np.ndarray, offsets: np.ndarray):
    """(text, word hash, count), sorted, of the words of some texts and their beginnings."""
    text, hashes = _words(data, offsets)
    order = np.lexsort((hashes, text))
    order = order[hashes[order] != 0]
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    places = np.flatnonzero(new)
    return text[places], hashes[places], np.diff(np.append(places, len(text)))


def _words(data: np.ndarray, offsets: np.ndarray):
    hashes, firsts = word_hashes(data, offsets, LETTERS, BEGINNINGS)
    return np.tile(np.repeat(np.arange(len(offsets) - 1), np.diff(firsts)), 1 + len(BEGINNINGS)), hashes


def term_counts(data: np.ndarray, offsets: np.ndarray, terms: np.ndarray):
    """(text, term number, count), sorted, of the terms of some texts."""
    text, hashes = _words(data, offsets)
    if not len(terms):
        return text[:0], text[:0], text[:0]
    known, at = places_of(hashes, terms)
    both, counts = np.unique(text[known] * len(terms) + at, return_counts=True)
    return both // len(terms), both % len(terms), counts


def places_of(hashes: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among the sorted terms, and the places of those.

    Hashes are even, so their leading bits lead to a few terms at most: a look at these costs less than
    a binary search among all.
    """
    shift = np.uint64(64 - max(1, len(terms).bit_length()))
    last = int(terms[-1] >> shift)
    first = np.searchsorted(terms >> shift, np.arange(last + 2, dtype=np.uint64))
    lead = hashes >> shift
    left = np.flatnonzero((hashes != 0) & (lead <= last))
    lead, at = lead[left].astype(np.intp), first[lead[left].astype(np.intp)]
    ends, known, places = first[lead + 1], [left[:0]], [at[:0]]
    while len(left):
        inside = np.flatnonzero(at < ends)
        left, at, ends = left[inside], at[inside], ends[inside]
        same = terms[at] == hashes[left]
        known.append(left[same])
        places.append(at[same])
        left, at, ends = left[~same], at[~same] + 1, ends[~same]
    return np.concatenate(known), np.concatenate(places)


@dataclass
class ExampleIndex:
    """Terms (sorted word hashes), their weights, and the examples' postings by term."""

    terms: np.ndarray
    factor: np.ndarray  # of each term: IDF times how much it tells
    example: np.ndarray  # of each posting, sorted by term and example
    counts: np.ndarray
    where: np.ndarray  # first posting of each term, and the end
    norm: np.ndarray  # of each example
    doc: np.ndarray
    toxic: np.ndarray
    vote: np.ndarray
    prior: float

    @classmethod
    def build(cls, terms, telling, idf, text, term, counts, doc, toxic, vote, prior):
        factor = np.asarray(idf * telling, float)
        order = np.lexsort((text, term))
        text, term, counts = text[order], term[order], counts[order]
        norm = np.sqrt(np.bincount(text, ((1 + np.log(counts)) * factor[term]) ** 2, minlength=len(doc)))
        where = np.searchsorted(term, np.arange(len(terms) + 1))
        text, counts = text.astype(np.min_scalar_type(len(doc))), counts.astype(np.min_scalar_type(counts.max(initial=1)))
        return cls(terms, factor, text, counts, where, np.where(norm > 0, norm, 1.0), doc, toxic, vote, prior)

    def _opened(self):
        """What the search needs, made once in a process.

        The matrix of common terms in single precision, and each term's row in it or -1; the rows and weights
        of every example in double precision, example by example; the example and weight of all postings.
        """
        if not hasattr(self, "_held"):
            held = np.diff(self.where)
            weight = (1 + np.log(self.counts.astype(float))) * np.repeat(self.factor, held) / self.norm[self.example]
            common = np.argsort(-held, kind="stable")[:COMMON]
            row = np.full(len(held), -1, np.int32)
            row[common] = np.arange(len(common))
            matrix = np.zeros((len(common), len(self.doc)), np.float32)
            for at, t in enumerate(common):
                own = slice(self.where[t], self.where[t + 1])
                matrix[at, self.example[own]] = weight[own]
            row_of = np.repeat(row, held)
            within = np.flatnonzero(row_of >= 0)
            within = within[np.argsort(self.example[within], kind="stable")]
            begins = np.searchsorted(self.example[within], np.arange(len(self.doc) + 1))
            self._held = matrix, row, row_of[within].astype(np.intp), weight[within], begins, self.example.astype(np.intp), weight
        return self._held

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_held"}

    def nearest_of_all(self, text: np.ndarray, term: np.ndarray, counts: np.ndarray, texts: int, k: int = NEIGHBOURS):
        """For each text the k examples of highest cosine above zero (ties: the earlier one) and the cosines.

        Common terms are summed in single precision first.  Its error is bounded, so this tells which examples
        can be among the k, and only for these they are summed again in double precision.
        """
        matrix, row, row_of, weight_of, begins, example, weight = self._opened()
        query = (1 + np.log(counts)) * self.factor[term]
        query = query / np.sqrt(np.bincount(text, query**2, minlength=texts))[text]
        ends = np.searchsorted(text, np.arange(texts + 1))
        # No weight is negative, so a sum of n products is off by a share of about n roundings at most.
        margin = 1 - 3 * (len(matrix) + 16) * 2.0**-24
        sought = np.zeros(len(matrix))
        for start in range(0, texts, TOGETHER):
            stop = min(start + TOGETHER, texts)
            part = slice(ends[start], ends[stop])
            common = row[term[part]] >= 0
            left = np.zeros((stop - start, len(matrix)), np.float32)
            left[text[part][common] - start, row[term[part][common]]] = query[part][common]
            sums = left @ matrix
            for at in range(start, stop):
                rows, own, rare = row[term[ends[at] : ends[at + 1]]], query[ends[at] : ends[at + 1]], 0.0
                seldom = np.flatnonzero(rows < 0)
                if len(seldom):
                    places, shares = self._postings(term[ends[at] : ends[at + 1]][seldom], own[seldom])
                    shares *= weight[places]
                    rare = np.bincount(example[places], shares, len(self.doc))
                cosine = sums[at - start] + rare
                least = np.partition(cosine, -k)[-k] * margin - 1e-9 if k < len(cosine) else 0
                found = np.flatnonzero((cosine >= least) & (cosine > 0))
                sought[rows[rows >= 0]] = own[rows >= 0]
                exact = [sought[row_of[a:b]] @ weight_of[a:b] for a, b in zip(begins[found], begins[found + 1])]
                sought[rows[rows >= 0]] = 0
                cosine = np.array(exact) + (rare[found] if len(seldom) else 0.0)
                best = np.lexsort((found, -np.round(cosine, 12)))[:k]
                yield found[best], cosine[best]

    def _postings(self, term: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all postings of some terms, and each one's value of its term."""
        first, sizes = self.where[term], self.where[term + 1] - self.where[term]
        places = np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
        places += np.arange(len(places))
        return places, np.repeat(values, sizes)

    def nearest(self, term: np.ndarray, counts: np.ndarray, k: int = NEIGHBOURS):
        """The k examples of highest cosine above zero (ties: the earlier example) and the cosines."""
        return next(self.nearest_of_all(np.zeros(len(term), np.int64), term, counts, 1, k))

    def judge(self, found: np.ndarray, cosine: np.ndarray):
        """Score and evidence of a document with these neighbours."""
        vote = self.vote[found] * cosine**POWER
        score = (vote @ self.toxic[found] + PRIOR_WEIGHT * self.prior) / (vote.sum() + PRIOR_WEIGHT)
        evidence = [
            {"doc_id": int(self.doc[e]), "cosine": float(c), "toxic": bool(self.toxic[e])}
            for e, c in zip(found[:EVIDENCE], cosine[:EVIDENCE])
        ]
        return float(score), evidence


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    key: str = "doc_id",
    modulus: int = 4,
    remainder: int = 2,
    examples_each: int = EXAMPLES_EACH,
    max_example_bytes: int = EXAMPLE_BYTES,
) -> ExampleIndex | None:
    """Build the index of at most ``examples_each`` labelled texts of each class, by hash of the key.

    Labels of the held-out fold are not read; of a key labelled twice the larger label counts.  Class
    sizes and document frequencies are counted over all rows.  None if either class has no example.
    """
    rows = need(labels, key, label).where(~in_fold(key, modulus, remainder) & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    rows = rows.groupBy(F.col(key)).agg(F.max(label).alias("label"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    hashed = [F.xxhash64(F.col(key), F.lit(17)), F.col(key)]
    chosen = None
    for kind in (0, 1):
        part = rows.where(F.col("label") == kind).orderBy(*hashed).limit(examples_each)
        chosen = part if chosen is None else chosen.union(part)
    texts = need(docs, key, "text").where(F.octet_length("text") <= max_example_bytes)
    sampled = texts.join(F.broadcast(chosen), key).select(F.col(key).cast("bigint").alias("doc"), "label", "text")

    def counted(batches):
        for batch in batches:
            for first, end, data, offsets in text_rounds(batch.column(2)):
                text, word, counts = word_counts(data, offsets)
                ends = np.searchsorted(text, np.arange(end - first + 1))
                blobs = [
                    [word[a:b].astype("<u8").tobytes(), counts[a:b].astype("<i4").tobytes()]
                    for a, b in zip(ends[:-1], ends[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:end], batch.column(1)[first:end]]
                    + [pa.array([b[i] for b in blobs], pa.binary()) for i in (0, 1)],
                    names=["doc", "label", "words", "counts"],
                )

    made = sampled.mapInArrow(counted, schema("doc bigint, label int, words binary, counts binary")).toPandas()
    made = made.sort_values(["doc", "words"], kind="stable")
    toxic = made["label"].to_numpy(np.int64)
    if not 0 < toxic.sum() < len(toxic):
        return None
    sizes_of = made["words"].str.len().to_numpy(np.int64) // 8
    word = np.frombuffer(b"".join(made.pop("words")), "<u8")
    counts = np.frombuffer(b"".join(made.pop("counts")), "<i4")
    text = np.repeat(np.arange(len(sizes_of), dtype=np.int32), sizes_of)
    order = np.argsort(word, kind="stable")
    word, text, counts = word[order], text[order], counts[order]
    del order
    new = np.r_[True, word[1:] != word[:-1]][: len(word)]
    terms, term = word[new], (np.cumsum(new) - 1).astype(np.int32)
    del word
    telling = how_telling(term, toxic[text], len(terms), toxic.mean())
    n_docs, frequency = document_frequencies(docs, terms)
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    share = sizes[1] / (sizes[0] + sizes[1])
    vote = np.where(toxic == 1, sizes[1] / toxic.sum(), sizes[0] / (len(toxic) - toxic.sum()))
    return ExampleIndex.build(
        terms, telling, idf, text, term, counts, made["doc"].to_numpy(), toxic, vote / vote.min(), float(share)
    )


def how_telling(term: np.ndarray, toxic: np.ndarray, terms: int, share: float) -> np.ndarray:
    """Weight of each term: how far its examples' share of toxic ones lies from ``share``, beyond chance.

    The postings are distinct (example, term) pairs, ``toxic`` their examples' labels.  A word that few
    examples hold, or that tells nothing, weighs ``FLOOR``.
    """
    present = np.maximum(np.bincount(term, minlength=terms), 1)
    apart = np.abs(np.bincount(term, toxic, minlength=terms) / present - share)
    return FLOOR + np.maximum(0.0, apart - CHANCE * np.sqrt(share * (1 - share) / present))


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of documents, and of documents with each term, over all rows; summed in the tasks."""

    def count(batches):
        keep_freed_arrays()
        found, total = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            total += batch.num_rows
            for _, _, data, offsets in text_rounds(batch.column(0), COUNTED_BYTES):
                found += np.bincount(term_counts(data, offsets, terms)[1], minlength=len(terms))
        numbers = np.append(np.flatnonzero(found), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), pa.array(np.append(found[numbers[:-1]], total))], names=["term", "n"]
        )

    sums = need(docs, "text").mapInArrow(count, schema("term bigint, n bigint")).groupBy("term").agg(F.sum("n").alias("n"))
    held = sums.toArrow()  # a row per term at most
    out = np.zeros(len(terms) + 1)  # the number of documents last
    out[held.column("term").to_numpy()] = held.column("n").to_numpy()
    return int(out[-1]), out[:-1]


def score_toxicity(docs: DataFrame, index: ExampleIndex | None, key: str = "doc_id") -> DataFrame:
    """Key, score and evidence (nearest examples with cosine and label) of every row, by its whole text.

    A null or empty text, and one without any term, gets the prior share of toxic labels; without an
    index every score is 0.  Repeated rows each get a row, ties between examples go to the smaller
    document.
    """
    kind = docs.schema[key].dataType.simpleString()
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.bool_())]))

    def score(batches):
        keep_freed_arrays()
        for batch in batches:
            scores, why = [], []
            for first, end, data, offsets in text_rounds(batch.column(1)):
                if index is None:
                    scores += [0.0] * (end - first)
                    why += [[]] * (end - first)
                    continue
                for found, cosine in index.nearest_of_all(*term_counts(data, offsets, index.terms), end - first):
                    one, evidence_of = index.judge(found, cosine)
                    scores.append(one)
                    why.append(evidence_of)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(why, evidence)],
                names=[key, "score", "evidence"],
            )

    columns = f"`{key}` {kind}, score double, evidence array<struct<doc_id: bigint, cosine: double, toxic: boolean>>"
    return need(docs, key, "text").mapInArrow(score, schema(columns))
