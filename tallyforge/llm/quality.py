"""Quality classifier: attention-based multiple-instance learning over passages.

A text is a bag of passages of equal length.  Every passage is encoded (byte-pair frequencies and the
share of distinct byte runs, through a small tanh layer); a gated attention, learned from the labels
of whole documents only, weighs the passages; the score is a logistic function of the weighted mean.
So a document with one clean opening and pages of rubbish is judged by what tells it apart.

The model is fitted on a bounded sample of labelled rows (``max_examples``, ``max_example_bytes``)
and is a few thousand numbers; scoring is one narrow pass over all passages of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import keep_freed_arrays, need, schema, text_rounds

#: Bytes of a passage, bins of byte pairs, bins in which distinct runs of eight bytes are counted.
PASSAGE, PAIR_BINS, RUN_BINS = 1024, 512, 1024
FEATURES = PAIR_BINS + 2
#: Passages of which features are held at a time while scoring.
ROUND_PASSAGES = 256
#: Bytes of text that a round of array work takes: a worker holds a hundred times as much for it.
ROUND_BYTES = 250_000
HIDDEN, ATTENTION = 32, 16
_BIN_OF_PAIR = ((np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)).astype(np.int64)


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and for each text the number of its first passage.

    An empty text has one passage of zeros.
    """
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    firsts = np.concatenate([[0], np.cumsum(counts)])
    total = int(firsts[-1])
    features = np.zeros((total, FEATURES), np.float32)
    at = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    passage = np.repeat(firsts[:-1], sizes) + at // PASSAGE
    left = np.repeat(sizes, sizes) - at  # bytes to the end of the text, this one included
    length = np.bincount(passage, minlength=total)
    pairs = data[:-1].astype(np.int64) * 256 + data[1:]
    inside = left[: len(pairs)] > 1
    bins = passage[: len(pairs)] * PAIR_BINS + _BIN_OF_PAIR[pairs]
    counted = np.bincount(bins[inside], minlength=total * PAIR_BINS).reshape(total, PAIR_BINS)
    features[:, :PAIR_BINS] = np.sqrt(counted / np.maximum(1, length)[:, None])
    if len(data) >= 8:
        run = data.astype(np.uint64)
        for width in (1, 2, 4):
            run = run[:-width] | run[width:] << np.uint64(8 * width)
        run = ((run * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int64)
        inside = left[: len(run)] >= 8
        own = passage[: len(run)][inside]
        seen = np.zeros(total * RUN_BINS, bool)
        seen[own * RUN_BINS + run[inside]] = True
        runs = np.bincount(own, minlength=total)
        expected = RUN_BINS * (1 - np.exp(-runs / RUN_BINS))
        features[:, PAIR_BINS] = seen.reshape(total, RUN_BINS).sum(1) / np.maximum(1, expected)
    features[:, PAIR_BINS + 1] = length / PASSAGE
    return features, firsts


@dataclass
class AttentionModel:
    """Weights of the encoder, the gated attention and the output, and the scaling of the features."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def forward(self, x: np.ndarray, firsts: np.ndarray) -> dict[str, np.ndarray]:
        return self.weighed(self.encoded(x), firsts)

    def encoded(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What is known of each passage by itself, ``raw`` being its attention before it is shared out."""
        w, s = self.weights, {"x": x}
        s["h"] = np.tanh(x @ w["encode"] + w["encode0"])
        s["view"], s["gate"] = np.tanh(s["h"] @ w["view"]), 1 / (1 + np.exp(-(s["h"] @ w["gate"])))
        s["raw"] = (s["view"] * s["gate"]) @ w["attend"]
        return s

    def weighed(self, s: dict[str, np.ndarray], firsts: np.ndarray) -> dict[str, np.ndarray]:
        w, raw = self.weights, s["raw"]
        s["bag"] = bag = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        raw = np.exp(raw - np.maximum.reduceat(raw, firsts[:-1])[bag])
        s["a"] = raw / np.add.reduceat(raw, firsts[:-1])[bag]
        s["z"] = np.add.reduceat(s["a"][:, None] * s["h"], firsts[:-1], axis=0)
        s["p"] = 1 / (1 + np.exp(-np.clip(s["z"] @ w["out"] + w["out0"], -30, 30)))
        return s

    def scaled(self, features: np.ndarray) -> np.ndarray:
        return (features - self.mean) / self.scale

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Scores of some texts; features are made of ``ROUND_PASSAGES`` passages at a time, however long a text is."""
        sizes = np.diff(offsets)
        counts = np.maximum(1, -(-sizes // PASSAGE))
        firsts = np.concatenate([[0], np.cumsum(counts)])
        if not len(sizes):
            return np.zeros(0)
        kept = {"h": [], "raw": []}

        def keep(features):
            made = self.encoded(self.scaled(features))
            for name, parts in kept.items():
                parts.append(made[name])

        text = 0
        while text < len(sizes):
            end = max(text + 1, int(np.searchsorted(firsts, firsts[text] + ROUND_PASSAGES, side="right")) - 1)
            if counts[text] <= ROUND_PASSAGES:
                keep(passages(data[offsets[text] : offsets[end]], offsets[text : end + 1] - offsets[text])[0])
            else:
                for begun in range(0, int(counts[text]), ROUND_PASSAGES):
                    # With the passage behind, as byte runs reach over the edge.
                    first = offsets[text] + begun * PASSAGE
                    last = min(first + (ROUND_PASSAGES + 1) * PASSAGE, offsets[text + 1])
                    keep(passages(data[first:last], np.array([0, last - first]))[0][:ROUND_PASSAGES])
            text = end
        return self.weighed({k: np.concatenate(v) for k, v in kept.items()}, firsts)["p"].astype(np.float64)

    def gradients(self, s: dict, firsts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w, g, bag = self.weights, {}, s["bag"]
        error = (s["p"] - labels) / len(labels)
        g["out"], g["out0"] = s["z"].T @ error, np.array([error.sum()])
        dz = error[:, None] * w["out"]
        da = (s["h"] * dz[bag]).sum(1)
        draw = s["a"] * (da - np.add.reduceat(s["a"] * da, firsts[:-1])[bag])
        g["attend"] = (s["view"] * s["gate"]).T @ draw
        dview = draw[:, None] * w["attend"] * s["gate"] * (1 - s["view"] ** 2)
        dgate = draw[:, None] * w["attend"] * s["view"] * s["gate"] * (1 - s["gate"])
        g["view"], g["gate"] = s["h"].T @ dview, s["h"].T @ dgate
        dh = s["a"][:, None] * dz[bag] + dview @ w["view"].T + dgate @ w["gate"].T
        dh *= 1 - s["h"] ** 2
        g["encode"], g["encode0"] = s["x"].T @ dh, dh.sum(0)
        return g


def fit(features, firsts, labels, epochs: int = 25, batch: int = 128, rate: float = 2e-3, decay: float = 1e-4, seed: int = 7):
    """Fit by Adam on bags; None if the labels don't hold both classes."""
    labels = np.asarray(labels, np.float32)
    if not 0 < labels.sum() < len(labels):
        return None
    random = np.random.default_rng(seed)
    shapes = {"encode": (FEATURES, HIDDEN), "view": (HIDDEN, ATTENTION), "gate": (HIDDEN, ATTENTION), "attend": (ATTENTION,), "out": (HIDDEN,)}
    weights = {k: (random.standard_normal(v) / np.sqrt(v[0])).astype(np.float32) for k, v in shapes.items()}
    rate_of_ones = float(labels.mean())
    weights["encode0"] = np.zeros(HIDDEN, np.float32)
    weights["out0"] = np.array([np.log(rate_of_ones / (1 - rate_of_ones))], np.float32)
    model = AttentionModel(weights, features.mean(0), features.std(0) + np.float32(0.02))
    x, counts = model.scaled(features), np.diff(firsts)
    first_moment = {k: np.zeros_like(v) for k, v in weights.items()}
    second_moment = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for begun in range(0, len(order), batch):
            bags = order[begun : begun + batch]
            own = np.concatenate([[0], np.cumsum(counts[bags])])
            rows = np.repeat(firsts[bags] - own[:-1], counts[bags]) + np.arange(own[-1])
            gradients = model.gradients(model.forward(x[rows], own), own, labels[bags])
            step += 1
            for k, gradient in gradients.items():
                gradient = gradient + decay * weights[k]
                first_moment[k] += 0.1 * (gradient - first_moment[k])
                second_moment[k] += 0.001 * (gradient**2 - second_moment[k])
                scale = np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8
                weights[k] -= (rate * (first_moment[k] / (1 - 0.9**step)) / scale).astype(np.float32)
    return model


def in_fold(key: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; false for a null key."""
    text = F.col(f"`{key}`").cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % modulus == remainder, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, held_out: Column, max_examples: int, key: str = "doc_id") -> DataFrame:
    """At most ``max_examples`` labelled keys outside the held-out fold, chosen by hash; one row per key."""
    rows = labels.where(~held_out & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    rows = rows.groupBy(F.col(key)).agg(F.max(label).alias("label"))
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(17)), key).limit(max_examples)


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    modulus: int = 5,
    remainder: int = 0,
    max_examples: int = 8192,
    max_example_bytes: int = 65_536,
) -> AttentionModel | None:
    """Fit on at most ``max_examples`` labelled texts of at most ``max_example_bytes`` bytes each.

    Labels of the held-out fold (crc32 of the key mod ``modulus`` equals ``remainder``) are not read.
    None if both classes are not there.
    """
    chosen = labelled_sample(need(labels, key, label), label, in_fold(key, modulus, remainder), max_examples, key)
    texts = need(docs, key, "text").where(F.octet_length("text") <= max_example_bytes)
    rows = texts.join(F.broadcast(chosen), key).select(F.col(key).cast("bigint").alias("doc"), "label", "text")

    def featured(batches):
        keep_freed_arrays()
        for batch in batches:
            for first, end, data, offsets in text_rounds(batch.column(2), ROUND_BYTES):
                x, firsts = passages(data, offsets)
                blobs = [x[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:end], batch.column(1)[first:end], pa.array(blobs, pa.binary())],
                    names=["doc", "label", "x"],
                )

    made = rows.mapInArrow(featured, schema("doc bigint, label int, x binary")).toPandas()
    if made.empty:
        return None
    made = made.sort_values(["doc", "x"], kind="stable")
    bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in made["x"]]
    firsts = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return fit(np.concatenate(bags), firsts, made["label"].to_numpy())


def score_quality(
    docs: DataFrame, model: AttentionModel | None, keep: tuple[str, ...] = ("doc_id",), score: str = "score"
) -> DataFrame:
    """The columns ``keep`` of every row and, named ``score``, its score from the whole text.

    A null text counts as empty; an empty text is one passage of zeros; without a model (no labels of
    both kinds) every score is 0.5.  Repeated rows each get a row.  Only texts go to Python.
    """

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keep_freed_arrays()
        for texts in batches:
            parts = [np.zeros(0)]
            for first, end, data, offsets in text_rounds(texts, ROUND_BYTES):
                parts.append(np.full(end - first, 0.5) if model is None else model.score(data, offsets))
            yield pa.array(np.concatenate(parts))

    return docs.select(*(F.col(f"`{c}`") for c in keep), scored(F.col("text")).alias(score))
