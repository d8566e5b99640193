import zlib

import numpy as np
import pytest

import corpus_pipeline
from tallyforge.llm import quality as Q
from tallyforge.llm import queries
from tallyforge.llm import toxicity as X

HELD_OUT_DIR = "/root/testdata/sf0.1"


def test_folds_are_crc32_of_the_key_as_text(spark):
    got = spark.range(200).select("id", Q.in_fold("id", 5, 0).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
    assert spark.sql("SELECT cast(null AS bigint) id").select(Q.in_fold("id", 5, 0)).first()[0] is False


def test_gradients_match_differences():
    random = np.random.default_rng(1)
    features, firsts = random.standard_normal((9, Q.FEATURES)).astype(np.float32), np.array([0, 2, 3, 9])
    labels = np.array([1, 0, 1], np.float32)
    model = Q.fit(features, firsts, labels, epochs=1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x = model.scaled(features.astype(np.float64))

    def loss():
        p = model.forward(x, firsts)["p"]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    gradients = model.gradients(model.forward(x, firsts), firsts, labels)
    for name, gradient in gradients.items():
        at = tuple(random.integers(0, n) for n in gradient.shape)
        kept, step = model.weights[name][at], 1e-5
        model.weights[name][at] = kept + step
        above = loss()
        model.weights[name][at] = kept - step
        below = loss()
        model.weights[name][at] = kept
        assert gradient[at] == pytest.approx((above - below) / (2 * step), rel=1e-3, abs=1e-7)


def test_passages_of_whole_texts():
    sizes = [0, 5, Q.PASSAGE, 3 * Q.PASSAGE + 1]
    data = np.frombuffer(b"ab" * (sum(sizes) // 2 + 1), np.uint8)[: sum(sizes)]
    features, firsts = Q.passages(data, np.cumsum([0, *sizes]))
    assert np.diff(firsts).tolist() == [1, 1, 1, 4] and features.shape == (7, Q.FEATURES)
    assert features[0].sum() == 0 and np.isfinite(features).all()


def test_scores_in_rounds_are_those_of_all_passages_at_once(monkeypatch):
    random = np.random.default_rng(4)
    sizes = [0, 5, Q.PASSAGE, 9 * Q.PASSAGE + 3, 40, 8 * Q.PASSAGE, 0]
    offsets = np.cumsum([0, *sizes])
    data = random.integers(97, 123, offsets[-1]).astype(np.uint8)
    features, firsts = Q.passages(data, offsets)
    model = Q.fit(features, firsts, random.permutation([0, 1, 0, 1, 0, 1, 1]), epochs=2)
    expected = model.forward(model.scaled(features), firsts)["p"]
    for passages in (1, 2, 3, 256):
        monkeypatch.setattr(Q, "ROUND_PASSAGES", passages)
        assert np.allclose(model.score(data, offsets), expected, atol=1e-5)
    assert len(model.score(data[:0], np.array([0]))) == 0


@pytest.mark.parametrize("query, label, modulus, remainder, least", [("op4_quality", "quality", 5, 0, 0.97), ("op8_toxicity", "toxic", 4, 2, 0.95)])
def test_held_out_accuracy(spark, query, label, modulus, remainder, least):
    labels = spark.read.parquet(f"{HELD_OUT_DIR}/labels.parquet").select("doc_id", label)
    rows = queries.QUERIES[query](spark, HELD_OUT_DIR).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r[label] for r in rows)
    assert right >= least * len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_odd_rows_are_scored(make_docs, spark):
    rows = [(1, "good words here"), (2, None), (3, ""), (4, "bad!! " * 50), (4, "bad!! " * 50), (None, "x"), (5, "long text " * 30_000)]
    labels = spark.createDataFrame(
        [(1, 1, 0), (4, 0, 1), (4, 0, 1), (6, 1, 0), (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int"
    )
    docs = make_docs(rows)
    for model in (Q.learn_quality(docs, labels, modulus=1000, remainder=999), None):
        got = Q.score_quality(docs, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    for index in (X.learn_toxicity(docs, labels, modulus=1000, remainder=999), None):
        got = X.score_toxicity(docs, index).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = labels.where("false")
    assert Q.learn_quality(docs, none) is None and X.learn_toxicity(docs, none) is None
    assert Q.score_quality(make_docs([]), None).collect() == [] and X.score_toxicity(make_docs([]), None).collect() == []


def test_nearest_are_those_of_all_examples():
    random = np.random.default_rng(2)
    examples, terms = 300, 40
    counts = random.poisson(0.25, (examples, terms))
    counts[0] = counts[1]  # ties
    text, term = np.nonzero(counts)
    idf = random.uniform(1, 5, terms)
    index = X.ExampleIndex.build(
        np.arange(terms, dtype=np.uint64), np.ones(terms), idf, text, term, counts[text, term],
        np.arange(examples), np.zeros(examples, int), np.ones(examples), 0.1,
    )
    weight = np.where(counts > 0, (1 + np.log(np.maximum(counts, 1))) * idf, 0)
    weight = weight / np.maximum(np.linalg.norm(weight, axis=1, keepdims=True), 1e-12)
    for _ in range(50):
        query = random.poisson(0.2, terms)
        own = np.flatnonzero(query)
        if len(own):
            found, cosine = index.nearest(own, query[own], k=10)
            q = (1 + np.log(query[own])) * idf[own]
            every = weight[:, own] @ (q / np.linalg.norm(q))
            best = np.lexsort((np.arange(examples), -np.round(every, 12)))[:10]
            best = best[every[best] > 0]
            assert found.tolist() == best.tolist() and cosine == pytest.approx(every[best])


def test_nearest_are_told_apart_beyond_single_precision(monkeypatch):
    monkeypatch.setattr(X, "COMMON", 2)
    examples = 200
    counts = np.column_stack([10**7 + 50 * np.random.default_rng(5).permutation(examples), np.full(examples, 3)])
    text, term = np.divmod(np.arange(2 * examples), 2)
    index = X.ExampleIndex.build(
        np.arange(2, dtype=np.uint64), np.ones(2), np.array([1.0, 2.0]), text, term, counts.ravel(),
        np.arange(examples), np.zeros(examples, int), np.ones(examples), 0.1,
    )
    assert index._opened()[0].dtype == np.float32  # half the work and memory of the matrix in double precision
    weight = (1 + np.log(counts)) * [1.0, 2.0]
    every = (weight / np.linalg.norm(weight, axis=1, keepdims=True))[:, 1]
    found, cosine = index.nearest(np.array([1]), np.array([1]), k=10)
    assert found.tolist() == np.argsort(-every)[:10].tolist() and cosine == pytest.approx(every[found], rel=1e-12)


def test_a_copy_of_an_example_is_found_by_rare_words(make_docs, spark):
    random = np.random.default_rng(3)
    common = ["".join(random.choice(list("abcdefghij"), 7)) for _ in range(200)]
    rows = []
    for i in range(300):
        own = ["".join(random.choice(list("klmnopqrst"), 9)) for _ in range(5)]  # in this text alone
        rows.append((i, " ".join([*random.choice(common, 30), *own])))
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    docs = make_docs(rows + [(1000 + i, rows[i][1]) for i in (0, 10, 20, 21)])
    index = X.learn_toxicity(docs, labels, modulus=1000, remainder=999)
    for r in X.score_toxicity(docs.where("doc_id >= 1000"), index).collect():
        assert r.evidence[0].doc_id == r.doc_id - 1000 and r.evidence[0].cosine == pytest.approx(1)
        assert (r.score >= queries.PASSING) == (r.doc_id != 1021)


def test_stages_keep_columns_and_take_effect(spark, given):
    docs = spark.read.parquet(f"{given}/documents.parquet").selectExpr("*", "'mine' AS score", "1 AS n_bytes")
    odd = [(None, "x y", "en", "s", 3, "mine", 1), (10**6, None, None, None, None, None, None)]
    docs, before = docs.union(spark.createDataFrame(odd, ", ".join(f"{c} {k}" for c, k in docs.dtypes))), None
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, given)
        if name == "packing":
            assert {r.doc_id for r in result.select("doc_id").collect()} == before
            break
        assert result.schema.names == docs.schema.names
        rows = result.collect()
        assert all(r.n_chars == len(r.text) for r in rows if name == "repeats")
        after = {r.doc_id for r in rows}
        assert before is None or after <= before
        docs, before = spark.createDataFrame(rows, docs.schema), after
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, given).collect() == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_take_columns_of_any_name(spark, given):
    docs = spark.read.parquet(f"{given}/documents.parquet").limit(30).selectExpr("*", "1 AS `a.b`", "'x' AS `c d`", "2 AS column_5")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, given)
        assert kept.columns == docs.columns, name
        assert {r["a.b"] for r in kept.collect()} <= {1}


def test_places_of_hashes_among_terms_also_where_many_share_their_leading_bits():
    made = np.random.default_rng(5)
    for terms in (
        np.array([7], np.uint64),
        np.unique(made.integers(1, 2**64, 5000, dtype=np.uint64)),
        np.unique(np.r_[made.integers(1, 2**12, 900, dtype=np.uint64), made.integers(2**63, 2**63 + 4000, 900, dtype=np.uint64)]),
    ):
        others = made.integers(0, 2**64, 3000, dtype=np.uint64)
        hashes = made.permutation(np.r_[np.repeat(terms, 2), terms - np.uint64(1), others, np.zeros(9, np.uint64)])
        known, places = X.places_of(hashes, terms)
        order = np.argsort(known)
        wanted = np.flatnonzero(np.isin(hashes, terms))
        assert known[order].tolist() == wanted.tolist()
        assert (terms[places[order]] == hashes[wanted]).all()
