import hashlib
import random

import numpy as np
import pytest

from tallyforge.llm import near_duplicates as N
from tallyforge.llm import repeats as R
from tallyforge.llm.decontamination import decontaminate, find_contamination
from tallyforge.llm.embedding_links import compare_leaf, fit_forest, link_embeddings
from tallyforge.llm.graph import components
from tests.llm.conftest import Joined, shingles, similarity, words

PICK = random.Random(3)
VOCABULARY = ["".join(PICK.choices("abcdeé", k=PICK.randint(2, 7))) for _ in range(400)]


def text(n):
    return " ".join(PICK.choices(VOCABULARY, k=n))


def edited(t, edits):
    w = t.split(" ")
    for _ in range(edits):
        w[PICK.randrange(len(w))] = PICK.choice(VOCABULARY) + "z"
    return " ".join(w)


@pytest.fixture(scope="module")
def odd():
    base, long = text(120), text(9000)
    rows = [(i, edited(base, PICK.randint(0, 6))) for i in range(10, 130)]
    rows += [(200 + i, long if i % 2 else edited(long, 30)) for i in range(4)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "A few Words"), (304, "a few words"), (305, "a few words more")]
    rows += [(306, base.upper()), (306, base.upper()), (None, base), (307, text(30)), (308, text(5))]
    return rows


def brute_links(rows):
    docs = {i: frozenset(shingles(t)) for i, t in rows if i is not None}
    tree = Joined(docs)
    for a in docs:
        for b in docs:
            both = len(docs[a] & docs[b])
            if a < b and both and 100 * both >= 75 * (len(docs[a]) + len(docs[b]) - both):
                tree.join(a, b)
    return {i: (len(s), tree.root(i)) for i, s in docs.items()}


@pytest.mark.parametrize("region", [256, 8])  # the second deals every crowd to blocks
def test_near_duplicates_are_those_of_all_pairs(make_docs, odd, monkeypatch, region):
    monkeypatch.setattr(N, "REGION", region)
    monkeypatch.setattr(N, "GROUP", region)
    expected = brute_links(odd)
    got = N.near_duplicates(make_docs(odd)).collect()
    assert len(got) == len(odd)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and not r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.component_id == r.doc_id)


def test_equal_sets_are_one_class_wherever_they_lie(make_docs):
    t = text(50)
    rows = [(i, t if i % 3 else text(40 + i)) for i in range(60)]
    named = {(r.name1, r.name2) for r in N.described(make_docs(rows), "doc_id").collect() if r.id % 3}
    assert len(named) == 1


def test_look_alikes_give_no_pairs(make_docs, monkeypatch):
    """A group that shares half its words and links nothing is compared, and writes nothing that grows with its square."""
    common, made = text(60), []
    rows = [(i, common + " " + text(14)) for i in range(80)]
    expected = brute_links(rows)
    monkeypatch.setattr(N, "GROUP", 16)
    kept = N.linked_in_blocks
    monkeypatch.setattr(N, "linked_in_blocks", lambda *a: made.append(kept(*a)) or made[-1])
    for r in N.near_duplicates(make_docs(rows)).collect():
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]
    seen = {}
    for r in made[0].collect():
        seen[r.a] = seen.get(r.a, 0) + 1
    assert sum(seen.values()) < N.TREES * len(rows)


def test_near_duplicates_of_given_documents(make_docs, given_docs):
    expected = brute_links(given_docs)
    for r in N.near_duplicates(make_docs(given_docs)).collect():
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(500, i) for i in range(501, 540)] + [(7, 7), (3, 2), (80, 70), (70, 75)]
    tree = Joined(range(1000))
    for a, b in edges:
        tree.join(a, b)
    got = {r.vertex: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {v: tree.root(v) for e in edges for v in e if tree.root(v) != v}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_empty_tables(make_docs, spark):
    none = make_docs([])
    assert N.near_duplicates(none).collect() == []
    assert R.find_repeats(none).collect() == []
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert find_contamination(none, items).collect() == []
    assert decontaminate(make_docs([(1, "a b c d e f"), (None, None)]), items).count() == 2
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert link_embeddings(vectors).collect() == []


def brute_repeats(rows, length=50):
    seen, out = {}, {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            seen[w] = min(seen.get(w, i), i)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("block", [16_000_000, 3_000])
def test_repeats_are_those_of_all_windows(make_docs, odd, given_docs, block):
    shared, period = text(40), "ha " * 400
    rows = [(i, t) for i, t in odd if i is not None]
    rows += [(1000 + i, text(20) + " " + shared[i : i + 70 + i] + " " + text(20)) for i in range(40)]
    rows += [(2000, period), (2001, "x" + period[:200]), (2002, "é" * 60), (2003, "aé" + "é" * 59), (2004, "\0" * 80), (2005, "\0" * 60), (2006, shared[:50]), (2007, shared[:49])]
    rows += [(3000 + i, t) for i, t in given_docs[:40]]
    expected = brute_repeats(rows)
    got = R.find_repeats(make_docs([*rows, (None, shared)]), block_bytes=block).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        removed = sum(e - s for s, e in zip(r.starts, r.ends))
        if r.doc_id is None:
            assert removed == 0 and bytes(r.kept).decode() == shared
        else:
            assert (r.n_bytes, removed, len(r.starts), hashlib.sha256(bytes(r.kept)).hexdigest()) == expected[r.doc_id]


def test_run_length_index_against_sorted_suffixes():
    strings = [b"abracadabra", b"abracadabra", b"cadabr", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", b"aaa", b"\0\0\0\0", b"\0\0", b"b"]
    flat, bounds = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0] + [len(s) for s in strings])
    position, neighbour, prefix = R.run_length_index(flat, bounds)
    whole = [(tuple(c + 1 for c in s[p:]), k, bounds[k] + p) for k, s in enumerate(strings) for p in range(len(s))]
    # A string's end sorts before any byte, ends among each other as the strings do.
    order = [at for *_, at in sorted(whole, key=lambda x: (x[0], x[1]))]
    string_of = np.repeat(np.arange(len(strings)), np.diff(bounds))
    for place, at in enumerate(order):
        sample = np.searchsorted(position, at, "right") - 1
        moved = at - position[sample]
        if place:
            before = order[place - 1]
            assert neighbour[sample] + moved == before
            a, b = flat[at : bounds[string_of[at] + 1]], flat[before : bounds[string_of[before] + 1]]
            same = min(len(a), len(b))
            differ = np.flatnonzero(a[:same] != b[:same])
            assert prefix[sample] - moved == (differ[0] if len(differ) else same)
    assert len(position) < len(flat)


def test_contamination_is_that_of_all_windows(make_docs, spark):
    items = {1: text(60), 2: text(12), 3: "three little words", 4: text(30), 5: None, 6: "", 7: text(5)}
    items[8] = items[4]
    rows = [(i, f"{text(50)} {edited(items[1], i % 6)} {text(9)}") for i in range(40)]
    rows += [(100, items[1][: len(items[1]) * 9 // 10]), (101, "Three little WORDS"), (102, f"{text(9)} three little words"), (103, None), (104, "")]
    rows += [(105, items[2].upper()), (105, items[2].upper()), (106, f"{items[4]}\n\n{items[2]} {items[7]}"), (107, f"{text(9000)} {items[2]} {text(9)}"), (None, items[1])]
    rows += [(200 + i, text(60)) for i in range(20)]
    vocabulary = {s for t in items.values() for s in shingles(t)}
    expected = {}
    for doc, t in rows:
        ours = shingles(t)
        for item, it in items.items():
            theirs = shingles(it)
            for p, first in enumerate(ours):
                if doc is not None and theirs and first in vocabulary:
                    s = similarity(ours[p : p + len(theirs)], theirs)
                    if s >= 0.75 and s > expected.get((doc, item), (0,))[0]:
                        expected[doc, item] = (s, p)
    frame = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in find_contamination(make_docs(rows), frame).collect()}
    assert got == expected and len(got) > 20
    kept = sorted(r.doc_id for r in decontaminate(make_docs(rows), frame).collect() if r.doc_id is not None)
    assert kept == sorted(i for i, _ in rows if i is not None and i not in {d for d, _ in expected})


def test_contamination_runs_no_python(make_docs, spark):
    frame = spark.createDataFrame([(1, text(20))], "item_id bigint, text string")
    plan = find_contamination(make_docs([(1, text(20))]), frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def brute_vectors(rows, threshold=0.93):
    good = {}
    for number, (i, v, label) in enumerate(rows):
        sound = i is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if sound:
            array = np.array(v, np.float32).astype(float)
            good[number] = array / np.linalg.norm(array)
    links, tree = [0] * len(rows), Joined({r[0] for r in rows if r[0] is not None})
    for a in good:
        for b in good:
            same = a != b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b])
            if same and good[a] @ good[b] >= threshold:
                links[a] += 1
                if rows[a][0] != rows[b][0]:
                    tree.join(rows[a][0], rows[b][0])
    return sorted((i, links[n], i if i is None else tree.root(i)) for n, (i, _, _) in enumerate(rows) if i is not None)


@pytest.mark.parametrize("leaf, block", [(4096, 2048), (24, 2048), (60, 16)])
def test_vector_links_are_those_of_all_pairs(spark, monkeypatch, leaf, block):
    monkeypatch.setattr("tallyforge.llm.embedding_links.BLOCK", block)
    random_ = np.random.default_rng(5)
    centers = random_.standard_normal((30, 16))
    vectors = [centers[k % 30] + random_.standard_normal(16) * (0.05 + 0.02 * (k % 11)) for k in range(400)]
    rows = [(k, [float(x) for x in v], k % 3) for k, v in enumerate(vectors)]
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(50)] + [(1100, [2 * x for x in rows[5][1]], rows[5][2])]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan"), *[1.0] * 15], 1), (2004, [None, *[1.0] * 15], 1)]
    rows += [(2005, [float("inf"), *[1.0] * 15], 1), (2006, rows[5][1], None), (2007, rows[5][1][:8], rows[5][2]), (2008, rows[5][1][:8], rows[5][2]), (None, rows[5][1], rows[5][2])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = link_embeddings(frame, leaf=leaf).collect()
    assert len(got) == len(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None) == brute_vectors(rows)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, False)]


def test_forest_recall_at_the_threshold():
    random_ = np.random.default_rng(9)
    unit = random_.standard_normal((4000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    other = random_.standard_normal((4000, 64))
    other -= (other * unit).sum(1, keepdims=True) * unit
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    partner = 0.93 * unit + np.sqrt(1 - 0.93**2) * other
    forest = fit_forest(unit, len(unit), 0.93, leaf=150)
    met = np.zeros(len(unit), bool)
    for tree in forest:
        reached = [set(zip(*x)) for x in ([a.tolist() for a in tree.leaves(v)] for v in (unit, partner))]
        met[[row for row, _ in reached[0] & reached[1]]] = True
    assert met.mean() > 0.999


def test_a_pair_counts_in_its_first_leaf_only():
    pair = np.array([[1.0, 0], [1, 0.01], [0, 1]])
    lists = [np.array([2, 5]), np.array([2, 5]), np.array([5])]
    assert compare_leaf(pair, lists, 2, np.zeros(3), np.ones(3), 0.9)[0].tolist() == [1, 1, 0]
    assert compare_leaf(pair, lists, 5, np.zeros(3), np.ones(3), 0.9)[0].tolist() == [0, 0, 0]


def test_words_are_split_as_said():
    from tallyforge.llm.words import word_hashes

    samples = ["A b\tC  d", "", " x y ", "a b", "É é"]
    data = "".join(samples).encode()
    offsets = np.cumsum([0] + [len(s.encode()) for s in samples])
    hashes, firsts = word_hashes(np.frombuffer(data, np.uint8), offsets)
    flat = [w for s in samples for w in words(s)]
    assert np.diff(firsts).tolist() == [len(words(s)) for s in samples]
    assert len(set(hashes.tolist())) == len(set(flat)) and [hashes.tolist().index(h) for h in hashes.tolist()] == [flat.index(w) for w in flat]


def test_a_dense_group_is_not_multiplied_by_the_forest():
    random_numbers = np.random.default_rng(6)
    around = random_numbers.standard_normal((20_000, 64))
    around /= np.linalg.norm(around, axis=1, keepdims=True)
    dense = np.sqrt(0.92) * np.eye(64)[0] + np.sqrt(0.08) * around
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    for unit, total, least in ((dense, 20_000, 1), (around, 1_000_000, 100), (np.vstack([dense, around]), 40_000, 4)):
        for tree in fit_forest(unit, total, 0.93, trees=2):
            rows, leaves = tree.leaves(unit)
            assert len(rows) <= 16 * len(unit) and len(set(leaves.tolist())) >= least


def test_more_blocks_than_numbers_are_refused(make_docs, monkeypatch):
    monkeypatch.setattr(R, "MOST_BLOCKS", 7)
    with pytest.raises(ValueError, match="larger block_bytes"):
        R.find_repeats(make_docs([(1, "x")]))


def test_signatures_are_made_of_small_rounds(monkeypatch):
    import pyarrow as pa

    taken, whole = [], N.shingle_sets

    def noted(data, offsets):
        taken.append(len(data))
        return whole(data, offsets)

    class Docs:  # rows of one task
        def mapInArrow(self, function, _schema):
            return list(function([pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(["word " * 1000] * 299 + ["x" * 700_000])], names=["id", "text"])]))

        def select(self, *_):
            return self

    monkeypatch.setattr(N, "shingle_sets", noted)
    monkeypatch.setattr(N, "need", lambda docs, *_: docs)
    monkeypatch.setattr(N.F, "col", lambda name: type("C", (), {"cast": lambda s, _: s, "alias": lambda s, _: s})())
    made = N.described(Docs(), "id")
    assert sum(batch.num_rows for batch in made) == 300
    assert sum(taken) == 299 * 5000 + 700_000 and sorted(taken)[-2] <= 500_000 and taken[-1] == 700_000


def test_a_stage_of_the_cutting_holds_one_python_function(make_docs):
    # Each further one is a further Python process for every task, and all of them stay.
    passage = "the same fifty bytes of text stand in two documents, éèê "
    docs = make_docs([(1, passage), (2, "before " + passage), (3, None), (None, passage)])
    cut = R.cut_texts(docs)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "EvalPython" not in plan
    assert {r.doc_id: r.text for r in cut.collect()} == {1: passage, 2: "before ", 3: "", None: passage}


def test_rounds_of_array_work_are_small():
    import pyarrow as pa

    texts = [f"{i} " * 2000 for i in range(200)]
    table = pa.table({"doc": list(range(200)), "text": texts})
    block = R._Block(table, 4, 50)
    assert sum(len(r[2]) for r in block.rounds) == sum(map(len, texts)) and max(len(r[2]) for r in block.rounds) <= 125_000
