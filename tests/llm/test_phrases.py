import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import phrases as P
from tallyforge.llm.queries import QUERIES


def counted(rows):
    """f by (lang, words) and n by lang."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, 6):
                f.update((lang or "und", tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    return f, n


def brute(rows, least=100, top=2000):
    f, n = counted(rows)
    often = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    out = {}
    for (lang, w), a in often.items():
        inside = any(
            len(x) > len(w) and b >= a and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))
            for (other, x), b in often.items() if other == lang
        )
        if not inside:
            cuts = [(int(Fraction(1000 * a * n[lang], f[lang, w[:k]] * f[lang, w[k:]])), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((" ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    return [
        (lang, rank, *r)
        for lang, found in sorted(out.items())
        for rank, r in enumerate(sorted(found, key=lambda r: (-r[5], -r[1], r[0].encode()))[:top], 1)
    ]


def texts(seed, count):
    r = random.Random(seed)
    vocabulary = ["new", "York", "CITY", "the", "of", "é", "ünï", "日本", "a\x0bb", "x\x1cy", "stock-market", "the"]
    joints = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", ";"]
    return ["".join(r.choice(vocabulary) + r.choice(joints) for _ in range(r.randint(0, 60))) for _ in range(count)]


def mined(spark, rows, **more):
    docs = spark.createDataFrame(
        [(i, t, l, "x", 1.0) for i, (t, l) in enumerate(rows)], "doc_id bigint, text string, lang string, phrase string, n double"
    )
    return [tuple(r) for r in P.mine_phrases(docs.repartition(3), **more).orderBy("lang", "rank").collect()]


def test_phrases_of_odd_rows(spark):
    rows = [(t, ("en", "fr", None)[i % 3]) for i, t in enumerate(texts(1, 400))] + [(None, "en"), ("", None), ("!?", "de"), ("new york " * 5_000, "en")]
    assert mined(spark, rows, least=20) == brute(rows, 20)
    assert mined(spark, rows, least=20, top=3, batch_bytes=2_000) == brute(rows, 20, 3)
    assert mined(spark, []) == []


def test_query_on_the_given_table(spark, given):
    rows = [tuple(r) for r in spark.read.parquet(f"{given}/documents.parquet").select("text", "lang").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_phrase_mining"](spark, given).collect()) == brute(rows)


def test_texts_are_shuffled_once(spark, given):
    docs = spark.read.parquet(f"{given}/documents.parquet")
    rows = docs.selectExpr("cast(doc_id % 8 as int) batch", "lang", "xxhash64(lang) tongue", "text")
    found = P._settled(rows, 8, 100)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.find("Initial Plan")].count("ReusedExchange") == 1


def grouped(table, column):
    for value in sorted(set(table[column].to_pylist())):
        yield value, table.filter(pa.compute.equal(table[column], value))


@pytest.mark.parametrize("mask, spelled_again", [(2**64 - 1, False), (0xFF00000000000F, None), (1, True)])
def test_counts_are_exact_when_fingerprints_collide(monkeypatch, mask, spelled_again):
    whole = P.Words.runs
    monkeypatch.setattr(P.Words, "runs", lambda self, t: ((n, at, p & np.uint64(mask)) for n, at, p in whole(self, t)))
    # The last batch has frequent phrases of its own, which no other batch can spell.
    rows = [(t, ("en", "fr")[i % 2]) for i, t in enumerate([*texts(2, 60), "own frequent words " * 40])]
    tongue = {"en": 5, "fr": -7}
    batches = [
        pa.table({
            "batch": pa.array([number] * len(part), pa.int32()), "text": [t for t, _ in part], "lang": [l for _, l in part],
            "tongue": pa.array([tongue[l] for _, l in part], pa.int64()),
        })
        for number, part in enumerate((rows[:20], rows[20:45], rows[45:]))
    ]
    sent = pa.concat_tables([P._fingerprints(4)((pa.scalar(i),), b) for i, b in enumerate(batches)])
    told = pa.concat_tables([P._frequent(30)(part) for _, part in grouped(sent, "bucket")])
    answers = pa.concat_tables([P._answer(b, told.filter(pa.compute.equal(told["batch"], i))) for i, b in enumerate(batches)])
    settled = pa.concat_tables([P._settle(30)(part) for _, part in grouped(answers, "bucket")])
    lost = settled.filter(pa.compute.is_valid(settled["print"]))
    assert spelled_again is None or bool(len(lost)) == spelled_again
    again = pa.concat_tables([P._spell(batches[i], part) for i, part in grouped(lost, "batch")]) if len(lost) else lost
    got = Counter()
    for r in settled.filter(pa.compute.is_null(settled["print"])).to_pylist():
        got[r["lang"], r["phrase"]] += r["f"]
    from_strings = Counter()
    for r in again.to_pylist():
        from_strings[r["lang"], r["phrase"]] += r["f"]
    assert not set(from_strings) & set(got)
    got += Counter({k: f for k, f in from_strings.items() if f >= 30})
    f, n = counted(rows)
    assert got == {**{(l, " ".join(w)): v for (l, w), v in f.items() if v >= 30}, **{(l, None): v for l, v in n.items()}}


def test_words_of_one_hash_are_told_apart(monkeypatch):
    words = P.Words.read(pa.array(["ab cd ab", "xyz cd"]))
    apart = words.numbers()
    words.hashes[:] = 1
    for numbers in (apart, words.numbers()):
        assert numbers[0] == numbers[2] and numbers[1] == numbers[4] and len(set(numbers.tolist())) == 3


def test_packing_numbers_round_trips():
    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (P._sorted_unpacked(P._sorted_packed(values), 1000) == values).all()
    assert len(P._sorted_packed(values)) < 8 * 1000
