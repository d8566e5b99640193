import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyforge.llm.packing import TIERS, pack_documents
from tallyforge.llm.token_shards import in_training_order, permuted, write_shards
from tallyforge.llm.tokens import Encoder

MODEL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
MODEL.encode_special_tokens = True


def ids(text):
    return [*MODEL.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_the_vocabularys(given_docs):
    encoder, pick = Encoder(), random.Random(1)
    signs = ["a", " ", "  ", "\n", "\t", ".", "'s", "é", "12", "\x1f", "　", "字", "🙂", "<|endoftext|>", "%%%"]
    texts = [t for _, t in given_docs[:60]] + ["".join(pick.choices(signs, k=9)) for _ in range(500)]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == ids(text)[:-1]


@pytest.mark.parametrize("special", [False, True])
def test_long_runs_of_blanks_are_encoded(special):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = not special
    encoder = Encoder(special=special)
    for text in ("a" + " " * 1_000_000 + "b<|endoftext|>", "\n" * 5_000_000, "x" + " " * 50_001 + "y"):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_ids_that_two_bytes_do_not_hold_are_refused(make_docs, monkeypatch, tmp_path):
    ranks = tmp_path / "ranks"
    given = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()[:256]
    ranks.write_bytes(b"\n".join(b"%s %d" % (line.split()[0], 70_000 + i) for i, line in enumerate(given)))
    with pytest.raises(Exception, match="does not fit 2 bytes"):
        in_training_order(make_docs([(1, "x")]), vocabulary=str(ranks)).collect()


def test_other_documents_replace_the_shards_of_a_folder(make_docs, tmp_path):
    docs = make_docs([(i, f"text {i} " * 200) for i in range(40)], 2)
    for key in (1, 2, 2):
        for shard in write_shards(in_training_order(docs, records_per_shard=5, permutation_key=key), str(tmp_path)).collect():
            assert zlib.crc32(open(shard.path, "rb").read()) == shard.crc32


def rows(given_docs):
    return given_docs[:150] + [(900, None), (901, ""), (902, "x"), (902, "x"), (None, "no key"), (903, "long word " * 40_000)]


def test_pieces_cover_every_id_once_and_fill_windows(make_docs, given_docs):
    given = [r for r in rows(given_docs) if r[0] != 902] + [(902, "x")]
    got = pack_documents(make_docs(given), buffer_tokens=20_000).collect()
    texts, sequences = dict(given), {}
    for doc in texts:
        own = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist() == ids(texts[doc])
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert {r.doc_tokens for r in own} == {len(ids(texts[doc]))}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    padded = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        used = sum(r.length for r in pieces)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        assert pieces[0].window in TIERS and used <= pieces[0].window
        padded += used < pieces[0].window
    assert padded <= 3  # one for each task
    assert len({r.window for r in got}) == len(TIERS)


def test_repeated_rows_and_empty_tables(make_docs):
    got = pack_documents(make_docs([(1, "x"), (1, "x")], 1)).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(1, 2), (1, 2)]
    assert pack_documents(make_docs([])).collect() == []
    assert in_training_order(make_docs([])).collect() == []


def test_permutation_is_one_to_one():
    for size in (1, 2, 3, 17, 1000, 65_537):
        slots = permuted(np.arange(size), size, 5)
        assert sorted(slots.tolist()) == list(range(size))
    assert permuted(np.arange(1000), 1000, 5).tolist() != permuted(np.arange(1000), 1000, 6).tolist()


def test_shards_hold_the_ids_in_order(make_docs, given_docs, tmp_path):
    ordered = in_training_order(make_docs(rows(given_docs), 2), records_per_shard=50)
    got = ordered.collect()
    assert [r.slot for r in sorted(got, key=lambda r: r.slot)] == list(range(len(got)))
    assert all(r.shard == r.slot // 50 and r.byte_offset == r.slot % 50 * 2048 and len(r.ids) == 2048 for r in got)
    assert sum(r.n_tokens for r in got) == sum(len(ids(t)) for _, t in rows(given_docs))
    assert {d for r in got for d in r.docs} == {i for i, _ in rows(given_docs)}
    for _ in range(2):  # a second run finds the shards and leaves them
        written = write_shards(ordered, str(tmp_path)).collect()
        for shard in written:
            data = open(shard.path, "rb").read()
            own = sorted((r for r in got if r.shard == shard.shard), key=lambda r: r.slot)
            assert data == b"".join(bytes(r.ids) for r in own)
            assert (shard.records, shard.bytes, shard.crc32) == (len(own), len(data), zlib.crc32(data))
    assert len(list(tmp_path.iterdir())) == len(written)


def test_queries_give_special_tokens_their_ids(make_docs):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {1: "a<|endoftext|>b", 2: "<|endoftext|>", 3: " <|endoftext|>\n<|endoftext|> <|endoftext|", 4: "plain"}
    expected = {d: [*model.encode(t, add_special_tokens=False).ids, 0] for d, t in texts.items()}
    assert expected[1] == [64, 50256, 65, 0]
    docs = make_docs(list(texts.items()), 1)
    pieces = sorted(pack_documents(docs).collect(), key=lambda r: r.start)
    for doc, own in expected.items():
        assert [i for r in pieces if r.doc_id == doc for i in np.frombuffer(bytes(r.ids), "<u4")] == own
    (record,) = in_training_order(docs).collect()
    want = [i for d in record.docs for i in expected[d]]
    assert np.frombuffer(bytes(record.ids), "<u2")[: record.n_tokens].tolist() == want
