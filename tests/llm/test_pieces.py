from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece

from riskmart.llm import pieces

from .conftest import prose


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary(pieces.default_model()))


def listed(ids):
    return np.frombuffer(ids, "<u4").tolist()


TEXTS = [
    "Hello  world", " lead", "x\n\ny\tz", "ﬁ ①ﾊ́é é", "a▁b", "trail ", "", "  ", "日本語🙂​", "\r\nfoo", "<s> hi </s>", "<0x0A> <unk>",
    "a\x00b", "a" * 3000, "\n" * 50, " " * 100 + "x" + "-" * 77, "responsibilityresponsibility", "▁", "▁▁x", prose(1, 400),
]


def test_ids_equal_the_library(encoder, library):
    rng = random.Random(1)
    letters = "abcdethionrs éß日本🙂\n\t.-=#▁"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert listed(ids) == library.encode(text), text


def test_small_batches_and_caches_change_nothing(monkeypatch, encoder, library):
    monkeypatch.setattr(pieces, "BATCH_CHARACTERS", 10)
    monkeypatch.setattr(pieces, "CACHED_WORDS", 1)
    own = pieces.Encoder(encoder.vocabulary)
    for _ in range(2):
        assert [listed(i) for i in own.encode(TEXTS)] == library.encode(TEXTS)


def test_decoding_equals_the_library(library):
    plain = pieces.plain_of(pieces.default_model())
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(3, 32000) for _ in range(rng.randrange(12))]
        assert pieces.decode_ids(np.array(ids, "<u4").tobytes(), plain) == library.decode(ids)


def test_one_pass_equals_two(odd_docs, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 3)
    two = pieces.decode(pieces.encode(odd_docs)).select("doc_id", "text", "ids", "decoded").collect()
    one = pieces.encode_and_decode(odd_docs).select("doc_id", "text", "ids", "decoded").collect()
    assert sorted(one, key=str) == sorted(two, key=str)


def test_round_trip(odd_docs, library):
    docs = odd_docs.withColumnRenamed("rank", "decoded")
    rows = pieces.decode(pieces.encode(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert listed(r.ids) == library.encode(r.text or "") and r.decoded == (r.text or "")
    assert pieces.decode(pieces.encode(docs.limit(0))).collect() == []
    assert pieces.decode(docs.selectExpr("cast(null AS binary) AS ids")).first().decoded == ""


def test_search_finds_every_occurrence():
    vocabulary = pieces.Vocabulary(pieces.default_model())
    text = np.array([ord(c) for c in "the theathe▁there"] + [pieces.GAP] * (vocabulary.longest + 1))
    order = pieces.rank_by_doubling(text, vocabulary.longest)
    low, high = pieces._search(text, order, vocabulary)
    plain = "the theathe▁there"
    for piece in ("the", "▁the", "there", "e", "thea", "zz"):
        row = int(np.flatnonzero(vocabulary.numbers == vocabulary.ids[piece])[0]) if piece in vocabulary.ids else None
        if row is not None:
            assert sorted(order[low[row] : high[row]]) == [i for i in range(len(plain)) if plain.startswith(piece, i)]
