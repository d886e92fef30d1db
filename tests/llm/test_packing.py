from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskmart.llm import packing

from .conftest import prose


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(packing.default_tokenizer())
    own.encode_special_tokens = True
    return own


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(2)
    letters = "àÀÿÞµªºõ­abCDé'st.,!?;: \n\tΣİßﬁ①é <|>日#_क़"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["it's they'll we've. I'm! x's.", "<|endoftext|> <|startoftext|>.", "ΣΑΣ. ΟΔΟΣ,", "", "a\x85b c d e", prose(1, 300)]
    encoder = packing.WordEncoder(packing.default_tokenizer())
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)[:-1], text


SPECIAL = [
    "a <|endoftext|> b", "a<|endoftext|>b", "<|endoftext|><|startoftext|>", "it'<|endoftext|>s.", "e<|startoftext|>\u0301", "<|ENDOFTEXT|>",
    "<|endoftext |>", "<<|endoftext|>>\n<|startoftext|>", "<|endoftext|>",
]


def test_added_tokens_in_texts(monkeypatch, make_docs):
    loaded = Tokenizer.from_file(packing.default_tokenizer())
    assert loaded.encode(SPECIAL[0], add_special_tokens=False).ids == [320, 49407, 321]
    encoder = packing.WordEncoder(packing.default_tokenizer(), special_as_text=False)
    for _ in range(2):  # with known words, then with cleared ones
        for text, ids in zip(SPECIAL, encoder.encode(SPECIAL)):
            assert np.frombuffer(ids, "<u4").tolist() == loaded.encode(text, add_special_tokens=False).ids, text
        monkeypatch.setattr(packing, "CACHED_WORDS", 1)
    for r in packing.pack_documents(make_docs(list(enumerate(SPECIAL)))).collect():
        ids = np.array(ids_of(loaded, SPECIAL[r.doc_id]), "<u4")
        assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_small_caches_change_nothing(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "CACHED_WORDS", 1)
    monkeypatch.setattr(packing, "CACHED_STEMS", 1)
    encoder = packing.WordEncoder(packing.default_tokenizer())
    for text in (prose(1, 40), prose(2, 40), prose(1, 40)):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids_of(tokenizer, text)[:-1]


def test_words_met_first_stay_known_when_there_are_too_many(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 6)
    encoder = packing.WordEncoder(packing.default_tokenizer())
    texts = ["the house", "Seven other words\nare too many.", "", "the house again"]
    whole = encoder.encode(texts)
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: (learned.extend(words), learn(words)))
    assert [encoder.encode([text])[0] for text in texts] == whole
    assert not {"the", "house"} & set(learned)



def best_fill(lengths, counts, room):
    """Largest reachable sum, by trying every number of every length."""
    sums = {0}
    for length in lengths:
        sums = {s + k * length for s in sums for k in range(counts[length] + 1) if s + k * length <= room}
    return max(sums)


def test_fill_is_optimal_and_within_the_counts():
    rng = random.Random(4)
    for _ in range(300):
        counts = {rng.randrange(1, 30): rng.randrange(1, 6) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(0, 80)
        lengths = sorted(counts, reverse=True)
        used = packing.fill_window(lengths, counts, room)
        assert all(0 < n <= counts[length] for length, n in used.items())
        assert sum(length * n for length, n in used.items()) == best_fill(lengths, counts, room)


def test_plan_places_every_piece_once():
    rng = random.Random(5)
    for _ in range(50):
        histogram = {rng.randrange(1, 65): rng.randrange(1, 500) for _ in range(rng.randrange(1, 40))}
        plan = packing.plan_windows(histogram, 64)
        used = {}
        for repeats, pattern in plan:
            assert sum(length * n for length, n in pattern.items()) <= 64
            for length, n in pattern.items():
                used[length] = used.get(length, 0) + n * repeats
        assert used == histogram


def test_plan_size_does_not_follow_the_number_of_pieces():
    small = {length: 10 for length in range(1, 65)}
    large = {length: 10**9 for length in range(1, 65)}
    assert len(packing.plan_windows(large, 64)) <= 4 * len(packing.plan_windows(small, 64))


def check_packed(rows, window):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return by_sequence


@pytest.mark.parametrize("group", [50_000, 3])
def test_documents(monkeypatch, make_docs, tokenizer, group):
    monkeypatch.setattr(packing, "GROUP", group)
    texts = {i: prose(i, n) for i, n in enumerate([1, 5, 5, 5, 400, 3000, 1200, 40, 40, 40, 40])} | {50: None, 51: ""}
    rows = packing.pack_documents(make_docs(list(texts.items()))).collect()
    check_packed(rows, 2048)
    for i, text in texts.items():
        ids = np.array(ids_of(tokenizer, text), "<u4")
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces)]))[:-1]
        assert sum(r.length for r in pieces) == len(ids) and {r.doc_tokens for r in pieces} == {len(ids)}
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_little_padding(make_docs):
    rows = packing.pack_documents(make_docs([(i, prose(i, 30 + i % 400)) for i in range(400)])).collect()
    sequences = check_packed(rows, 2048)
    assert sum(r.length for r in rows) > 0.97 * 2048 * len(sequences)


def test_odd_rows(odd_docs):
    rows = packing.pack_documents(odd_docs).collect()
    check_packed(rows, 2048)
    assert sum(r.start == 0 for r in rows) == odd_docs.count()
    assert packing.pack_documents(odd_docs.limit(0)).collect() == []


def test_assembled_sequences(make_docs, tokenizer):
    texts = {i: prose(i, 700) for i in range(6)}
    pieces = packing.cut_documents(make_docs(list(texts.items())))
    packed = packing.pack(pieces).collect()
    whole = {r.sequence_id: r for r in packing.assemble(packing.pack(pieces), pad=7).collect()}
    for r in whole.values():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == 2048 and (ids[r.used :] == 7).all()
    for r in packed:
        ids = np.frombuffer(whole[r.sequence_id].ids, "<u4")[r.offset : r.offset + r.length].tolist()
        assert ids == ids_of(tokenizer, texts[r.doc_id])[r.start : r.start + r.length]
