from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from riskmart.llm import collocations, transducers

KIND = "doc_id long, text string, lang string, n long"


def by_definition(rows, least, keep=2000):
    counts, sizes = {}, Counter()
    for _, text, lang, _ in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            own.update(tuple(words[i : i + n]) for n in (1, 2, 3, 4) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if a >= least and len(p) > 1}
        best = []
        for p, a in found.items():
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            longer = (q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not any(100 * found[q] >= 80 * a for q in longer):
                best.append((-score, -a, " ".join(p).encode(), a, own[p[:k]], own[p[k:]], score))
        out += [(lang, rank, b[2].decode(), b[3], b[4], b[5], sizes[lang], b[6]) for rank, b in enumerate(sorted(best)[:keep], 1)]
    return sorted(out)


def corpus(seed, docs=60):
    rng = random.Random(seed)
    words = ["a", "A", "b", "c", "éa", "x\x1fy", "d", "\x00", "日本"]
    rows = []
    for i in range(docs):
        text = "".join(rng.choices(words, weights=[9, 2, 5, 3, 2, 1, 2, 1, 1])[0] + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "\r", "\x0b ", " "]) for _ in range(rng.randrange(80)))
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None]), 1))
    return rows + [(None, None, "en", 1), (7, "", None, 1), (8, "?!", "fr", 1), (9, "one two " * 30, "en", 1), (9, "one two " * 30, "en", 1)]


@pytest.mark.parametrize("slice_bytes, range_bytes", [(1 << 24, 1 << 24), (200, 100)])  # the second makes many shards and ranges
def test_phrases(spark, slice_bytes, range_bytes):
    rows = corpus(1)
    found = collocations.collocations(spark.createDataFrame(rows, KIND), least=5, slice_bytes=slice_bytes, range_bytes=range_bytes)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == by_definition(rows, 5)


def test_first_phrases_only(spark):
    rows = corpus(2)
    found = collocations.collocations(spark.createDataFrame(rows, KIND), least=4, keep=5)
    assert sorted(map(tuple, found.collect())) == by_definition(rows, 4, 5)


def test_empty_and_rare(spark):
    assert collocations.collocations(spark.createDataFrame([], KIND)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, "a b c", "en", 1)], KIND)).collect() == []


def test_hot_word(spark, monkeypatch):
    from riskmart.llm import hotjoin

    monkeypatch.setattr(hotjoin.join_unique, "__defaults__", (3,))
    rows = [(i, " ".join(f"the w{j}" for j in range(30)), "en", 1) for i in range(6)]
    found = collocations.collocations(spark.createDataFrame(rows, KIND), least=5, slice_bytes=300, range_bytes=150)
    assert sorted(map(tuple, found.collect())) == by_definition(rows, 5)


def random_phrases(seed, n=400):
    rng = random.Random(seed)
    words = sorted({f"{c}{d}".encode() for c in "abcdef" for d in range(4)})
    return words, Counter(tuple(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(n))


def transducer(words, counts):
    number = {w: i for i, w in enumerate(words)}
    phrases = sorted(counts)
    codes = np.array([[number[w] for w in p] + [-1] * (4 - len(p)) for p in phrases], np.int64).reshape(-1, 4)
    return transducers.trim(words, codes, np.array([counts[p] for p in phrases], np.int64))


def listed(made):
    codes, weights = made.phrases()
    return Counter({tuple(made.words[c] for c in row if c >= 0): int(w) for row, w in zip(codes, weights)})


def test_transducer_holds_its_phrases_and_shares_states():
    words, counts = random_phrases(3)
    made = transducers.Transducer.load(transducer(words, counts).dump())
    assert listed(made) == counts
    same = transducer([b"a", b"b", b"c"], {(x, y): 2 for x in (b"a", b"b") for y in (b"a", b"b", b"c")})
    assert len(same.first) - 1 == 3  # none, one state for both first words, the start


def test_union_sums(monkeypatch):
    parts = [random_phrases(seed, 300) for seed in range(5)]
    monkeypatch.setattr(transducers, "ENTRIES", 50)
    union = transducers.Union()
    for words, counts in parts:
        union.add(transducer(words, counts))
    total = sum((c for _, c in parts), Counter())
    assert listed(union.result(2)) == Counter({p: n for p, n in total.items() if n >= 2})


def test_composition():
    words, counts = random_phrases(6)
    made = transducer(words, counts)
    number = {w: i for i, w in enumerate(made.words)}
    asked = [*counts, (b"zz",), (words[0], b"zz"), (b"a0", b"a0", b"a0", b"a0")]
    codes = np.array([[number.get(w, -2) for w in p] + [-1] * (4 - len(p)) for p in asked])
    assert made.weights_of(codes).tolist() == [counts[p] for p in asked]


def test_ranges_follow_word_order():
    words, counts = random_phrases(7)
    pairs = Counter()
    for p, n in counts.items():
        pairs[p[:2] if len(p) > 1 else (p[0],)] += n
    ranges = transducers.even_ranges({**{w: 1 for w in words}, words[3]: 60}, 8)
    made = transducer(words, pairs)
    codes, _ = made.phrases()
    numbers = ranges.of_rows(made.words, codes[:, :2] if codes.shape[1] > 1 else codes)
    for row, where in zip(codes, numbers):
        split = [made.words[c] for c in row if c >= 0]
        assert ranges.of(split[0], split[1] if len(split) > 1 else b"") == where
    assert ranges.hot and len(set(numbers.tolist())) > 5


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_slices_of_folded_texts_hold_the_words_of_the_plain_split(monkeypatch, chunk):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    texts = ["", " ", "  a  b\tA,", "..", "b.c  d ,e\n\nf", "\x1c \x85 é z", "abcdefghijkl m", "a b a b a b"]
    own = collocations._Slice(b"en", None)
    expected = []
    for text in texts:
        for part in collocations._parts(text.encode()):
            own.add(part)
        own.add(collocations.BREAK)
        expected += [w for part, _ in collocations.tokens(text.encode()) for w in part] + [collocations.BREAK]
    codes, old, words, _ = own._numbered()
    assert words == sorted({*expected} - {collocations.BREAK})
    assert [words[c] if c >= 0 else collocations.BREAK for c in codes.tolist()] == expected
    assert not old.any() and own.most >= len(expected) - expected.count(collocations.BREAK)
