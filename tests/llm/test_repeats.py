from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from riskmart.llm import repeats, suffixes

from .conftest import prose


def removed_by_counting(texts, length):
    """Every string of every text counted; the ranges that repeated ones cover."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                covered[i + 1 : i + length + 1] = True
        edges = np.flatnonzero(np.diff(covered.astype(int)))
        out.append((len(d), [(int(s), int(e)) for s, e in zip(edges[::2], edges[1::2])], bytes(b for b, c in zip(d, covered[1:]) if not c)))
    return out


def removed(docs, **options):
    rows = repeats.remove_repeats(docs, **options).collect()
    return sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in rows)


def corpus():
    """Copies, near copies, shared passages, periodic texts, many borders of one passage."""
    passage, rng = prose(900, 90), random.Random(6)
    rows = [(i, prose(i, 150)) for i in range(6)]
    rows += [(10, rows[0][1]), (11, rows[0][1]), (12, rows[1][1][:700] + "!" + rows[1][1][701:])]
    rows += [(20 + i, prose(100 + i, rng.randrange(40)) + " " + passage + " " + prose(200 + i, rng.randrange(40))) for i in range(12)]
    rows += [(40, "ab" * 600), (41, "x" * 399), (42, "x" * 400), (43, "x" * 401 + prose(1000, 10)), (44, "é" * 333), (45, prose(300, 60) * 2)]
    rows += [(50, None), (51, ""), (52, "Éan " * 200), (53, passage), (54, passage[1:])]
    return rows


@pytest.mark.parametrize("crowd", [4096, 2])  # with 2, crowded hashes are counted string by string
@pytest.mark.parametrize("length", [400, 150])
def test_equals_counting(make_docs, length, crowd):
    rows = corpus()
    expected = [(i, *x) for (i, _), x in zip(rows, removed_by_counting([t for _, t in rows], length))]
    assert removed(make_docs(rows, clash=False), length=length, crowd=crowd) == sorted(expected)


def test_small_segments_and_shards_change_nothing(monkeypatch, make_docs):
    rows = corpus()
    texts = [(t or "").encode() for _, t in rows]
    whole = {(n, a + i) for n, at, count, _, _ in repeats.fragments(texts) for a, c in zip(at.tolist(), count.tolist()) for i in range(c)}
    monkeypatch.setattr(repeats, "SEGMENT_BYTES", 500)
    monkeypatch.setattr(repeats, "FRAGMENT_STARTS", 50)
    parts = [(n, a + i) for n, at, count, _, _ in repeats.fragments(texts) for a, c in zip(at.tolist(), count.tolist()) for i in range(c)]
    assert len(parts) == len(set(parts)) and set(parts) == whole
    assert whole == {(n, i) for n, t in enumerate(texts) for i in range(len(t) - 399)}


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    docs = odd_docs.drop("kept", "h").withColumnRenamed("fp", "removed")
    found = repeats.remove_repeats(docs)
    assert found.columns == [*(c for c in docs.columns if c != "removed"), "n_bytes", "removed", "kept"]
    expected = [(i, *x) for (i, _), x in zip(rows, removed_by_counting([t for _, t in rows], 400))]
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in found.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_text_without_split_characters(make_docs):
    shared = "é" * 200
    rows = repeats.remove_repeats(make_docs([(1, "aé" + shared + "ü"), (2, "b" + shared)], clash=False), as_text=True).collect()
    assert all("�" not in r.kept for r in rows)


@pytest.mark.parametrize("small_alphabet", [0, 1024])
def test_suffix_arrays(small_alphabet):
    rng = np.random.default_rng(1)
    for _ in range(150):
        text = rng.integers(0, rng.integers(1, 5) + 1, rng.integers(0, 60)).astype(np.uint8)
        data = bytes(text.tolist())
        order = suffixes.suffix_array(text, 256, small_alphabet)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        if len(text):
            prefix, previous = suffixes.permuted_common_prefixes(text, order)
            for a, b in zip(order, order[1:]):
                common = 0
                while max(a, b) + common < len(data) and data[a + common] == data[b + common]:
                    common += 1
                assert (prefix[b], previous[b]) == (common, a)


def test_sliding_minimum():
    values = np.random.default_rng(2).integers(0, 100, 50, np.uint64)
    for width in (1, 2, 7, 50):
        assert repeats.sliding_minimum(values, width).tolist() == [values[i : i + width].min() for i in range(51 - width)]


def test_short_ranges_of_few_words_stay(make_docs):
    few, many = "x" * 300, " ".join(f"w{i:03}" for i in range(60))
    rows = [(i, f"{'ab'[i]} {few} {'cd'[i]} {many} {'ef'[i]}") for i in range(2)]
    kept = [r.kept for r in repeats.remove_repeats(make_docs(rows, clash=False), length=255, as_text=True, least_words=51).collect()]
    assert all(few in k and "w030" not in k for k in kept)
