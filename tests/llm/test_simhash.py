from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from riskmart.llm import simhash

from .conftest import prose


def by_definition(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(values, distance=4):
    root = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if bin(a ^ b).count("1") <= distance and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


@pytest.mark.parametrize("text", [None, "", " \n", "a", "A b C", "a b c d", "Éa é b c d", prose(3, 200)])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == by_definition(text)


def test_long_text_in_chunks(monkeypatch):
    whole = simhash.fingerprint(prose(4, 500))
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(prose(4, 500)) == whole


def near_values(seed, groups, members, spread):
    rng = random.Random(seed)
    out = set()
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(members):
            value = centre
            for bit in rng.sample(range(64), rng.randrange(spread)):
                value ^= 1 << bit
            out.add(value)
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 8])  # with 8, groups are cut into blocks
@pytest.mark.parametrize("groups, members, spread", [(40, 5, 6), (2, 120, 4)])
def test_links_span_all_components(spark, block, groups, members, spread):
    values = near_values(groups, groups, members, spread)
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    found = simhash.links(frame, block=block).collect()
    unsigned = [(r.a % 2**64, r.b % 2**64) for r in found]
    assert all(bin(a ^ b).count("1") <= 4 for a, b in unsigned)
    root = {v: v for v in values}
    for _ in values:
        for a, b in unsigned:
            root[a] = root[b] = min(root[a], root[b])
    assert root == components(values)


def test_documents(make_docs):
    base = prose(1, 400)
    rows = [(5, base), (3, base + " end"), (9, base), (4, prose(2, 300)), (8, None), (7, ""), (2, prose(6, 50))]
    got = {r.doc_id: r for r in simhash.near_duplicates(make_docs(rows)).collect()}
    fps = {i: by_definition(t) for i, t in rows}
    roots = components(set(fps.values()))
    for i, _ in rows:
        assert got[i].fp % 2**64 == fps[i]
        assert got[i].component_id == min(j for j, _ in rows if roots[fps[j]] == roots[fps[i]])
    assert got[8].component_id == got[7].component_id == 7


def test_odd_rows(odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.component_id for r in rows if r.doc_id in (1, 5)} == {1}
    assert {r.component_id for r in rows if r.fp == 0} == {2}  # null, empty and blank, with and without an id
    assert simhash.near_duplicates(odd_docs.limit(0)).collect() == []


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(1).withColumnRenamed("id", "fp"), distance=5)
