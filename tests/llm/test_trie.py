from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from riskmart.llm import trie

KIND = "conv_id long, turn long, role string, text string, n_convs int"
BLANKS = "\t\n\x0b\x0c\r"


def by_definition(rows):
    turns = {}
    for c, turn, role, text, _ in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    convs = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = own.get(c - c % 20, [])[:h] + mine[h:]
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        words = lambda q: len([w for w in q[-1][1].translate(dict.fromkeys(map(ord, BLANKS), " ")).split(" ") if w]) if q else 0
        ends = sorted(c for c in members if len(convs[c]) == len(p))
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), sum(q[:-1] == p for q in nodes if q),
            sum(not any(r and r[:-1] == q for r in nodes) for q in below), sum((len(nodes[q]) - 1) * words(q) for q in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations(seed, convs=60, letters=3, most=6):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(90), convs):
        for turn in range(rng.randrange(1, most)):
            text = " ".join(rng.choices("ab"[:letters], k=rng.randrange(1, 3)))
            rows.append((c, turn, rng.choice(["user", None]) if turn % 2 else "user", rng.choice([text, text, None, ""]), 7))
    rows += [(c, rng.choice([None, 1]), "user", "a\x0bb", 7) for c in rng.sample(range(90), 10)] + [rows[0], rows[0], (None, 1, "user", "a", 7), (5, None, None, None, 7)]
    return rows


def result(spark, rows, **options):
    found = trie.prefix_trie(spark.createDataFrame(rows, KIND), **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed, letters", [(1, 1), (2, 2)])
def test_nodes(spark, seed, letters):
    rows = conversations(seed, letters=letters)
    assert result(spark, rows) == by_definition(rows)


def test_large_subtrees_and_long_conversations_in_parts(spark, monkeypatch):
    rows = conversations(3, letters=1, most=12) + [(200, t // 2, "user", "a", 0) for t in range(40)] + [(201, t, "user", "a", 0) for t in range(30)]
    monkeypatch.setattr(trie, "BAND", 4)
    monkeypatch.setattr(trie, "FINISH", 3)
    assert result(spark, rows, shard_nodes=5, queue=1) == by_definition(rows)


def test_empty_table(spark):
    assert result(spark, []) == []
    assert result(spark, [(None, 1, "user", "a", 0)]) == []


def test_turnless_conversations(spark):
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)  # loses its only turn, its group has no first one
    rows = [(lone, 0, "user", "a b", 0)]
    assert result(spark, rows) == by_definition(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_ids_of_one_end_in_many_pieces(spark, monkeypatch):
    rows = [(20 * c, 0, "user", "a", 0) for c in range(1, 400)]
    monkeypatch.setattr(trie, "PIECE", 50)
    assert result(spark, rows) == by_definition(rows)


def test_queue_spills_in_order():
    rng = random.Random(4)
    entries = [(-rng.randrange(9), rng.randrange(5), 1, rng.randrange(10)) for _ in range(500)]
    queue = trie.SpillingQueue(limit=7)
    for entry in entries:
        queue.push(*entry)
    assert len(queue.runs) > 10
    for depth in range(-9, 1):
        for conv in range(5):
            own = [e for e in entries if e[:2] == (depth, conv)]
            assert queue.take(depth, conv) == (len(own), sum(e[3] for e in own))
