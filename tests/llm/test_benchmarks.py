from __future__ import annotations

import random
import re

import pytest

from riskmart.llm import benchmarks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
KIND = "doc_id long, text string, items string"
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_definition(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        other = words(other)
        for at in range(max(1, len(other) - window + 1)) if other else []:
            piece = other[at : at + window]
            for start in range(len(own) - len(piece) + 1):
                if own[start : start + len(piece)] == piece:
                    hit.update(range(start, start + len(piece)))
                    found |= {item} - {None}
    return len(own), len(hit), sorted(str(i) for i in found)


def corpus(seed, letters="abcé", size=60):
    rng = random.Random(seed)

    def text(n):
        return "".join(rng.choice([w, w.upper(), w + rng.choice(["", ".", "\n", "1"])]) + rng.choice([" ", "  ", ", "]) for w in rng.choices(letters, k=n))

    items = [(i, text(rng.randrange(25))) for i in range(12)] + [(3, text(14)), (None, text(12)), (20, None), (21, ""), (22, "..."), (4, "a")][: seed % 7]
    docs = [(i, text(rng.randrange(size)), "x") for i in range(30)] + [(31, None, "x"), (32, "", "x"), (None, text(30), "x"), (5, "a b", "y"), (5, "a b", "y")]
    docs += [(40 + i, f"{text(4)} {item[1] or ''} {text(5)}", "z") for i, item in enumerate(items)]
    return docs, items


@pytest.mark.parametrize("seed", range(8))
def test_automaton_finds_what_the_definition_does(seed):
    docs, items = corpus(seed, "ab" if seed % 2 else "abcdé")
    automaton = benchmarks.build_automaton([(i, benchmarks.words_of((t or "").encode())) for i, t in items])
    for _, text, _ in docs:
        count, runs, found = benchmarks.match(automaton, (text or "").encode().translate(benchmarks._FOLD))
        named = sorted(str(automaton.ids[i]) for i in found if automaton.ids[i] is not None)
        assert (count, sum(e - f for f, e, _ in runs), named) == by_definition(text, items)


def test_chunks_do_not_cut_matches(monkeypatch):
    docs, items = corpus(5)
    automaton = benchmarks.build_automaton([(i, benchmarks.words_of((t or "").encode())) for i, t in items])
    data = [(t or "").encode().translate(benchmarks._FOLD) for _, t, _ in docs]
    whole = [benchmarks.match(automaton, d) for d in data]
    monkeypatch.setattr(benchmarks, "CHUNK", 3)
    assert [benchmarks.match(automaton, d) for d in data] == whole


@pytest.mark.parametrize("shard_words", [100_000, 60])  # with 60, items need several automata
def test_documents(spark, shard_words):
    docs, items = corpus(6)
    found = benchmarks.decontaminate(spark.createDataFrame(docs, KIND), spark.createDataFrame(items, ITEMS), shard_words=shard_words).collect()
    rows = sorted((str(r.doc_id), r.text or "", r.n_words, r.n_hit, list(r["items"])) for r in found)
    assert rows == sorted((str(i), t or "", n, h, named) for i, t, _ in docs for n, h, named in [by_definition(t, items)])
    assert found[0].__fields__[:2] == ["doc_id", "text"]  # the input's own column "items" gave way
    for row in found:
        data = (row.text or "").encode()
        cut = [words(data[s.start : s.end].decode()) for s in row.spans]
        assert [len(c) for c in cut] == [s.words for s in row.spans]
        assert words(row.kept) == [w for i, w in enumerate(words(row.text)) if not any(s.first_word <= i < s.first_word + s.words for s in row.spans)]
        assert row.dropped == (row.n_hit > 0.5 * row.n_words)


def test_limits(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{item} x", ""), (2, "short one here", "")], KIND)
    items = spark.createDataFrame([(1, item), (2, "short one")], ITEMS)
    found = {r.doc_id: r for r in benchmarks.decontaminate(docs, items, min_words=5, max_coverage=0.7).collect()}
    assert (found[1].kept.strip(), found[1].dropped, found[1].spans[0].longest) == ("x", True, 12)
    assert (found[2].kept, found[2].dropped, found[2].n_hit) == ("short one here", False, 2)


def test_empty_tables(spark):
    docs, items = corpus(2)
    none = spark.createDataFrame([], ITEMS)
    assert {r.n_hit for r in benchmarks.decontaminate(spark.createDataFrame(docs, KIND), none).collect()} == {0}
    assert benchmarks.decontaminate(spark.createDataFrame([], KIND), spark.createDataFrame(items, ITEMS)).collect() == []


def test_long_items_are_cut_into_overlapping_pieces(spark, monkeypatch):
    rows = next(benchmarks._pieces(10)([__import__("pyarrow").RecordBatch.from_pydict({"item": [1], "text": [" ".join(f"w{i}" for i in range(45_000))]})]))
    pieces = [p.split() for p in rows.column(1).to_pylist()]
    assert len(pieces) == 3 and pieces[0][-9:] == pieces[1][:9] and pieces[-1][-1] == b"w44999"
