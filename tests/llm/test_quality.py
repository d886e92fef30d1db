from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from riskmart.llm import quality

from .conftest import prose

BLANK = "\x20\x09-\x0D"


def by_definition(text):
    words = re.findall(f"[^{BLANK}]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(f"[^{BLANK}]", line)]
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed


def measured(docs):
    rows = quality.text_statistics(docs).withColumn("failed", quality.base_failed()).collect()
    return [(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.failed)) for r in rows]


def test_counts(make_docs):
    rng = random.Random(7)
    parts = ["a", "b", "c", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "#", "é", "🙂", "\x1c", " ", "a b c\n", "|"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(200)))) for i in range(300)]
    rows += [(1000, "a b c " * 60), (1001, prose(1, 3000)), (1002, "x y z\n" * 40), (1003, "a a a a")]
    assert sorted(measured(make_docs(rows))) == [(i, by_definition(t)) for i, t in rows]


def test_odd_rows(odd_docs):
    expected = [(r.doc_id, by_definition(r.text)) for r in odd_docs.collect()]
    assert sorted(measured(odd_docs), key=str) == sorted(expected, key=str)


def bad_text(seed):
    return " ".join(w + "###" for w in prose(seed, 100).split())


@pytest.fixture(scope="module")
def corpus(make_docs, spark):
    rows = [(i, bad_text(i) if i % 4 == 0 else prose(i, 60 + i % 90)) for i in range(400)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(0, 400) if i % 3] + [(None, 0, 0), (1, None, 0), (9999, 0, 0), (2, 1, 0), (2, 1, 0)]
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS words", "1 AS bad")


def test_learnt_rules(corpus):
    docs, labels = corpus
    rows = quality.judge(docs, labels).collect()
    assert len(rows) == 400 and all(r.kept == (r.doc_id % 4 != 0) for r in rows)
    assert all(re.fullmatch(r"\w+ (>=|<) [\d.]+( and \w+ (>=|<) [\d.]+)*", r.rule) for r in rows if r.rule)
    assert [r.rule for r in quality.judge(docs, labels).orderBy("doc_id").collect()] == [r.rule for r in sorted(rows, key=lambda r: r.doc_id)]


def test_two_kinds_of_bad_text_take_two_rules(make_docs, spark):
    def text(i):
        return bad_text(i) if i % 5 == 0 else prose(i, 80).upper() if i % 5 == 1 else prose(i, 80)

    docs = make_docs([(i, text(i)) for i in range(500)])
    labels = spark.createDataFrame([(i, int(i % 5 > 1)) for i in range(500)], "doc_id long, quality int")
    rows = quality.judge(docs, labels).collect()
    assert all(r.kept == (r.doc_id % 5 > 1) for r in rows) and len({r.rule for r in rows} - {None}) >= 2


def test_order_of_conditions():
    first = (quality.Condition("words", True, 10.0),)
    second = (quality.Condition("words", False, 20.0), quality.Condition("mean_word", True, 3.0))
    text = str(quality.verdict([first, second]))
    assert text.index("words >= 10") < text.index("words < 20 and mean_word >= 3")


def test_without_usable_labels(corpus, spark, odd_docs):
    docs, _ = corpus
    empty = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.judge(docs, empty).collect()
    assert all(r.rule is None and r.kept == (not r.base_failed) for r in rows)
    assert quality.judge(odd_docs.limit(0), empty).collect() == []
    one_sided = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    assert all(r.rule is None for r in quality.judge(docs, one_sided).collect())


def test_no_python_in_the_plan(corpus):
    plan = quality.text_statistics(corpus[0])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
