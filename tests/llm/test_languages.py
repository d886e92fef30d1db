from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from riskmart.llm import languages

DOCS = "doc_id long, text string, lang string, source string, lang_pred string, score int"
ALPHABETS = {"aa": "the of and ing tion er that".split(), "bb": "der und ung ein sch heit nicht".split(), "cc": "des le que pour ment eaux è".split()}


def text_of(lang, seed, words=30):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(ALPHABETS[lang], k=rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, text_of(lang, i), lang, "s", "old", 1) for i, lang in enumerate(["aa", "bb", "cc", "aa"] * 100)]
    rows += [(1000, None, "aa", None, None, None), (1001, "", "bb", None, None, None), (1002, "12 34 -- ²½", "cc", "s", "x", 1),
             (1003, text_of("bb", 9000, 6000), None, "s", "x", 1), (None, text_of("cc", 9001), "cc", "s", "x", 1), (5, text_of("bb", 5), "bb", "s", "x", 1)]
    return spark.createDataFrame(rows, DOCS).cache()


@pytest.fixture(scope="module")
def model(labelled):
    return languages.fit_model(labelled, rows_per_class=60)


def test_held_out_accuracy(labelled, model):
    rows = [r for r in languages.identify(labelled, model).collect() if r.doc_id is not None and r.doc_id < 400]
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 50 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(labelled, model):
    found = languages.identify(labelled, model)
    assert found.columns == ["doc_id", "text", "lang", "source", "lang_pred", "score", "known"] and found.count() == labelled.count()
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert {by_id[i] for i in (1000, 1001, 1002)} == {("und", 0.0)}
    assert by_id[1003][0] == "bb" and by_id[None][0] == "cc"
    assert languages.identify(labelled.limit(0), model).collect() == []


def test_only_allowed_rows_teach(labelled, spark):
    """Labels of held-out rows, and of rows without an id, change nothing."""
    remainder = "crc32(cast(cast(doc_id AS string) AS binary)) % 4"
    other = labelled.selectExpr("doc_id", "text", f"CASE WHEN doc_id IS NULL OR {remainder} = 2 THEN 'zz' ELSE lang END AS lang")
    a, b = languages.fit_model(labelled, rows_per_class=20), languages.fit_model(other, rows_per_class=20)
    assert a.classes == b.classes == ["aa", "bb", "cc"] and a.temperature == b.temperature
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.idf, b.idf)


def test_without_labels(labelled):
    empty = languages.fit_model(labelled.selectExpr("doc_id", "text", "cast(null AS string) AS lang"))
    assert {(r.lang_pred, r.score) for r in languages.identify(labelled, empty).collect()} == {("und", 0.0)}


def test_one_language(labelled):
    one = languages.fit_model(labelled.filter("lang = 'aa'"), rows_per_class=20)
    assert languages.predict(one, "abc")[:2] == ("aa", 1.0)


def test_counts_in_chunks(monkeypatch):
    text = text_of("cc", 1, 200) + " 🙂 日本"
    whole = languages.counts(text)
    monkeypatch.setattr(languages, "CHUNK", 13)
    assert np.array_equal(languages.counts(text), whole)
    assert whole.sum() == sum(len(text) - n + 1 for n in languages.ORDERS)


def test_document_frequencies_cover_all_rows(labelled, model):
    rows = [r for r in labelled.collect() if r.lang and r.text and languages.has_letter(r.text) and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    df = sum((languages.counts(r.text) > 0).astype(int) for r in rows)
    assert np.allclose(model.idf, np.log((1 + len(rows)) / (1 + df)) + 1)


def test_penalty_makes_weights_sparse():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(200, 20, replace=False)), np.full(20, 20**-0.5)) for _ in range(100)]
    labels = np.array([int(50 in at) for at, _ in rows])
    few, many = (np.count_nonzero(languages.fit_ftrl(rows, labels, 2, l1=l1)) for l1 in (0.5, 0.0))
    assert few < many


def test_temperature_minimises_the_loss():
    rng = np.random.default_rng(2)
    logits = rng.normal(size=(500, 3)) * 4
    labels = np.array([rng.choice(3, p=languages._softmax(row / 2.5)) for row in logits])
    assert abs(languages.fit_temperature(logits, labels) - 2.5) < 0.6
    assert languages.fit_temperature(np.empty((0, 3)), np.empty(0, int)) == 1.0
