from __future__ import annotations

import numpy as np
import pytest
import zlib
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskmart.llm import packing, privacy, queries

from .conftest import prose
from .test_languages import text_of
from .test_packing import check_packed, ids_of
from .test_repeats import removed_by_counting
from .test_simhash import by_definition, components


def rows():
    out = [(i, text_of(lang, i, 60), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 12)]
    passage = text_of("aa", 777, 80)
    out += [(100 + i, text_of("aa", 800 + i, 40) + " " + passage + " é " + text_of("aa", 900 + i, 40), "aa") for i in range(4)]
    out += [(50, out[0][1], "aa"), (51, out[0][1] + " of", "aa"), (0, out[0][1], "aa"), (60, "12 34", "aa"), (61, None, "bb"), (62, "", None)]
    out += [(70, text_of("bb", 70, 60) + " und.34@mail7.example.com 9807915762804490", "bb"), (None, out[0][1], "aa"), (None, text_of("cc", 71, 70), "cc")]
    out += [(80, "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί", None), (81, text_of("aa", 81, 50) + " " + text_of("bb", 82, 50), None)]
    return out + [(None, text_of("cc", 71, 70), "cc")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    docs.limit(0).write.parquet(f"{path}/empty/documents.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), stage(spark, docs, folder).schema)
        found[name] = docs.collect()
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(list(found[n][0].asDict()) == columns for n, _ in corpus_pipeline.STAGES[:-1])

    texts = [(i, t) for i, t, _ in rows()]
    recognised = sorted(((i, t) for i, t in texts if i not in (60, 61, 62, 80)), key=str)
    assert sorted(((r.doc_id, r.text) for r in found["language_id"]), key=str) == recognised

    fps = {t: by_definition(t) for _, t in recognised}
    root = components(set(fps.values()))
    groups = {}
    for i, t in recognised:
        groups.setdefault(root[fps[t]], []).append((i is None, i or 0, t))
    kept = sorted(((None if unnamed else i, t) for unnamed, i, t in map(min, groups.values())), key=str)
    assert sorted(((r.doc_id, r.text) for r in found["simhash_near_dedup"]), key=str) == kept

    removed = removed_by_counting([t for _, t in kept], 400)
    rest = sorted(((i, x[2].decode("utf-8", "ignore")) for (i, _), x in zip(kept, removed)), key=str)
    assert sorted(((r.doc_id, r.text) for r in found["suffix_array_dedup"]), key=str) == rest
    assert any(x[1] for x in removed)

    clean = {r.doc_id: r.text for r in found["pii"]}
    assert all(clean[i] == t for i, t in rest if i != 70)
    assert "und.34" not in clean[70] and "9807915762804490" not in clean[70] and clean[70].startswith(text_of("bb", 70, 60))
    assert all(r.n_chars == len(r.text) for r in found["pii"])

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    check_packed(found["packing"], 2048)
    expected = sorted((str(r.doc_id), zlib.crc32(np.array(ids_of(tokenizer, r.text), "<u4").tobytes())) for r in found["pii"])
    assert sorted((str(r.doc_id), r.ids_crc32) for r in found["packing"]) == expected


def test_shared_passages_of_over_50_words_go(spark, make_docs):
    passage = " ".join(f"{a}{b}word" for a in "klmnopqr" for b in "stuvwxyz")[: 52 * 7 - 1]  # 52 words
    assert len(passage.encode()) < 400
    rows = [(i, text_of("aa", 500 + i, 60) + " " + passage + " " + text_of("bb", 600 + i, 60)) for i in range(3)] + [(9, text_of("aa", 700, 90))]
    found = {r.doc_id: r.text for r in corpus_pipeline.suffix_array_dedup(spark, make_docs(rows, clash=False), "").collect()}
    expected = removed_by_counting([t for _, t in rows], 255)
    assert found == {i: x[2].decode("utf-8", "ignore") for (i, _), x in zip(rows, expected)} and found[9] == rows[3][1]
    assert all(passage not in found[i] and len(found[i]) > 500 for i in range(3))


def test_run_and_query(spark, folder):
    direct = corpus_pipeline.run(spark, folder)
    assert queries.QUERIES["pipeline"](spark, folder).count() == direct.count() > 30
    assert direct.select(F.sum("length")).first()[0] == direct.filter("start = 0").select(F.sum("doc_tokens")).first()[0]


def test_empty_table(spark, folder):
    assert corpus_pipeline.run(spark, f"{folder}/empty").collect() == []


def test_every_query_is_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "pii", "pack"]
    assert privacy.KINDS and prose(1, 1)
