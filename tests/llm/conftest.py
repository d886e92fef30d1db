from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use themselves, to be ignored or passed on.
CLASHING = {"fp": "1", "h": "'x'", "rank": "2.5", "score": "'y'", "spans": "3", "component_id": "4", "kept": "'z'", "length": "5", "ids": "6"}
_WORDS = "ble ing the of and tion er ha es on at re ou nd an st".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(_WORDS) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with extra columns whose names operators use."""

    def make(rows, clash=True):
        docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
        return docs.selectExpr("*", *(f"{v} AS `{k}`" for k, v in CLASHING.items())) if clash else docs

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and blank texts, repeated rows, one long text, ties."""
    rows = [
        (1, prose(1, 120)), (1, prose(1, 120)), (2, None), (3, ""), (4, "  \t\n "), (5, prose(1, 120)), (None, prose(5, 80)),
        (None, None), (7, "é" * 700), (8, "x " * 9000), (9, prose(9, 20_000)), (10, prose(10, 3) + " 🙂 ✓ à́"), (11, "1 2 3"),
    ]
    return make_docs(rows)
