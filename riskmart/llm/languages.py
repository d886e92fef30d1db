"""Language identification: sparse multinomial logistic regression on TF-IDF weighted character n-grams.

Document frequencies are counted over all training rows. The weights are fitted on a bounded sample of labelled rows by
follow-the-regularised-leader with elastic-net penalties, and a held-back part of the sample sets the temperature that
calibrates the scores. The model has a fixed size (classes x buckets) and goes to every task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

ORDERS = (1, 2, 3)
BITS = 15
ROWS_PER_CLASS = 1500  # the documented size of the fitting sample: about this many rows of each language
EPOCHS = 4
CHUNK = 1 << 20
UNKNOWN = "und"
ADDED = ["lang_pred", "score", "known"]
COMMON_IDF = 1 + np.log(200)  # of n-grams that one in 200 training rows holds
SLICE = 256  # rows that are handled together


@dataclass(frozen=True, eq=False)
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray  # classes x (buckets + 1); the last column is the bias
    temperature: float


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(1 << 16)] + [True])  # astral planes count as letters


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """How often each hashed n-gram of letters (anything else is one blank) occurs in the whole text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    total = np.zeros(1 << BITS, np.int64)
    for at in range(0, max(len(codes), 1), CHUNK):
        part = codes[at : at + CHUNK + max(ORDERS) - 1]  # n-grams that start in this chunk
        letter = _letters()[np.minimum(part, 1 << 16)]
        part = np.where(letter, part, 32).astype(np.uint64)
        hashed = np.zeros(len(part), np.uint64)
        for order in range(1, max(ORDERS) + 1):
            size = len(part) - order + 1
            if size <= 0:
                break
            hashed = (hashed[:size] * np.uint64(0x100000001B3)) ^ part[order - 1 :]
            if order in ORDERS:
                own = (hashed + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
                total += np.bincount(own[:CHUNK].astype(np.int64), minlength=1 << BITS)
    return total


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and unit-length weights (1 + log tf) * idf of a text."""
    total = counts(text)
    at = np.flatnonzero(total)
    values = (1 + np.log(total[at])) * idf[at]
    norm = np.sqrt(values @ values)
    return at, values / norm if norm else values


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int,
    alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights after some passes of FTRL-proximal over unit-length rows; L1 keeps rare n-grams at exactly zero."""
    z = np.zeros((classes, (1 << BITS) + 1))
    n = np.zeros_like(z)

    def weights(at):
        own = z[:, at]
        step = (beta + np.sqrt(n[:, at])) / alpha + l2
        return np.where(np.abs(own) > l1, -(own - np.sign(own) * l1) / step, 0.0)

    everything = [(np.r_[at, 1 << BITS], np.r_[values, 1.0]) for at, values in rows]
    for epoch in range(epochs):
        for number in np.random.default_rng(epoch).permutation(len(rows)):
            at, values = everything[number]
            w = weights(at)
            error = _softmax(w @ values)
            error[labels[number]] -= 1
            gradient = error[:, None] * values
            squares = n[:, at]
            sigma = (np.sqrt(squares + gradient**2) - np.sqrt(squares)) / alpha
            z[:, at] += gradient - sigma * w
            n[:, at] = squares + gradient**2
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature between 1/20 and 20 of least negative log-likelihood on rows the weights have not seen."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-300)).mean()

    low, high = -np.log(20), np.log(20)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros((1 << BITS) + 1, np.int64)  # the last one counts documents
    for batch in batches:
        for text in batch.column(0):
            found[:-1] += counts(text.as_py()) > 0
            found[-1] += 1
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["bucket", "df"])


def _sparse(idf: np.ndarray):
    """Features of every sampled row, computed where the row is read: only the sparse values travel to the fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = [features(text.as_py(), idf) for text in batch.column(1)]
                tie = [zlib.crc32(text.as_py().encode("utf-8", "surrogatepass")) for text in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(tie, pa.int64()),
                     pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                     pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))],
                    ["place", "lang", "tie", "at", "weights"],
                )

    return run


def _fit(classes: list[str]):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys = [], []
        for batch in batches:
            place, lang, tie = (batch.column(n).to_pylist() for n in range(3))
            keys += [(p, l, t) for p, l, t in zip(place, lang, tie)]
            rows += [
                tuple(batch.column(n)[row].values.to_numpy(zero_copy_only=False).astype(kind) for n, kind in ((3, np.int64), (4, np.float64)))
                for row in range(batch.num_rows)
            ]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        rows = [rows[i] for i in order]
        labels = np.array([classes.index(keys[i][1]) for i in order], np.int64)
        held = np.arange(len(rows)) % 5 == 0
        weights = fit_ftrl([r for r, h in zip(rows, held) if not h], labels[~held], len(classes))
        logits = np.array([weights[:, at] @ values + weights[:, -1] for (at, values), h in zip(rows, held) if h])
        temperature = fit_temperature(logits.reshape(-1, len(classes)), labels[held])
        label, bucket = np.nonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, label]), pa.array(np.r_[0, bucket]), pa.array(np.r_[temperature, weights[label, bucket]])],
            ["label", "bucket", "weight"],
        )

    return fit


def learnt_from(id_column: str) -> Column:
    """Rows that may be learnt from: crc32 of the id as text, modulo 4, is not 2. A null id is not learnt from."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 != 2


def fit_model(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    rows_per_class: int = ROWS_PER_CLASS,
) -> Model:
    """Fit on rows with a language and a text that holds a letter, apart from the held-out ones.

    Document frequencies cover all such rows. The fitting sample holds about ``rows_per_class`` rows of each language, those
    with the smallest hashes of the id, and never more than twice as many in all: a bound on the fit alone. Without any
    such row the model has no classes.
    """
    train = docs.filter(learnt_from(id_column)).select(
        F.xxhash64(F.col(id_column)).alias("place"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")
    ).filter("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    frequencies = train.select("text").mapInArrow(_document_frequencies, "bucket bigint, df bigint")
    df = np.zeros((1 << BITS) + 1)
    for row in frequencies.groupBy("bucket").agg(F.sum("df").alias("df")).collect():  # one row per bucket
        df[row.bucket] = row.df
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    sizes = {row.lang: row["count"] for row in train.groupBy("lang").count().collect()}
    classes = sorted(sizes)
    if not classes:
        return Model([], idf, np.zeros((0, (1 << BITS) + 1)), 1.0)
    # Hashes are uniform, so this share of their range holds about ``rows_per_class`` rows; repeated ids share a hash.
    share = {lang: min(1.0, rows_per_class / n) for lang, n in sizes.items()}
    last = {lang: min(int(-(2**63) + part * 2**64), 2**63 - 1) for lang, part in share.items()}
    chosen = reduce(Column.__or__, [(F.col("lang") == lang) & (F.col("place") <= last[lang]) for lang in classes])
    sparse = train.filter(chosen).select("place", "text", "lang").mapInArrow(
        _sparse(idf), "place bigint, lang string, tie bigint, at array<int>, weights array<float>"
    )
    sample = sparse.orderBy("place", "lang", "tie").limit(2 * rows_per_class * len(classes))
    fitted = sample.repartition(1).mapInArrow(_fit(classes), "label bigint, bucket bigint, weight double").collect()
    weights, temperature = np.zeros((len(classes), (1 << BITS) + 1)), 1.0
    for row in fitted:  # at most classes x buckets
        if row.label < 0:
            temperature = row.weight
        else:
            weights[row.label, row.bucket] = row.weight
    return Model(classes, idf, weights, temperature)


@lru_cache(maxsize=1)
def familiar_buckets(model: Model) -> np.ndarray:
    """N-gram buckets the model has a weight for, or that are common among the training rows."""
    return (model.weights[:, :-1] != 0).any(axis=0) | (model.idf <= min(COMMON_IDF, model.idf.max() - 1e-9))


def predict(model: Model, text: str | None) -> tuple[str, float, float]:
    """(language, score, known): known is the share of the text's n-grams, as features, that are weighed or common."""
    if not text or not model.classes or not has_letter(text):
        return UNKNOWN, 0.0, 0.0
    at, values = features(text, model.idf)
    own = model.weights[:, at]
    p = _softmax((own @ values + model.weights[:, -1]) / model.temperature)
    best, total = int(p.argmax()), float(values.sum())
    return model.classes[best], float(p[best]), float(values[familiar_buckets(model)[at]].sum()) / total if total else 0.0


def identify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """All rows and columns with ``lang_pred``, ``score`` (the calibrated probability) and ``known`` appended.

    ``known`` is the share of the text's n-grams that the model has a weight for or that many training rows hold: it tells a learnt language from any other text,
    which a probability over the learnt languages cannot. ``und`` with score and known 0 where the text is null or has no
    letter, and everywhere if the model knows no language. Columns that had these names are replaced. Nothing but the text
    is an input.
    """
    kept = docs.drop(*ADDED)
    place = kept.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = [predict(model, text.as_py()) for text in batch.column(place)]
                extra = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, *ADDED])

    added = [T.StructField(n, k) for n, k in zip(ADDED, (T.StringType(), T.DoubleType(), T.DoubleType()))]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))
