"""A training corpus from raw documents: five stages, each a table that the next one reads.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All stages but the
last return the columns of their input; the last one returns where every piece lies in the packed sequences. Rows may
repeat, ids and texts may be null, and an empty table passes through as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmart.llm import languages, packing, privacy, repeats, simhash
from riskmart.session import materialise

# Share of a text's n-grams the language model must have a weight for. Held-out texts of learnt languages lie above 0.8, mixed
# ones too; texts of other scripts and letter salad lie below 0.45. It does not depend on the number of languages.
LEAST_KNOWN = 0.6
# The third stage looks for repeated passages of over 50 words: runs of at least 51 times four letters and a blank that hold as
# many words. Of op5's 400 bytes passages of 51 to 59 words, such as those of ``benchmark``, fall short.
PASSAGE_WORDS = 51
KEY = "a key of the job"  # surrogates depend on it; a real job passes its own secret


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those learnt; the rest (no letter, no text, or mostly unknown n-grams) goes."""
    named = languages.identify(docs, languages.fit_model(docs))
    return named.filter((F.col("lang_pred") != languages.UNKNOWN) & (F.col("known") >= LEAST_KNOWN)).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Near duplicates are linked by op9's operator with its shingle length and bit distance. Of rows that share this id one stays. Rows without an id go if their group has one with an id; of other groups of such
    rows one stays.
    """
    found = materialise(simhash.near_duplicates(docs), "pipeline-components")
    first = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct().join(first, "doc_id", "left_anti")
    stay = docs.join(materialise(gone, "pipeline-gone"), "doc_id", "left_anti").select(*docs.columns)
    repeated = materialise(first.filter("n > 1").select("doc_id"), "pipeline-repeated")
    if not repeated.isEmpty():
        one = stay.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
        stay = stay.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
    if not found.filter("doc_id IS NULL").isEmpty():
        rows = simhash.fingerprints(docs.filter("doc_id IS NULL").withColumn("row", F.struct(*docs.columns)), "row")
        groups = found.filter("doc_id IS NULL AND component_id IS NULL").select("fp", "root").distinct()
        one = rows.join(groups, "fp").dropDuplicates(["root"]).select("doc_id.*")
        stay = stay.filter("doc_id IS NOT NULL").unionByName(one)
    return stay


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words, or of 400 bytes, that stand anywhere else too; every document stays, if need be
    with an empty text.

    A cut may fall inside a character; the bytes that are left of it go too.
    """
    found = repeats.remove_repeats(docs, length=5 * PASSAGE_WORDS, as_text=True, least_words=PASSAGE_WORDS)
    changed = F.size("removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by surrogates."""
    out = privacy.replace_entities(docs, KEY)
    if "n_chars" in docs.columns:
        touched = sum(F.col(f"n_{kind}") for kind in privacy.KINDS) > 0
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(touched, length).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("pii", pii),
    ("packing", pack),
]
ORACLE_SQL = None  # language model, fingerprints and tokenizer have no SQL twin; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
