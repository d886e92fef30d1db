"""Registered queries of this subpackage; each runs one operator over its whole table."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import archives, benchmarks, collocations, embeddings, languages, packing, pieces, privacy, quality, repeats, secrets, simhash, trie

KEY = "a key of the job"  # surrogates depend on it; a real job passes its own secret
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_cover_tree_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"))


CHECKS["op1_cover_tree_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), g AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), r(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM r JOIN l ON r.other = l.a
), c AS (SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n ON c.vec_id = n.a
"""


@_query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per base kind, a digest of the base spans and all spans of every document."""
    found = secrets.scan_secrets(_table(spark, folder, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE_KINDS]
    base = of(*secrets.BASE_KINDS)
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def _rule_sql(order: int, rule: secrets.Rule) -> str:
    """Matches of one rule with the texts before them; the length rule of a base kind is asked of group or match."""
    pattern = (("(?i)" if rule.flags & re.IGNORECASE else "") + rule.pattern).replace("'", "''")
    group = ", 2" if rule.kind == "assign" else ""
    least = {"assign": 8, "access": 16, "hex": 32}.get(rule.kind, 0)
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {order} AS ord, {least} AS least, regexp_extract_all(t, '{pattern}') AS m,
  regexp_extract_all(t, '{pattern}'{group}) AS g, regexp_split_to_array(t, '{pattern}') AS p FROM d"""


CHECKS["op2_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS ({" UNION ALL ".join(_rule_sql(order, rule) for order, rule in enumerate(secrets.RULES))}),
u AS (SELECT doc_id, kind, ord, least, unnest(m) AS m, unnest(g) AS g, unnest(p[1:len(m)]) AS p, unnest(range(len(m))) AS i FROM r WHERE len(m) > 0),
e AS (SELECT *, CAST(sum(length(p) + length(m)) OVER (PARTITION BY doc_id, ord ORDER BY i) AS BIGINT) AS stop FROM u),
s AS (SELECT doc_id, kind, ord, stop - length(m) AS start, kind || ':' || (stop - length(m)) || ':' || stop AS span FROM e WHERE length(g) >= least),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(span, ',' ORDER BY start, ord) FILTER (ord < 3) AS base, string_agg(span, ',' ORDER BY start, ord) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""


@_query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Number and digest of the ids of every document, and whether decoding them gives the text back."""
    decoded = pieces.encode_and_decode(_table(spark, folder, "documents").select("doc_id", "text"))
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@_query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    return packing.pack_documents(_table(spark, folder, "documents"))


@_query
def op5_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that start anywhere else."""
    found = repeats.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.col("kept").cast("string").alias("text"),
    )


@_query
def op6_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal data replaced, and how many entities of each kind were."""
    return privacy.replace_entities(_table(spark, folder, "documents"), KEY).drop("lang", "source", "n_chars")


@_query
def op7_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to dictionary-compressed archives and read back; sizes and digests come from the payloads read."""
    pages = _table(spark, folder, "pages")
    place = archives.archive_folder(spark)
    records = archives.read_archives(spark, place, archives.write_archives(pages, place))
    kind = pages.schema["page_id"].dataType
    whole = F.col("payload").isNotNull()
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


CHECKS["op7_warc_archives"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
     d AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
     f AS (SELECT digest, min(page_id) AS first FROM d GROUP BY digest)
SELECT page_id, n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM d JOIN f ON d.digest = f.digest
"""


@_query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language and calibrated score of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = languages.identify(docs.select("doc_id", "text"), languages.fit_model(docs))
    held_out = F.coalesce(~languages.learnt_from("doc_id"), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@_query
def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@_query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document, by the base rule and a decision list learnt from the labels."""
    judged = quality.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@_query
def op11_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items, and the items."""
    found = benchmarks.decontaminate(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "dropped",
    )


_WORDS_SQL = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

CHECKS["op11_benchmark_decontamination"] = f"""
WITH i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, unnest([array_to_string(w[s:s + 9], ' ') FOR s IN range(1, greatest(len(w) - 9, 1) + 1)]) AS g, least(len(w), 10) AS m
      FROM i WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
m AS (SELECT DISTINCT m FROM p),
g AS (SELECT r, m, unnest([struct_pack(s := s, g := array_to_string(w[s:s + m - 1], ' ')) FOR s IN range(1, len(w) - m + 2)]) AS x FROM d, m WHERE len(w) >= m),
h AS (SELECT DISTINCT r, x.s AS s, g.m AS m, item_id FROM g JOIN p ON p.g = x.g AND p.m = g.m),
n AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS pos FROM (SELECT DISTINCT r, s, m FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY r),
spans AS (SELECT d.r, doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items
      FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN t ON t.r = d.r)
SELECT doc_id, n_words, n_hit, n_items, sha256(items) AS items_sha256, n_hit > 0 AS contaminated, n_hit > 0.5 * n_words AS dropped FROM spans
"""


@_query
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations with its subtree's totals."""
    return trie.prefix_trie(_table(spark, folder, "conversations"))


CHECKS["op12_conversation_trie"] = """
WITH RECURSIVE tab(i, v, k) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM tab WHERE k = 8),
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT c, c - c % 20 AS g, max(pos) AS n,
        xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
          lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1]))) % 4 AS h FROM t, crc GROUP BY c, crc.t),
k AS (SELECT c.c, c.h, least(c.h, coalesce(p.n, 0)) AS taken FROM c LEFT JOIN c p ON p.c = c.g),
r AS (SELECT k.c, t.pos AS d, role, text FROM k JOIN t ON t.c = k.c - k.c % 20 AND t.pos <= k.taken
      UNION ALL SELECT k.c, t.pos - k.h + k.taken, role, text FROM k JOIN t ON t.c = k.c AND t.pos > k.h),
x AS (SELECT c, 0 AS d, CAST([] AS STRUCT(role VARCHAR, text VARCHAR)[]) AS p, 0 AS words, (SELECT count(*) FROM r WHERE r.c = k.c) AS n FROM k
      UNION ALL SELECT c, d, list({'role': role, 'text': text}) OVER (PARTITION BY c ORDER BY d),
        len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), count(*) OVER (PARTITION BY c) FROM r),
n AS (SELECT d, p, min(c) AS c, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256 FROM x GROUP BY d, p),
e AS (SELECT n.*, u.c AS up FROM n LEFT JOIN n u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]),
m AS (SELECT up, d - 1 AS d, count(*) AS n_children FROM e WHERE d > 0 GROUP BY up, d),
f AS (SELECT e.*, coalesce(n_children, 0) AS n_children FROM e LEFT JOIN m ON m.up = e.c AND m.d = e.d),
s AS (SELECT x.d, x.p, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved
      FROM f JOIN x ON x.c = f.c AND x.d <= f.d GROUP BY x.d, x.p)
SELECT f.c AS conv_id, f.d AS depth, f.up AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, ends_sha256 FROM f JOIN s ON s.d = f.d AND s.p = f.p
"""


@_query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of every language with the counts of their parts."""
    return collocations.collocations(_table(spark, folder, "documents"))


CHECKS["op13_collocations"] = """
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS t FROM documents),
p AS (SELECT d, lang, unnest(t) AS t, generate_subscripts(t, 1) AS p FROM d),
q AS (SELECT d, lang, p, regexp_extract_all(t, '[^\\x20\\x09]+') AS w FROM p),
w AS (SELECT lang, w[i:least(i + 3, len(w))] AS w FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM q)),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, array_to_string(w[1:k], ' ') AS x, count(*) AS f FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
      GROUP BY lang, k, x HAVING count(*) >= 30),
s AS (SELECT lang, k AS m, x, f AS a, string_split(x, ' ') AS w FROM f WHERE k > 1),
u AS (SELECT *, unnest(range(1, m)) AS k FROM s),
c AS (SELECT u.lang, m, u.x, a, u.k, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
      FROM u JOIN f l ON l.lang = u.lang AND l.x = array_to_string(w[1:u.k], ' ') JOIN f r ON r.lang = u.lang AND r.x = array_to_string(w[u.k + 1:m], ' ')),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, k) = 1),
i AS (SELECT lang, a, m, w, unnest(range(1, m)) AS i FROM s WHERE m > 2),
j AS (SELECT lang, a, array_to_string(w[i:i + z - 1], ' ') AS x FROM i, (SELECT unnest([2, 3]) AS z) WHERE z < m AND i + z - 1 <= m),
o AS (SELECT lang, x, max(a) AS most FROM j GROUP BY lang, x),
g AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.x = b.x WHERE most IS NULL OR 100 * most < 80 * a),
h AS (SELECT g.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, x) AS rank FROM g)
SELECT h.lang, rank, x AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM h JOIN n ON n.lang = h.lang WHERE rank <= 2000
"""


@_query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline at the top of the repository, from raw documents to packed pieces."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
