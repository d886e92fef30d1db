"""Aggregates, windows, ranking and evaluation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..config import DEFAULT_SEED, DEFAULT_SPLITS
from ..functions import flag_at, null_markers
from ..operators import attribution, cleaning, evaluation as E, fairness, gates, ordering, profiling as P, ranking, worklist
from ..operators.splitting import modelling_rows
from ..plans.evaluation import heuristic
from ..session import materialise
from ..sources.csv import union_by_name
from .registry import query
from .sql import check, split_case
from .tables import clean, encounters, records, split_records, table


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, because summation order differs between engines."""
    return df.select(*[
        F.round(F.col(f.name), places).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


# --- aggregates ---------------------------------------------------------------------------------------------------

@query("a1_count_check", "SELECT 'orders' AS subject, CAST(count(*) AS DOUBLE) AS observed FROM orders UNION ALL SELECT 'lineitem', CAST(count(*) AS DOUBLE) FROM lineitem")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return union_by_name([
        table(spark, folder, t).agg(F.count(F.lit(1)).cast("double").alias("observed")).select(F.lit(t).alias("subject"), "observed")
        for t in ("orders", "lineitem")])


@query("a2_distinct_entities", "SELECT count(DISTINCT o_custkey) AS n_entities, count(DISTINCT o_orderpriority) AS n_priorities FROM orders")
def _(spark, folder):
    return table(spark, folder, "orders").agg(
        F.countDistinct("o_custkey").alias("n_entities"), F.countDistinct("o_orderpriority").alias("n_priorities"))


@query("a3_group_counts", check("SELECT readmitted, count(*) AS n FROM encounters GROUP BY readmitted"))
def _(spark, folder):
    return P.group_counts(encounters(spark, folder), "readmitted")


@query("a4_group_size_histogram", check("""
SELECT size, count(*) AS n_entities FROM (SELECT count(*) AS size FROM records GROUP BY entity) WHERE size <= 15 GROUP BY size"""))
def _(spark, folder):
    return P.group_size_histogram(records(spark, folder), "entity")


@query("a5_class_balance", check("""
SELECT 'overall' AS population, label, count(*) AS n FROM records GROUP BY label
UNION ALL SELECT 'kept', label, count(*) FROM records WHERE status <> 'P' GROUP BY label"""))
def _(spark, folder):
    df = records(spark, folder)
    return P.class_balance({"overall": df, "kept": df.where("status <> 'P'")}, "label")


@query("a6_repeated_entity_share", check("""
SELECT count(*) AS n_entities, count(*) FILTER (n > 1) AS n_repeated, CAST(sum(pos) AS BIGINT) AS positives,
       CAST(sum(pos) FILTER (n > 1) AS BIGINT) AS positives_of_repeated,
       round(CAST(count(*) FILTER (n > 1) AS DOUBLE) / count(*), 6) AS share_repeated,
       round(CAST(sum(pos) FILTER (n > 1) AS DOUBLE) / sum(pos), 6) AS share_of_positives
FROM (SELECT entity, count(*) AS n, sum(label) AS pos FROM records GROUP BY entity)"""))
def _(spark, folder):
    return rounded(P.repeated_entity_share(records(spark, folder), "entity", "label"))


_MISSING = ["race", "weight", "payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3", "max_glu_serum", "A1Cresult", "gender"]


@query("a7_missing_share", check(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN \"{c}\" = '?' THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_null FROM encounters"
        for c in _MISSING) + ") WHERE pct_null > 0"))
def _(spark, folder):
    return rounded(P.missing_share(null_markers(encounters(spark, folder)), _MISSING))


_GROUPS = ["race", "gender", "age", "diag_1_group", "discharge_disposition"]


@query("a8_rate_by_subgroup", check(
    "SELECT \"column\", value, round(avg(readmit_30), 6) AS rate, count(*) AS n FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, readmit_30 FROM clean" for c in _GROUPS)
    + ") WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 30"))
def _(spark, folder):
    return rounded(P.rate_by_groups(clean(spark, folder), S.TARGET, _GROUPS))


@query("a9_value_share", check("""
SELECT priority, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM records WHERE priority IS NOT NULL GROUP BY priority"""))
def _(spark, folder):
    return rounded(P.value_share(records(spark, folder), "priority"))


_CONSTANT = ["weight", "citoglipton", "examide", "gender", "insulin"]


@query("a10_constant_columns", check(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT nullif({c}, '?')) = 1 AS INT) AS is_constant FROM encounters" for c in _CONSTANT)))
def _(spark, folder):
    return P.constant_columns(null_markers(encounters(spark, folder)), _CONSTANT)


@query("a10_distinct_counts", check(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT nullif({c}, '?')) AS n_distinct FROM encounters" for c in _CONSTANT)))
def _(spark, folder):
    return P.distinct_counts(null_markers(encounters(spark, folder)), _CONSTANT)


_QUANTILES = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


@query("a11_exact_quantiles", " UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(l_extendedprice, {q}), 4) AS value FROM lineitem" for q in _QUANTILES))
def _(spark, folder):
    return rounded(P.exact_quantiles(table(spark, folder, "lineitem"), "l_extendedprice", _QUANTILES), 4)


@query("a11_quantiles_by_group", """
SELECT l_returnflag, CAST(0.9 AS DOUBLE) AS q, round(quantile_cont(l_quantity, 0.9), 6) AS value FROM lineitem GROUP BY l_returnflag""")
def _(spark, folder):
    return rounded(P.exact_quantiles(table(spark, folder, "lineitem"), "l_quantity", [0.9], ["l_returnflag"]))


@query("a12_clipped_histogram", """
WITH clipped AS (SELECT least(l_quantity, (SELECT quantile_cont(l_quantity, 0.99) FROM lineitem)) AS x FROM lineitem),
edges AS (SELECT min(x) AS lo, max(x) AS hi FROM clipped),
binned AS (SELECT CAST(least(floor((x - lo) * 30 / (hi - lo)), 29) AS INT) AS bin, count(*) AS n FROM clipped, edges GROUP BY 1)
SELECT CAST(range AS INT) AS bin, coalesce(n, 0) AS n FROM range(30) LEFT JOIN binned ON binned.bin = range.range""")
def _(spark, folder):
    return P.clipped_histogram(table(spark, folder, "lineitem"), "l_quantity")


@query("a13_rate_by_clipped_counter", check("""
SELECT least(counter, 5) AS bucket, round(avg(label), 6) AS rate, count(*) AS n FROM records GROUP BY 1"""))
def _(spark, folder):
    return rounded(P.rate_by_clipped_counter(records(spark, folder), "counter", "label"))


@query("a14_splits_per_entity", check("""
SELECT entity, count(DISTINCT split) AS n_splits FROM (SELECT entity, CASE WHEN id % 97 = 0 THEN 'test' ELSE split END AS split FROM split_records)
GROUP BY entity HAVING count(DISTINCT split) <> 1"""))
def _(spark, folder):
    tampered = F.when(F.col("id") % 97 == 0, "test").otherwise(F.col("split"))
    return gates.leaking_entities(split_records(spark, folder).withColumn("split", tampered), "entity")


_SPLIT_TARGETS = "(VALUES ('train', 0.4), ('validation', 0.1), ('test', 0.1), ('production', 0.4)) t(split, target)"


@query("a15_split_proportions", check(f"""
SELECT t.split, CAST(t.target AS DOUBLE) AS target, count(r.id) AS n, CAST(coalesce(sum(r.label), 0) AS BIGINT) AS positives,
       round(CAST(count(r.id) AS DOUBLE) / (SELECT count(*) FROM records), 6) AS share, round(avg(r.label), 6) AS prevalence
FROM {_SPLIT_TARGETS} LEFT JOIN split_records r ON r.split = t.split GROUP BY t.split, t.target"""))
def _(spark, folder):
    return rounded(gates.split_counts(split_records(spark, folder), "label", DEFAULT_SPLITS))


@query("a16_prevalence_range", check("""
SELECT round(max(p) - min(p), 6) AS spread FROM (SELECT avg(label) AS p FROM split_records GROUP BY split)"""))
def _(spark, folder):
    counts = gates.split_counts(split_records(spark, folder), "label", DEFAULT_SPLITS)
    return rounded(counts.agg((F.max("prevalence") - F.min("prevalence")).alias("spread")))


@query("a17_class_floor", check("""
SELECT 'positive' AS subject, CAST(sum(label) AS DOUBLE) AS observed, CAST(sum(label) >= 6000 AS INT) AS passed FROM records
UNION ALL SELECT 'negative', CAST(count(*) - sum(label) AS DOUBLE), CAST(count(*) - sum(label) >= 6000 AS INT) FROM records"""))
def _(spark, folder):
    return gates.class_floor_gate(records(spark, folder), "label", 6000).select(
        "subject", "observed", F.col("passed").cast("int").alias("passed"))


@query("a18_modelling_statistics", check("""
SELECT count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
       CAST(sum(label) < 10000 AS INT) AS below_floor FROM split_records WHERE split <> 'production'"""))
def _(spark, folder):
    return gates.modelling_statistics(split_records(spark, folder), "label")


@query("a20_mean_absolute_values", """
SELECT 'l_quantity' AS feature, round(avg(abs(l_quantity - 25)), 6) AS mean_abs FROM lineitem
UNION ALL SELECT 'l_discount', round(avg(abs(l_discount - 25)), 6) FROM lineitem UNION ALL SELECT 'l_tax', round(avg(abs(l_tax - 25)), 6) FROM lineitem""")
def _(spark, folder):
    names = ["l_quantity", "l_discount", "l_tax"]
    shifted = table(spark, folder, "lineitem").select(*[(F.col(c) - 25).alias(c) for c in names])
    return rounded(attribution.attribution_ranking(shifted, names))


@query("a21_rates", check("""
SELECT split, round(avg(label), 6) AS base_rate, round(avg(CAST(score >= CAST(0.5 AS DOUBLE) AS INT)), 6) AS selection_rate,
       round(avg(CAST(CAST(score >= CAST(0.5 AS DOUBLE) AS INT) = label AS INT)), 6) AS accuracy FROM split_records GROUP BY split"""))
def _(spark, folder):
    flag = flag_at(F.col("score"), 0.5)
    return rounded(split_records(spark, folder).groupBy("split").agg(
        F.avg("label").alias("base_rate"), F.avg(flag).alias("selection_rate"),
        F.avg((flag == F.col("label")).cast("double")).alias("accuracy")))


# --- order, ranking, sampling -------------------------------------------------------------------------------------

@query("w1_hash_split", check("SELECT id, entity, split FROM split_records"))
def _(spark, folder):
    return split_records(spark, folder).select("id", "entity", "split")


@query("w2_precision_at_k", check("""
WITH ranked AS (SELECT label, row_number() OVER (ORDER BY score DESC, md5(CAST(id AS VARCHAR)), id) AS r, count(*) OVER () AS n FROM records),
f AS (SELECT CAST(f AS DOUBLE) AS fraction FROM (VALUES (0.05), (0.1), (0.2)) v(f)),
k AS (SELECT fraction, greatest(1, CAST(ceil(CAST((SELECT max(n) FROM ranked) AS DOUBLE) * fraction) AS BIGINT)) AS k FROM f)
SELECT fraction, k, round(avg(label), 6) AS precision FROM k JOIN ranked ON r <= k GROUP BY fraction, k"""))
def _(spark, folder):
    return rounded(ranking.precision_at(records(spark, folder), "score", "label", "id", [0.05, 0.10, 0.20]))


@query("w2_precision_at_k_with_ties", check("""
WITH ranked AS (SELECT split, label, row_number() OVER (PARTITION BY split ORDER BY coarse_score DESC, md5(CAST(id AS VARCHAR)), id) AS r,
                       count(*) OVER (PARTITION BY split) AS n FROM split_records),
k AS (SELECT split, fraction, greatest(1, CAST(ceil(CAST(n AS DOUBLE) * fraction) AS BIGINT)) AS k
      FROM (SELECT DISTINCT split, n FROM ranked), (SELECT CAST(f AS DOUBLE) AS fraction FROM (VALUES (0.05), (0.1), (0.2)) v(f)))
SELECT k.split, fraction, k, round(avg(label), 6) AS precision FROM k JOIN ranked ON ranked.split = k.split AND r <= k GROUP BY k.split, fraction, k"""))
def _(spark, folder):
    return rounded(ranking.precision_at(split_records(spark, folder), "coarse_score", "label", "id", [0.05, 0.10, 0.20], ["split"]))


_LEVELS = """
levels AS (SELECT {by}, {score} AS s, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS q FROM {source} GROUP BY {by}, {score}),
running AS (SELECT *, sum(p) OVER (PARTITION BY {by} ORDER BY s DESC) AS cp, sum(p + q) OVER (PARTITION BY {by} ORDER BY s DESC) AS cn,
                   coalesce(sum(q) OVER (PARTITION BY {by} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM levels)"""


@query("w3_average_precision", check("WITH " + _LEVELS.format(by="split", score="score", source="split_records").strip() + """
SELECT split, round(sum(p * cp / cn) / sum(p), 6) AS pr_auc FROM running GROUP BY split"""))
def _(spark, folder):
    return rounded(ranking.ranking_metrics(split_records(spark, folder), "score", "label", ["split"]).select("split", "pr_auc"))


@query("w4_roc_auc_with_ties", check("WITH " + _LEVELS.format(by="split", score="coarse_score", source="split_records").strip() + """
SELECT split, round(sum(p * (below + CAST(0.5 AS DOUBLE) * q)) / (sum(p) * sum(q)), 6) AS roc_auc, round(sum(p * cp / cn) / sum(p), 6) AS pr_auc
FROM running GROUP BY split"""))
def _(spark, folder):
    return rounded(ranking.ranking_metrics(split_records(spark, folder), "coarse_score", "label", ["split"]).select(
        "split", "roc_auc", "pr_auc"))


@query("w5_ranked_worklist", check("""
SELECT rank() OVER (ORDER BY coarse_score DESC) AS rank, id, coarse_score AS score, CAST(coarse_score >= CAST(0.9 AS DOUBLE) AS INT) AS flag FROM records"""))
def _(spark, folder):
    return worklist.ranked_worklist(records(spark, folder), "id", "coarse_score", 0.9)


@query("w6_sorted_report", check("SELECT status, count(*) AS n, round(avg(score), 6) AS mean_score FROM records GROUP BY status ORDER BY n DESC"))
def _(spark, folder):
    grouped = records(spark, folder).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"))
    return rounded(grouped).orderBy(F.col("n").desc(), "status")


@query("w7_sorted_categories", check("""
SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY level) - 1 AS position, level FROM (
  SELECT DISTINCT 'priority' AS "column", priority AS level FROM records WHERE priority IS NOT NULL
  UNION SELECT DISTINCT 'status', status FROM records UNION SELECT DISTINCT 'entity', CAST(entity AS VARCHAR) FROM records)"""))
def _(spark, folder):
    return P.sorted_levels(records(spark, folder), ["priority", "status", "entity"])


@query("w8_seeded_sample", "SELECT l_orderkey, l_linenumber, l_partkey, key FROM (SELECT *, l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey || '/' || CAST(l_shipdate AS DATE) AS key FROM lineitem) ORDER BY md5('42:' || key), key LIMIT 5000")
def _(spark, folder):
    rows = table(spark, folder, "lineitem")
    key = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").cast("string"))
    keyed = rows.select("l_orderkey", "l_linenumber", "l_partkey", key.alias("key"))
    return ordering.sample_rows(keyed, 5000, "key", 42)


@query("w9_top_rows", check("SELECT id, score FROM records ORDER BY score DESC, id LIMIT 10"))
def _(spark, folder):
    return ranking.top_rows(records(spark, folder).select("id", "score"), "score", "id", 10)


@query("w10_bag_union", check("SELECT id, status, price FROM records WHERE status = 'F' UNION ALL SELECT id, status, price FROM records WHERE status <> 'P'"))
def _(spark, folder):
    df = records(spark, folder).select("id", "status", "price")
    return union_by_name([df.where("status = 'F'"), df.select("price", "status", "id").where("status <> 'P'")])


@query("w11_distinct_keys", check("SELECT DISTINCT entity FROM records"))
def _(spark, folder):
    return records(spark, folder).select("entity").distinct()


# --- evaluation ---------------------------------------------------------------------------------------------------

_CELLS = """SELECT {by}, count(*) FILTER (label = 0 AND p = 0) AS tn, count(*) FILTER (label = 0 AND p = 1) AS fp,
  count(*) FILTER (label = 1 AND p = 0) AS fn, count(*) FILTER (label = 1 AND p = 1) AS tp FROM {source} GROUP BY {by}"""
_FLAGGED = "flagged AS (SELECT *, CAST(score >= CAST(0.7 AS DOUBLE) AS INT) AS p FROM split_records)"


@query("e1_confusion_matrix", check(f"WITH {_FLAGGED} " + _CELLS.format(by="split", source="flagged")))
def _(spark, folder):
    df = split_records(spark, folder).withColumn("p", flag_at(F.col("score"), 0.7))
    return df.groupBy("split").agg(*E.confusion_sums(F.col("label"), F.col("p")))


@query("e2_e3_classification_metrics", check(f"""WITH {_FLAGGED}, cells AS ({_CELLS.format(by="split", source="flagged")}),
pr AS (SELECT *, coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS precision, coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS recall FROM cells)
SELECT split, round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1 FROM pr"""))
def _(spark, folder):
    df = split_records(spark, folder).withColumn("p", flag_at(F.col("score"), 0.7))
    return rounded(E.prediction_metrics(df, "label", "p", ["split"]).select("split", "accuracy", "precision", "recall", "f1"))


@query("e2_zero_division", check("""
SELECT status, CAST(0 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall, round(avg(CAST(label = 0 AS INT)), 6) AS accuracy FROM records GROUP BY status"""))
def _(spark, folder):
    df = records(spark, folder).withColumn("p", F.lit(0))
    return rounded(E.prediction_metrics(df, "label", "p", ["status"]).select("status", "precision", "recall", "accuracy"))


@query("e4_lift_over_base_rate", check("""
WITH ranked AS (SELECT label, row_number() OVER (ORDER BY score DESC, md5(CAST(id AS VARCHAR)), id) AS r, count(*) OVER () AS n FROM records)
SELECT round(avg(label), 6) AS base_rate, round(avg(label) FILTER (r <= ceil(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE))), 6) AS precision,
  round(avg(label) FILTER (r <= ceil(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE))) / avg(label), 6) AS lift FROM ranked"""))
def _(spark, folder):
    df = records(spark, folder)
    base = df.agg(F.avg("label").alias("b")).scalar()
    at = ranking.precision_at(df, "score", "label", "id", [0.10]).withColumn("base_rate", base)
    return rounded(at.select("base_rate", "precision", (F.col("precision") / F.col("base_rate")).alias("lift")))


@query("e5_brier_score", check("SELECT split, round(avg(pow(score - label, 2)), 6) AS brier_score FROM split_records GROUP BY split"))
def _(spark, folder):
    return rounded(E.brier_score(split_records(spark, folder), "score", "label", ["split"]))


_FULL = """
thr AS (SELECT {by}, quantile_cont({score}, 1 - CAST(0.1 AS DOUBLE)) AS threshold FROM {validation} GROUP BY {by}),
ranked AS (SELECT {by}, label, {score} AS sc, row_number() OVER (PARTITION BY {by} ORDER BY {score} DESC, md5(CAST(id AS VARCHAR)), id) AS r,
                  count(*) OVER (PARTITION BY {by}) AS n FROM {source}),
flat AS (SELECT r.{by}, max(threshold) AS threshold, avg(pow(sc - label, 2)) AS brier_score, avg(label) AS base_rate,
  avg(label) FILTER (r <= ceil(CAST(n AS DOUBLE) * CAST(0.05 AS DOUBLE))) AS p5, avg(label) FILTER (r <= ceil(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE))) AS p10,
  avg(label) FILTER (r <= ceil(CAST(n AS DOUBLE) * CAST(0.2 AS DOUBLE))) AS p20,
  count(*) FILTER (label = 0 AND sc < threshold) AS tn, count(*) FILTER (label = 0 AND sc >= threshold) AS fp,
  count(*) FILTER (label = 1 AND sc < threshold) AS fn, count(*) FILTER (label = 1 AND sc >= threshold) AS tp
  FROM ranked r JOIN thr ON thr.{by} = r.{by} GROUP BY r.{by}),
auc AS (SELECT {by}, sum(p * cp / cn) / sum(p) AS pr_auc, sum(p * (below + CAST(0.5 AS DOUBLE) * q)) / (sum(p) * sum(q)) AS roc_auc FROM running GROUP BY {by})"""


@query("e6_full_metrics", check("WITH base AS (SELECT * FROM split_records WHERE split = 'test'), val AS (SELECT 'test' AS split, score FROM split_records WHERE split = 'validation'),"
    + _LEVELS.format(by="split", score="score", source="base") + "," + _FULL.format(by="split", score="score", source="base", validation="val") + """
SELECT round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc, round(brier_score, 6) AS brier_score, round(p5, 6) AS precision_at_5pct,
  round(p10, 6) AS precision_at_10pct, round(p20, 6) AS precision_at_20pct, round(base_rate, 6) AS base_rate,
  round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS precision_at_threshold,
  round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall_at_threshold, round(threshold, 6) AS threshold, tn, fp, fn, tp
FROM flat JOIN auc USING (split)"""))
def _(spark, folder):
    df = materialise(split_records(spark, folder).select("id", "label", "score", "split"), "scored")
    threshold = E.alert_volume_threshold(df.where("split = 'validation'"), "score", 0.10)
    return rounded(E.full_metrics(df.where("split = 'test'"), "score", "label", "id", threshold))


@query("e7_calibration_curve", check("""
SELECT CAST(""" + " + ".join(f"CAST(score > CAST('{i * 0.1!r}' AS DOUBLE) AS INT)" for i in range(1, 10)) + """ AS INT) AS bin,
  count(*) AS n, round(avg(score), 6) AS mean_predicted, round(avg(label), 6) AS fraction_positive FROM records GROUP BY 1"""))
def _(spark, folder):
    return rounded(E.calibration_curve(records(spark, folder), "score", "label"))


@query("e7_calibration_curve_on_edges", check("""
SELECT CAST(""" + " + ".join(f"CAST(coarse_score > CAST('{i * 0.1!r}' AS DOUBLE) AS INT)" for i in range(1, 10)) + """ AS INT) AS bin,
  count(*) AS n, round(avg(coarse_score), 6) AS mean_predicted, round(avg(label), 6) AS fraction_positive FROM records GROUP BY 1"""))
def _(spark, folder):
    return rounded(E.calibration_curve(records(spark, folder), "coarse_score", "label"))


_SUBGROUPS = """SELECT "column", coalesce(value, 'Missing') AS value, count(*) AS n, round(avg(label), 6) AS base_rate, round(avg(p), 6) AS selection_rate,
  round(coalesce(count(*) FILTER (p = 1 AND label = 1) / CAST(nullif(count(*) FILTER (p = 1), 0) AS DOUBLE), 0), 6) AS precision,
  round(coalesce(count(*) FILTER (p = 1 AND label = 1) / CAST(nullif(count(*) FILTER (label = 1), 0) AS DOUBLE), 0), 6) AS recall,
  CASE WHEN min(label) < max(label) THEN round(avg(pow(score - label, 2)), 6) END AS brier_score
FROM long GROUP BY 1, 2 HAVING count(*) >= 30"""


@query("e8_subgroup_metrics", check(f"""WITH {_FLAGGED},
long AS (SELECT 'priority' AS "column", priority AS value, * FROM flagged UNION ALL SELECT 'status', status, * FROM flagged
         UNION ALL SELECT 'counter', CAST(counter AS VARCHAR), * FROM flagged UNION ALL SELECT 'entity', CAST(entity AS VARCHAR), * FROM flagged)
{_SUBGROUPS}"""))
def _(spark, folder):
    return rounded(E.subgroup_metrics(split_records(spark, folder), "score", "label", 0.7, ["priority", "status", "counter", "entity"]))


@query("e9_alert_volume_threshold", check("""
SELECT split, round(quantile_cont(score, 1 - CAST(0.1 AS DOUBLE)), 6) AS threshold FROM split_records GROUP BY split"""))
def _(spark, folder):
    return rounded(E.alert_volume_threshold(split_records(spark, folder), "score", 0.10, ["split"]))


_MODELS = {"fine": "score", "coarse": "coarse_score", "rule": "rule", "constant": "constant"}
_LONG_MODELS = """models AS (SELECT *, unnest([{'model': 'fine', 's': score}, {'model': 'coarse', 's': coarse_score},
  {'model': 'rule', 's': CAST(CAST(counter >= 1 AS INT) AS DOUBLE)}, {'model': 'constant', 's': CAST(0.25 AS DOUBLE)}], recursive := true) FROM split_records)"""


@query("e10_model_comparison", check(f"WITH {_LONG_MODELS}, base AS (SELECT * FROM models WHERE split = 'test'), val AS (SELECT * FROM models WHERE split = 'validation'),"
    + _LEVELS.format(by="model", score="s", source="base") + "," + _FULL.format(by="model", score="s", source="base", validation="val") + """
SELECT model, round(pr_auc, 4) AS pr_auc, round(roc_auc, 4) AS roc_auc, round(p10, 4) AS precision_at_10pct,
  round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 4) AS recall_at_thr, round(brier_score, 4) AS brier FROM flat JOIN auc USING (model)"""))
def _(spark, folder):
    df = heuristic(split_records(spark, folder), "counter", 1, "rule").withColumn("constant", F.lit(0.25))
    scored = materialise(E.score_columns_to_rows(df, _MODELS, ["id", "label", "split"]), "scored")
    return E.comparison_table(scored.where("split = 'validation'"), scored.where("split = 'test'"), "label", "id")


# --- fairness -----------------------------------------------------------------------------------------------------

_BIAS = """
flagged AS (SELECT *, CAST(score >= CAST(0.7 AS DOUBLE) AS INT) AS p FROM records),
long AS (SELECT 'priority' AS "column", priority AS value, label, p FROM flagged UNION ALL SELECT 'status', status, label, p FROM flagged),
g AS (SELECT "column", value, count(*) AS n, sum(label) AS pos, sum(p) AS sel, sum(CAST(p = label AS INT)) AS hit, sum(p * label) AS tp FROM long GROUP BY 1, 2),
t AS (SELECT "column", sum(n) AS n, sum(pos) AS pos, sum(sel) AS sel, sum(hit) AS hit, sum(tp) AS tp FROM g GROUP BY 1),
o AS (SELECT g.*, t.n - g.n AS on_, t.pos - g.pos AS opos, t.sel - g.sel AS osel, t.hit - g.hit AS ohit, t.tp - g.tp AS otp
      FROM g JOIN t USING ("column") WHERE g.value IS NOT NULL AND g.n >= 30),
b AS (SELECT "column", value, CAST(n AS BIGINT) AS n_facet, CAST(on_ AS BIGINT) AS n_other, (on_ - n) / CAST(n + on_ AS DOUBLE) AS class_imbalance,
  pos / CAST(n AS DOUBLE) - opos / CAST(on_ AS DOUBLE) AS difference_in_label_proportion,
  (sel / CAST(n AS DOUBLE)) / nullif(osel / CAST(on_ AS DOUBLE), 0) AS disparate_impact, sel / CAST(n AS DOUBLE) - osel / CAST(on_ AS DOUBLE) AS difference_in_selection_rate,
  hit / CAST(n AS DOUBLE) - ohit / CAST(on_ AS DOUBLE) AS accuracy_difference, tp / CAST(nullif(pos, 0) AS DOUBLE) - otp / CAST(nullif(opos, 0) AS DOUBLE) AS recall_difference,
  sel / CAST(n AS DOUBLE) AS selection_rate_facet, osel / CAST(on_ AS DOUBLE) AS selection_rate_other, hit / CAST(n AS DOUBLE) AS accuracy_facet,
  ohit / CAST(on_ AS DOUBLE) AS accuracy_other, tp / CAST(nullif(pos, 0) AS DOUBLE) AS recall_facet, otp / CAST(nullif(opos, 0) AS DOUBLE) AS recall_other FROM o)"""


def _bias(spark, folder):
    df = records(spark, folder).withColumn("p", flag_at(F.col("score"), 0.7))
    return fairness.bias_metrics(df, {"priority": None, "status": None}, "label", "p")


_PRE = ["class_imbalance", "difference_in_label_proportion"]
_POST = ["disparate_impact", "difference_in_selection_rate", "accuracy_difference", "recall_difference", "selection_rate_facet",
         "selection_rate_other", "accuracy_facet", "accuracy_other", "recall_facet", "recall_other"]


@query("f1_pretraining_bias", check(f"WITH {_BIAS.strip()} SELECT \"column\", value, {', '.join(f'round({c}, 6) AS {c}' for c in _PRE)} FROM b"))
def _(spark, folder):
    return rounded(_bias(spark, folder).select("column", "value", *_PRE))


@query("f2_posttraining_bias", check(f"WITH {_BIAS.strip()} SELECT \"column\", value, {', '.join(f'round({c}, 6) AS {c}' for c in _POST)} FROM b"))
def _(spark, folder):
    return rounded(_bias(spark, folder).select("column", "value", *_POST))


@query("f3_facet_eligibility", check("""
SELECT 'entity' AS "column", CAST(entity AS VARCHAR) AS value, count(*) AS n_facet, CAST((SELECT count(*) FROM records) - count(*) AS BIGINT) AS n_other
FROM records GROUP BY entity HAVING count(*) >= 15
UNION ALL SELECT 'status', status, count(*), CAST((SELECT count(*) FROM records) - count(*) AS BIGINT) FROM records WHERE status = 'F' GROUP BY status"""))
def _(spark, folder):
    df = records(spark, folder).withColumn("p", flag_at(F.col("score"), 0.7))
    bias = fairness.bias_metrics(df, {"entity": None, "status": ["F"]}, "label", "p", min_rows=15)
    return bias.select("column", "value", "n_facet", "n_other")


@query("f4_four_fifths_rule", check(f"WITH {_BIAS.strip()} SELECT \"column\", value, CAST(coalesce(disparate_impact BETWEEN 0.8 AND 1.25, false) AS INT) AS within_four_fifths FROM b"))
def _(spark, folder):
    return _bias(spark, folder).select("column", "value", "within_four_fifths")
