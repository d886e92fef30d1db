"""Second-order boosting, its search and its attribution, and dictionaries as tables.

Two rounds on four columns are written out in SQL, split by split, to check the learner with; the rest is tested against
enumeration on fixtures.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import platt
from ..operators import boosting as B, dictionaries as D, evaluation as E, modeling as M
from ..operators.modeling import FeatureSchema
from ..operators.ranking import ranking_metrics
from ..session import materialise, work_path
from .aggregates import rounded
from .models import _LEVEL_COLUMNS, _level_sql, _schema, features
from .registry import query
from .sql import check


@query("m1_dictionary_codes", check("WITH levels AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT {c} AS v FROM clean WHERE split = 'train' AND {c} IS NOT NULL)" for c in _LEVEL_COLUMNS)
    + ") SELECT encounter_id, " + ", ".join(f"nullif({_level_sql(c)}, (SELECT count(*) FROM levels l WHERE l.c = '{c}')) AS {c}" for c in _LEVEL_COLUMNS)
    + " FROM clean p WHERE split = 'production'"))
def _(spark, folder):
    dictionary = D.fit_dictionary(features(spark, folder, "train"), _LEVEL_COLUMNS)
    encoded = D.encode_levels(features(spark, folder, "production"), dictionary, {c: f"{c}__level" for c in _LEVEL_COLUMNS})
    return encoded.select("encounter_id", *[F.col(f"{c}__level").alias(c) for c in _LEVEL_COLUMNS])


@query("w7_dictionary", check(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", v AS value, row_number() OVER (ORDER BY v) - 1 AS level FROM (SELECT DISTINCT {c} AS v FROM clean WHERE split = 'train' AND {c} IS NOT NULL)"
    for c in _LEVEL_COLUMNS)))
def _(spark, folder):
    return D.fit_dictionary(features(spark, folder, "train"), _LEVEL_COLUMNS)


_TWO = {"max_depth": 2, "num_round": 2, "eta": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 2.0, "lambda": 1.5, "scale_pos_weight": 2.0}
_TWO_SCHEMA = FeatureSchema(("race", "medical_specialty"), ("number_inpatient", "time_in_hospital"))


def _boosting_sql() -> str:
    """Two rounds of depth 2, one common table expression a step."""
    cats, nums = _TWO_SCHEMA.categorical, _TWO_SCHEMA.numeric
    penalty, least = f"CAST({_TWO['lambda']} AS DOUBLE)", f"CAST({_TWO['min_child_weight']} AS DOUBLE)"
    cells = [f"SELECT node, {i} AS f, {c} AS c, CAST(NULL AS DOUBLE) AS x, g, h FROM {{t}}" for i, c in enumerate(cats)]
    cells += [f"SELECT node, {len(cats) + i} AS f, CAST(NULL AS VARCHAR) AS c, CAST({c} AS DOUBLE) AS x, g, h FROM {{t}}" for i, c in enumerate(nums)]
    known = [f"CASE WHEN {c} IN (SELECT {c} FROM clean WHERE split = 'train') THEN {c} END AS {c}" for c in cats]
    ctes = [f"m0 AS (SELECT encounter_id, split, readmit_30 AS y, {', '.join(known)}, {', '.join(nums)}, CAST(0 AS DOUBLE) AS m FROM clean)"]
    for r in range(_TWO["num_round"]):
        ctes.append(f"""a{r}_0 AS (SELECT *, 1 AS node, (p - y) * wt AS g, p * (1 - p) * wt AS h FROM (
  SELECT *, 1 / (1 + exp(-m)) AS p, CASE WHEN y = 1 THEN CAST({_TWO['scale_pos_weight']} AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS wt FROM m{r}))""")
        for d in range(_TWO["max_depth"]):
            t, k = f"a{r}_{d}", f"{r}_{d}"
            train = f"(SELECT * FROM {t} WHERE split = 'train' AND node >= {2 ** d})"
            ctes.append(f"s{k} AS (SELECT node, f, c, x, sum(g) AS g, sum(h) AS h, c IS NULL AND x IS NULL AS gone FROM ({' UNION ALL '.join(cells).replace('{t}', train)}) GROUP BY node, f, c, x)")
            ctes.append(f"""o{k} AS (SELECT *, row_number() OVER w AS rank, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER n AS gt, sum(h) OVER n AS ht,
  coalesce(sum(g) FILTER (gone) OVER n, 0) AS gm, coalesce(sum(h) FILTER (gone) OVER n, 0) AS hm, max(CAST(gone AS INT)) OVER n AS lacks
  FROM s{k} WINDOW n AS (PARTITION BY node, f),
  w AS (PARTITION BY node, f ORDER BY gone, round(CASE WHEN f < {len(cats)} THEN g / h ELSE x END, 9), c, x ROWS UNBOUNDED PRECEDING))""")
            ctes.append(f"""b{k} AS (SELECT * FROM (SELECT *, round(gl * gl / (hl + {penalty}) + (gt - gl) * (gt - gl) / (ht - hl + {penalty}) - gt * gt / (ht + {penalty}), 9) AS gain FROM (
  SELECT node, f, rank, x, ml, gt, ht, gl + ml * gm AS gl, hl + ml * hm AS hl FROM o{k}, (SELECT unnest([0, 1]) AS ml) WHERE NOT gone AND (ml = 0 OR lacks = 1)))
  WHERE hl >= {least} AND ht - hl >= {least} AND gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, rank, ml) = 1)""")
            tests = [f"WHEN b.f = {i} THEN CASE WHEN {c} IS NULL THEN ml ELSE CAST(EXISTS (SELECT 1 FROM o{k} o WHERE o.node = b.node AND o.f = b.f AND o.rank <= b.rank AND o.c = {c}) AS INT) END" for i, c in enumerate(cats)]
            tests += [f"WHEN b.f = {len(cats) + i} THEN CASE WHEN {c} IS NULL THEN ml ELSE CAST({c} < coalesce((SELECT min({c}) FROM clean u WHERE u.split = 'train' AND u.{c} > b.x), CAST('inf' AS DOUBLE)) AS INT) END" for i, c in enumerate(nums)]
            ctes.append(f"""a{r}_{d + 1} AS (SELECT encounter_id, split, y, {', '.join([*cats, *nums])}, m, g, h,
  CASE WHEN b.node IS NULL THEN a.node ELSE 2 * a.node + 1 - CASE {' '.join(tests)} END END AS node FROM {t} a LEFT JOIN b{k} b ON b.node = a.node)""")
        last = f"a{r}_{_TWO['max_depth']}"
        ctes.append(f"l{r} AS (SELECT node, -CAST({_TWO['eta']} AS DOUBLE) * sum(g) / (sum(h) + {penalty}) AS v FROM {last} WHERE split = 'train' GROUP BY node)")
        ctes.append(f"m{r + 1} AS (SELECT encounter_id, split, y, {', '.join([*cats, *nums])}, m + v AS m FROM {last} a JOIN l{r} l ON l.node = a.node)")
    return f"WITH {', '.join(ctes)} SELECT encounter_id, round(m, 6) AS margin FROM m{_TWO['num_round']}"


@query("m7_second_order_boosting", check(_boosting_sql()))
def _(spark, folder):
    train = features(spark, folder, "train")
    model = B.fit_second_order(train, _TWO_SCHEMA, S.TARGET, "encounter_id", _TWO).model()
    parts = [model.add_margin(features(spark, folder, split)).select("encounter_id", F.round("margin", 6).alias("margin"))
             for split in ("train", "validation", "test", "production")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_BUNDLE_SQL = f"""
WITH scored AS (SELECT c.encounter_id, split, readmit_30 AS y, 1 / (1 + exp(-margin)) AS x FROM ({_boosting_sql()}) t JOIN clean c ON c.encounter_id = t.encounter_id),
cells AS (SELECT x, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS pos FROM scored WHERE split = 'validation' GROUP BY x),
fit AS (SELECT * FROM (WITH RECURSIVE step AS (SELECT 0 AS i, CAST(0 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS b
UNION ALL
SELECT i + 1, w - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
FROM (SELECT i, w, b, sum(x * (n * p - pos)) + w AS g1, sum(n * p - pos) AS g2, sum(n * p * (1 - p) * x * x) + 1 AS h11,
    sum(n * p * (1 - p) * x) AS h12, sum(n * p * (1 - p)) AS h22
  FROM (SELECT *, 1 / (1 + exp(-(w * x + b))) AS p FROM step, cells WHERE i < 15) GROUP BY i, w, b)) SELECT * FROM step WHERE i = 15))
SELECT encounter_id, round(1 / (1 + exp(-(w * x + b))), 4) AS probability FROM scored, fit WHERE split = 'production'"""


@query("m11_m12_second_order_bundle", check(_BUNDLE_SQL))
def _(spark, folder):
    """Fitted on train, calibrated and frozen on validation, saved, loaded again, and production scored through it."""
    train, validation = features(spark, folder, "train"), features(spark, folder, "validation")
    model = B.fit_second_order(train, _TWO_SCHEMA, S.TARGET, "encounter_id", _TWO).model()
    raw = M.add_score(validation, model)
    a, b = M.fit_platt(raw, "score", S.TARGET)
    threshold = E.alert_volume_threshold(raw.withColumn("p", platt(F.col("score"), a, b)), "p", 0.10).first()["threshold"]
    path = work_path(spark, "bundle")
    M.save_bundle(spark, path, model, _TWO_SCHEMA, a, b, threshold, 0.10, "2024-01-01T00:00:00Z")
    scored = M.load_bundle(spark, path).score(features(spark, folder, "production"), "encounter_id")
    return scored.select("encounter_id", F.round("probability", 4).alias("probability"))


@query("m7_stopped_by_metric")
def _(spark, folder):
    """All features at the default depth; rounds stop once validation PR-AUC has not risen for two."""
    train, validation = features(spark, folder, "train"), features(spark, folder, "validation")
    booster = B.fit_second_order(train, _schema(train), S.TARGET, "encounter_id", {"num_round": 4}, validation, patience=2)
    model = booster.model()
    scored = materialise(model.add_score(validation).select("score", S.TARGET), "scored")  # metrics read scores several times
    return rounded(ranking_metrics(scored, "score", S.TARGET)).withColumns(
        {"rounds": F.lit(len(model.trees)), "rounds_grown": F.lit(len(booster.trees))})
