"""Which features drive a model, measured on a fixed-size seeded sample; and what leaving one out changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.nulls import quoted
from .boosting import WORD, BoostedTrees, fit_second_order
from .evaluation import alert_volume_threshold, subgroup_metrics
from .modeling import FeatureSchema, add_score, category_levels, coefficients, feature_schema, fit_boosted
from .ordering import hash_key, sample_rows
from .ranking import ranking_metrics
from ..session import materialise


def linear_attribution(
    model: PipelineModel, schema: FeatureSchema, df: DataFrame, id_column: str, n: int = 5000, seed: int = 42
) -> DataFrame:
    """Mean absolute ``w * (x - mean)`` per feature of a one-hot logistic model, largest first."""
    weights, _ = coefficients(model)
    levels = category_levels(model)
    owners = [c for c in schema.categorical for _ in levels[c]] + list(schema.numeric)
    terms = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(w).alias("w")) for f, w in zip(owners, weights)])
    sample = sample_rows(df, n, id_column, seed)
    inputs = PipelineModel(stages=model.stages[:-1]).transform(sample)
    zipped = F.arrays_zip(vector_to_array("features").alias("x"), terms.alias("t"))
    cells = inputs.select(F.col(id_column).alias("_id"), F.posexplode(zipped).alias("slot", "c"))
    # At most n rows per slot, by construction of the sample.
    centred = F.col("c.x") - F.avg("c.x").over(Window.partitionBy("slot"))
    parts = cells.select("_id", F.col("c.t.feature").alias("feature"), (F.col("c.t.w") * centred).alias("part"))
    per_row = parts.groupBy("_id", "feature").agg(F.sum("part").alias("part"))
    return per_row.groupBy("feature").agg(F.avg(F.abs("part")).alias("mean_abs")).withColumn(
        "method", F.lit("linear")).orderBy(F.col("mean_abs").desc(), "feature")


def permutation_importance(
    model: PipelineModel, schema: FeatureSchema, df: DataFrame, target: str, id_column: str, n: int = 5000,
    seed: int = 42,
) -> DataFrame:
    """Loss of PR-AUC when one feature is shuffled, for every feature in one scoring job.

    The sample has at most ``n`` rows, so the shuffles (each row takes the value of the next row in a seeded
    hash order) are windows over a bounded table.
    """
    sample = sample_rows(df, n, id_column, seed).select(id_column, target, *[quoted(c) for c in schema.order])
    shuffled = []
    for i, feature in enumerate(schema.order):
        order = Window.partitionBy(F.lit(0)).orderBy(hash_key(F.col(id_column), f"{seed}/{i}"), id_column)
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        wrapped = F.when(F.row_number().over(order) == F.count(F.lit(1)).over(whole),
                         F.first(quoted(feature)).over(whole)).otherwise(F.lead(quoted(feature)).over(order))
        shuffled.append(wrapped.alias(f"_shuffled_{i}"))
    both = sample.select("*", *shuffled)

    def variant(name: str, replaced: int | None) -> Column:
        cells = [F.col(f"_shuffled_{i}") if i == replaced else quoted(c) for i, c in enumerate(schema.order)]
        return F.struct(F.lit(name).alias("variant"), *[v.alias(c) for v, c in zip(cells, schema.order)])

    variants = F.array(variant("", None), *[variant(c, i) for i, c in enumerate(schema.order)])
    rows = both.select(target, F.explode(variants).alias("v")).select(target, "v.*")
    scored = add_score(rows, model, "_score")
    quality = ranking_metrics(scored, "_score", target, ["variant"]).select("variant", "pr_auc")
    unshuffled = quality.where("variant = ''").select("pr_auc").scalar()
    drops = quality.withColumn("_base", unshuffled).where("variant <> ''").select(
        F.col("variant").alias("feature"), (F.col("_base") - F.col("pr_auc")).alias("pr_auc_drop"))
    return drops.select("feature", F.abs("pr_auc_drop").alias("mean_abs"), "pr_auc_drop",
                        F.lit("permutation").alias("method")).orderBy(F.col("pr_auc_drop").desc(), "feature")


def leaf_paths(model: BoostedTrees) -> list[tuple]:
    """One row per leaf and distinct feature on its path: (tree, leaf, weight, feature, below, from, sets, missing, share).

    A row of the data satisfies the feature if its bin is below ``below`` and not below ``from``, or in all sets of levels
    (a set is (words, whether it must hold the level)), or missing where ``missing`` says so. ``share`` is the part of the
    cover that follows the path at the feature's splits.
    """
    rows = []
    for number, tree in enumerate(model.trees):
        for leaf, node in tree.items():
            if node.feature is not None:
                continue
            found: dict[int, dict] = {}
            child = leaf
            while child > 1:
                above, left = tree[child // 2], child % 2 == 0
                own = found.setdefault(above.feature, {"below": None, "from": None, "sets": [], "missing": True, "share": 1.0})
                if above.words is not None:
                    own["sets"].append((above.words, left))
                elif left:
                    own["below"] = above.cut if own["below"] is None else min(own["below"], above.cut)
                else:
                    own["from"] = above.cut if own["from"] is None else max(own["from"], above.cut)
                own["missing"] &= above.missing_left == left
                own["share"] *= tree[child].cover / above.cover if above.cover else 0.0
                child //= 2
            rows += [
                (number, leaf, node.weight, feature, own["below"], own["from"], own["sets"], own["missing"], own["share"])
                for feature, own in found.items()
            ]
    return rows


_PATH = ("tree int, leaf int, weight double, feature int, below long, `from` long, sets array<struct<words: array<long>, inside: boolean>>, "
         "missing boolean, share double")
# A cell is one feature of a path: ``o`` tells whether the row follows the path there, ``z`` is its share of the cover. The
# product of (z + o t) over the other features counts coalitions by size; each size k of m features weighs k! (m - 1 - k)! / m!.
_COALITIONS = """aggregate(filter(cells, c -> c.feature <> own.feature), array(CAST(1 AS DOUBLE)), (p, c) -> zip_with(
  concat(transform(p, x -> x * c.z), array(CAST(0 AS DOUBLE))), concat(array(CAST(0 AS DOUBLE)), transform(p, x -> x * c.o)), (a, b) -> a + b))"""
_SHARE = f"""transform(cells, own -> struct(own.feature AS feature, weight * (own.o - own.z) * aggregate(transform({_COALITIONS}, (x, k) ->
  x * factorial(k) * factorial(size(cells) - 1 - k) / factorial(size(cells))), CAST(0 AS DOUBLE), (a, b) -> a + b) AS part))"""


def path_contributions(model: BoostedTrees, sample: DataFrame, id_column: str) -> DataFrame:
    """``id, feature, contribution``: exact Shapley values of the margin, with coalitions valued along tree paths by cover.

    Leaves become a table with a row per feature of their path, joined with the cells of the sample by feature; the values
    are polynomial products over a path, so no coalition is listed. Work is sample x leaves, so give it a bounded sample.
    A row's contributions and ``expected_margin`` add up to its margin; features on no path are left out.
    """
    spark = sample.sparkSession
    names = model.binning.schema.order
    cells = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(b).alias("bin")) for i, b in enumerate(model.binning.bins)])
    long = model.binning.apply(sample).select(F.col(id_column).alias("_id"), F.explode(cells).alias("c")).select("_id", "c.feature", "c.bin")
    rows = leaf_paths(model)
    paths = spark.createDataFrame(rows, _PATH)
    inside = F.expr(f"""forall(sets, s -> coalesce(bit_get(try_element_at(s.words, cast(bin div {WORD} AS int) + 1), cast(bin % {WORD} AS int)) = 1, false) = s.inside)""")
    follows = F.when(F.col("bin").isNull(), F.col("missing")).otherwise(
        F.coalesce(F.col("bin") < F.col("below"), F.lit(True)) & F.coalesce(F.col("bin") >= F.col("from"), F.lit(True)) & inside)
    cell = F.struct("feature", F.col("share").alias("z"), follows.cast("double").alias("o"))
    joined = long.join(F.broadcast(paths), "feature")  # as many rows as the model has path steps
    leaves = joined.groupBy("_id", "tree", "leaf", "weight").agg(F.collect_list(cell).alias("cells"))  # at most max_depth cells
    parts = leaves.select("_id", F.explode(F.expr(_SHARE)).alias("p"))
    labels = F.array(*[F.lit(n) for n in names])
    return parts.groupBy("_id", labels[F.col("p.feature")].alias("feature")).agg(F.sum("p.part").alias("contribution")).withColumnRenamed("_id", id_column)


def expected_margin(model: BoostedTrees) -> float:
    """The margin with nothing known: leaf weights by their share of the cover."""
    return sum(
        node.weight * (node.cover / tree[1].cover if tree[1].cover else 1.0) for tree in model.trees for node in tree.values() if node.feature is None
    )


def tree_attribution(model: BoostedTrees, df: DataFrame, id_column: str, n: int = 5000, seed: int = 42) -> DataFrame:
    """Mean absolute contribution per feature on a seeded sample of ``n`` rows, largest first; 0 for features never used."""
    names = model.binning.schema.order
    sample = materialise(sample_rows(df, n, id_column, seed), "attribution-sample")
    total = sample.count()
    sums = path_contributions(model, sample, id_column).groupBy("feature").agg(F.sum(F.abs("contribution")).alias("total"))
    every = df.sparkSession.createDataFrame([(c,) for c in names], "feature string").join(sums, "feature", "left")
    mean = F.coalesce(F.try_divide(F.col("total"), F.lit(total)), F.lit(0.0))
    return every.select("feature", mean.alias("mean_abs"), F.lit("tree_path").alias("method")).orderBy(F.col("mean_abs").desc(), "feature")


def attribution_ranking(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute value per contribution column, largest first."""
    long = contributions.select(*[quoted(c).cast("double").alias(c) for c in features]).unpivot(
        [], [quoted(c) for c in features], "feature", "v")
    return long.groupBy("feature").agg(F.avg(F.abs("v")).alias("mean_abs")).orderBy(F.col("mean_abs").desc(), "feature")


def ablate(
    train: DataFrame, test: DataFrame, features: Sequence[str], column: str, target: str,
    alert_fraction: float = 0.10, params: Mapping[str, float] | None = None, id_column: str | None = None,
) -> DataFrame:
    """Refit without ``column`` and compare test PR-AUC and the subgroup table of that column.

    The threshold of each variant is the alert-volume quantile of its own test scores. With ``id_column`` the models are
    second-order trees, without MLlib's.
    """
    parts = []
    for variant, kept in (("with", list(features)), ("without", [f for f in features if f != column])):
        schema = feature_schema(train, kept, target)
        if id_column:
            model = fit_second_order(train, schema, target, id_column, params).model()
        else:
            model = fit_boosted(train, schema, target, params)
        scored = add_score(test, model, "_score").withColumn(
            "_threshold", alert_volume_threshold(add_score(test, model, "_score"), "_score", alert_fraction).scalar())
        groups = subgroup_metrics(scored, "_score", target, F.col("_threshold"), [column])
        quality = ranking_metrics(scored, "_score", target).select("pr_auc").scalar()
        parts.append(groups.select(F.lit(variant).alias("variant"), "*").withColumn("test_pr_auc", quality))
    return parts[0].unionByName(parts[1])
