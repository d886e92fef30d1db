"""Second-order gradient boosting of trees on binned columns.

Every level of a tree is one aggregate of gradients and Hessians by (node, feature, bin) and a few windows over its
result. A task adds its rows up in arrays, one cell for every node and bin; features of too many levels for that are exploded
and grouped. Rows are never shuffled: a row's node is an expression over its bins. Missing values are tried on both sides of
a split; categories are split into sets of levels, ordered by their gradient ratio within the node.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.nulls import quoted
from ..session import compiled_methods, materialise, remove_path, work_path, written
from .dictionaries import encode_levels, fit_dictionary, level_counts, load_dictionary, save_dictionary
from .modeling import FeatureSchema
from .ranking import ranking_metrics

# Default settings of a fit and its early stopping.
SETTINGS = {
    "max_depth": 6, "eta": 0.1, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 1.0, "lambda": 1.0,
    "num_round": 200, "scale_pos_weight": 1.0,
}
PATIENCE = 20
MAX_BINS = 256
WORD = 32  # levels in one number of a level set
LEAST_GAIN = 1e-9
ARRAY_CELLS = 1 << 17  # cells (open nodes times bins) of a feature that a task adds up in arrays
ARRAY_ROWS = 1 << 16  # rows added up at once
UNWRITTEN = 64  # nodes of the last trees; their margins are computed anew by every reader, beyond that the rows are written


@dataclass(frozen=True)
class Binning:
    """How columns become bin numbers: sorted cuts of numbers, a dictionary of levels. NULL, NaN and unseen have none."""

    schema: FeatureSchema
    cuts: dict[str, list[float]]
    dictionary: DataFrame
    levels: dict[str, int]

    @property
    def bins(self) -> list[str]:
        return [f"_b{i}" for i in range(len(self.schema.order))]

    def sizes(self) -> list[int]:
        """Bins of each feature, and one more for missing values."""
        return [self.levels.get(c, 0) + 1 for c in self.schema.categorical] + [len(self.cuts[c]) + 2 for c in self.schema.numeric]

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with a bin column per feature: for numbers, how many cuts are not above the value."""
        names = dict(zip(self.schema.order, self.bins))
        df = encode_levels(df, self.dictionary, {c: names[c] for c in self.schema.categorical})
        df = df.withColumns({names[c]: F.col(names[c]).cast("int") for c in self.schema.categorical})
        for column in self.schema.numeric:
            bin_name, cuts = names[column], self.cuts[column]
            value = F.nanvl(quoted(column).cast("double"), F.lit(None).cast("double"))
            if not cuts:
                df = df.withColumn(bin_name, F.when(value.isNotNull(), F.lit(0)))
                continue
            splits = [float("-inf"), *cuts, float("inf")]
            df = Bucketizer(splits=splits, inputCol=f"_{bin_name}", outputCol=f"_{bin_name}_at").transform(df.withColumn(f"_{bin_name}", value))
            df = df.withColumn(bin_name, F.col(f"_{bin_name}_at").cast("int")).drop(f"_{bin_name}", f"_{bin_name}_at")
        return df


def fit_binning(train: DataFrame, schema: FeatureSchema, max_bins: int = MAX_BINS) -> Binning:
    """Levels of the categories and cuts of the numbers: every value but the smallest, or quantiles where values are many."""
    cuts: dict[str, list[float]] = {c: [] for c in schema.numeric}
    if schema.numeric:
        numbers = train.select(*[quoted(c).cast("double").alias(c) for c in schema.numeric])
        long = numbers.unpivot([], [quoted(c) for c in schema.numeric], "column", "value")
        distinct = materialise(long.where("value IS NOT NULL AND NOT isnan(value)").distinct(), "numbers")
        many = {r["column"] for r in distinct.groupBy("column").count().where(F.col("count") > max_bins).collect()}
        few = distinct.where(~F.col("column").isin(*many)) if many else distinct
        for row in few.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values")).collect():  # at most max_bins a column
            cuts[row["column"]] = row["values"][1:]
        if many:
            found = numbers.approxQuantile(sorted(many), [i / max_bins for i in range(1, max_bins)], 0.25 / max_bins)
            cuts.update({c: sorted(set(q)) for c, q in zip(sorted(many), found)})
    dictionary = fit_dictionary(train, schema.categorical)
    return Binning(schema, cuts, dictionary, level_counts(dictionary))


@dataclass
class Node:
    """A leaf, or a split: bins below ``cut`` go left, or the levels in ``words``; missing ones where ``missing_left`` says."""

    weight: float
    cover: float
    feature: int | None = None
    cut: int | None = None
    words: list[int] | None = None
    missing_left: bool = False

    def goes_left(self) -> str:
        """SQL condition over the bin columns; short, since a tree repeats it at every split."""
        name, missing = f"_b{self.feature}", str(self.missing_left).lower()
        if self.words is None:
            return f"coalesce({name} < {self.cut}, {missing})"
        words = ", ".join(f"{w}L" for w in self.words)  # one for every WORD levels of the feature, so no level lies outside
        return f"coalesce(bit_get(get(array({words}), shiftright({name}, 5)), {name} & 31) = 1, {missing})"


Tree = dict[int, Node]  # node n has the children 2n and 2n + 1; the root is 1


def route(tree: Tree, leaf, number: int = 1) -> str:
    """SQL value of the leaf a row ends in."""
    node = tree[number]
    if node.feature is None:
        return leaf(number, node)
    return f"CASE WHEN {node.goes_left()} THEN {route(tree, leaf, 2 * number)} ELSE {route(tree, leaf, 2 * number + 1)} END"


def tree_margin(tree: Tree) -> Column:
    return F.expr(route(tree, lambda _, node: f"cast({node.weight!r} AS double)"))


def _gain(g: Column, h: Column, penalty: float) -> Column:
    return F.coalesce(F.try_divide(g * g, h + F.lit(penalty)), F.lit(0.0))


def _array_sums(features: Sequence[tuple[int, str, int]], nodes: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: sums of a task's rows by (node, feature, bin); the last bin of a feature holds missing values."""
    place = np.zeros(max(nodes) + 1, np.int64)
    place[list(nodes)] = np.arange(len(nodes))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= ARRAY_ROWS:
                yield pa.Table.from_batches(held)
                held = []
        if held:
            yield pa.Table.from_batches(held)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {i: (np.zeros(len(nodes) * size, bool), np.zeros(len(nodes) * size), np.zeros(len(nodes) * size)) for i, _, size in features}
        for table in gathered(batches):
            node, g, h = place[table["node"].to_numpy()], table["g"].to_numpy(), table["h"].to_numpy()
            for i, name, size in features:
                cell = node * size + table[name].to_numpy()
                met, of_g, of_h = sums[i]
                met[cell] = True
                of_g += np.bincount(cell, g, len(met))
                of_h += np.bincount(cell, h, len(met))
        for i, _, size in features:
            met, of_g, of_h = sums[i]
            found = np.flatnonzero(met)
            bin_number = found % size
            yield pa.RecordBatch.from_arrays([
                pa.array(np.asarray(nodes)[found // size], pa.int32()), pa.array(np.full(len(found), i), pa.int32()),
                pa.array(bin_number, pa.int32(), mask=bin_number == size - 1), pa.array(of_g[found]), pa.array(of_h[found]),
            ], ["node", "feature", "bin", "g", "h"])

    return add_up


def _bin_sums(rows: DataFrame, features: Sequence[tuple[int, str, int]], nodes: Sequence[int]) -> DataFrame:
    """``node, feature, bin, g, h`` over rows that lie in ``nodes``; a feature is its number, bin column and size."""
    small = [f for f in features if f[2] * len(nodes) <= ARRAY_CELLS]
    large = [f for f in features if f[2] * len(nodes) > ARRAY_CELLS]
    parts = []
    if small:
        cells = rows.select("node", "g", "h", *[F.coalesce(F.col(name), F.lit(size - 1)).alias(name) for _, name, size in small])
        parts.append(cells.mapInArrow(_array_sums(small, nodes), "node int, feature int, bin int, g double, h double"))
    if large:
        cells = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(name).alias("bin")) for i, name, _ in large])
        parts.append(rows.select("node", "g", "h", F.explode(cells).alias("c")).select("node", "c.feature", "c.bin", "g", "h"))
    long = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    return long.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _ordered_bins(sums: DataFrame, categorical: int) -> DataFrame:
    """Sums by (node, feature, bin) with running sums in split order and totals; missing bins apart."""
    whole = Window.partitionBy("node", "feature")
    missing = F.col("bin").isNull()
    totals = {name: F.sum(name).over(whole) for name in ("g", "h")}
    gone = {name: F.coalesce(F.sum(F.when(missing, F.col(name))).over(whole), F.lit(0.0)) for name in ("g", "h")}
    place = F.when(F.col("feature") < categorical, F.coalesce(F.try_divide("g", "h"), F.lit(0.0))).otherwise(F.col("bin").cast("double"))
    order = whole.orderBy(missing, F.round(place, 9), "bin")  # missing ones last
    up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sums.select(
        "node", "feature", "bin", F.row_number().over(order).alias("rank"), F.sum("g").over(up_to).alias("gl"), F.sum("h").over(up_to).alias("hl"),
        totals["g"].alias("gt"), totals["h"].alias("ht"), gone["g"].alias("gm"), gone["h"].alias("hm"),
        F.max(missing.cast("int")).over(whole).alias("lacks"),
    ).where("bin IS NOT NULL")


def _best_splits(ordered: DataFrame, penalty: float, least_weight: float) -> DataFrame:
    """One row per node: the split of largest gain; ties go to the first feature, then the first place, then missing right."""
    sides = F.when(F.col("lacks") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    tried = ordered.withColumn("missing_left", F.explode(sides))
    tried = tried.withColumns({"gl": F.col("gl") + F.col("missing_left") * F.col("gm"), "hl": F.col("hl") + F.col("missing_left") * F.col("hm")})
    tried = tried.withColumns({"gr": F.col("gt") - F.col("gl"), "hr": F.col("ht") - F.col("hl")})
    gain = _gain(F.col("gl"), F.col("hl"), penalty) + _gain(F.col("gr"), F.col("hr"), penalty) - _gain(F.col("gt"), F.col("ht"), penalty)
    allowed = (F.col("hl") >= least_weight) & (F.col("hr") >= least_weight) & (F.col("hr") > 1e-12) & (F.col("hl") > 1e-12)
    loss = F.when(allowed, -F.round(gain, 9)).otherwise(F.lit(0.0))
    best = F.min(F.struct(loss.alias("loss"), "feature", "rank", "missing_left", "bin", "gl", "hl", "gt", "ht")).alias("best")
    return tried.groupBy("node").agg(best).select("node", "best.*")


def _level_sets(sums: DataFrame, best: Sequence, categorical: int) -> dict[int, list]:
    """For each chosen split on a category the levels it sends left, ``WORD`` of them in a number."""
    chosen = [r for r in best if r.feature < categorical and r.loss < -LEAST_GAIN]  # at most 2^depth
    if not chosen:
        return {}
    ordered = _ordered_bins(sums.where(" OR ".join(f"node = {r.node} AND feature = {r.feature}" for r in chosen)), categorical)
    inside = ordered.where(" OR ".join(f"node = {r.node} AND rank <= {r.rank}" for r in chosen))
    bit = F.expr(f"shiftleft(1L, cast(bin % {WORD} AS int))")
    words = inside.groupBy("node", F.expr(f"bin div {WORD}").alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.groupBy("node").agg(F.collect_list(F.struct("word", "bits")).alias("words"))
    return {r.node: r.words for r in found.collect()}


def _dense(words: list, levels: int) -> list[int]:
    """One number for every ``WORD`` levels."""
    out = [0] * -(-levels // WORD)
    for w in words:
        out[w.word] = w.bits
    return out


@dataclass
class Booster:
    """A fit in progress: ``rows`` hold id, label, bins, margin and whether they are held out; ``grow`` adds rounds.

    Once the trees since the last writing have more than ``UNWRITTEN`` nodes, the rows are written with their new margins to
    the shared folder and the table before is dropped, so no plan grows with the rounds; readers add up the margins of the
    trees since. Rows written elsewhere (no ``path``) stay, so several fits may share them.
    """

    rows: DataFrame
    binning: Binning
    settings: dict[str, float]
    seed: int = 42
    path: str = ""
    trees: list[Tree] = field(default_factory=list)
    quality: list[float] = field(default_factory=list)  # held-out PR-AUC after each round
    unwritten: list[Tree] = field(default_factory=list)  # not yet in the margins of ``rows``

    def _write(self, rows: DataFrame) -> None:
        spark, before, self.path = rows.sparkSession, self.path, work_path(rows.sparkSession, "margins")
        rows.write.parquet(self.path)
        self.rows = spark.read.schema(rows.schema).parquet(self.path)
        if before:
            remove_path(spark, before)

    def start_anew(self, settings: Mapping[str, float]) -> Booster:
        """Another fit from the same rows while this one has no trees; close this one last."""
        return Booster(self.rows, self.binning, {**SETTINGS, **settings}, self.seed)

    def close(self) -> None:
        """Delete the rows; the trees stay."""
        if self.path:
            remove_path(self.rows.sparkSession, self.path)
            self.path = ""

    def _grow_tree(self) -> Tree:
        p, number = self.settings, len(self.trees)
        source = random.Random(f"{self.seed}/{number}")
        bins = list(zip(range(len(self.binning.bins)), self.binning.bins, self.binning.sizes()))
        if p["colsample_bytree"] < 1:
            bins = sorted(source.sample(bins, max(1, round(p["colsample_bytree"] * len(bins)))))
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        weight = F.when(F.col("_y") == 1, F.lit(float(p["scale_pos_weight"]))).otherwise(F.lit(1.0))
        rows = self.scored().where("NOT _held")
        if p["subsample"] < 1:
            draw = F.pmod(F.xxhash64(F.col("_id"), F.lit(self.seed), F.lit(number)), F.lit(1_000_000))
            rows = rows.where(draw < int(p["subsample"] * 1_000_000))
        rows = rows.select(*[n for _, n, _ in bins], (weight * (score - F.col("_y"))).alias("g"), (weight * score * (1 - score)).alias("h"))
        tree: Tree = {}
        open_nodes = [1]
        categorical = len(self.binning.schema.categorical)
        for depth in range(int(p["max_depth"])):
            where = F.expr(route(tree, lambda n, _: f"{n}")) if tree else F.lit(1)
            at = rows.withColumn("node", where)
            at = at.where(F.col("node").isin(*open_nodes)) if tree else at
            with written(_bin_sums(at, bins, open_nodes), "sums") as sums:  # the one pass over the rows
                best = _best_splits(_ordered_bins(sums, categorical), p["lambda"], p["min_child_weight"]).collect()  # at most 2^depth rows
                words = _level_sets(sums, best, categorical)
            open_nodes = []
            for r in best:
                if not tree:
                    tree[1] = self._leaf(r.gt, r.ht)
                if r.loss >= -LEAST_GAIN:
                    continue
                node = tree[r.node]
                node.feature, node.missing_left = r.feature, r.missing_left == 1
                node.cut, node.words = (None, _dense(words[r.node], self.binning.levels[self.binning.schema.order[r.feature]])) if r.feature < categorical else (r.bin + 1, None)
                for child, g, h in ((2 * r.node, r.gl, r.hl), (2 * r.node + 1, r.gt - r.gl, r.ht - r.hl)):
                    tree[child] = self._leaf(g, h)
                    open_nodes.append(child)
            if not open_nodes:
                break
        return tree or {1: Node(0.0, 0.0)}

    def scored(self) -> DataFrame:
        """The rows with the margins of all trees."""
        margin = F.col("_margin")
        for tree in self.unwritten:
            margin = margin + tree_margin(tree)
        return self.rows.withColumn("_margin", margin) if self.unwritten else self.rows

    def _leaf(self, g: float, h: float) -> Node:
        total = h + self.settings["lambda"]
        return Node(-self.settings["eta"] * g / total if total > 0 else 0.0, h)

    def grow(self, rounds: int, watch: bool = True, patience: int | None = None) -> None:
        """Add up to ``rounds`` trees; with ``patience`` stop once the held-out PR-AUC has not risen for that many."""
        for _ in range(rounds):
            self.trees.append(self._grow_tree())
            self.unwritten.append(self.trees[-1])
            if sum(map(len, self.unwritten)) > UNWRITTEN:
                with compiled_methods(self.rows.sparkSession):
                    self._write(self.scored())
                self.unwritten = []
            if watch:
                with written(self.scored().where("_held").select("_margin", "_y"), "held") as held:  # read twice
                    self.quality.append(ranking_metrics(held, "_margin", "_y").first()["pr_auc"] or 0.0)
                if patience is not None and len(self.quality) - 1 - self.best_round() >= patience:
                    return

    def best_round(self) -> int:
        """The first round of the best held-out PR-AUC, from 0."""
        return max(range(len(self.quality)), key=lambda i: (self.quality[i], -i))

    def model(self, rounds: int | None = None) -> BoostedTrees:
        """All trees, or the first ones; by default up to the best round if rounds were watched."""
        if rounds is None:
            rounds = self.best_round() + 1 if self.quality else len(self.trees)
        return BoostedTrees(self.binning, self.trees[:rounds])


@dataclass(frozen=True)
class BoostedTrees:
    """Binning and trees; margins add up from 0."""

    binning: Binning
    trees: list[Tree]

    def margin(self) -> Column:
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + tree_margin(tree)
        return total

    def add_margin(self, df: DataFrame, output: str = "margin") -> DataFrame:
        return self.binning.apply(df).withColumn(output, self.margin()).drop(*self.binning.bins)

    def add_score(self, df: DataFrame, output: str = "score") -> DataFrame:
        """Input columns plus the positive-class probability."""
        return self.add_margin(df, output).withColumn(output, F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(output))))

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees and cuts as one JSON row, the dictionary as a table beside it."""
        content = {
            "categorical": self.binning.schema.categorical, "numeric": self.binning.schema.numeric, "cuts": self.binning.cuts,
            "trees": [{n: vars(node) for n, node in tree.items()} for tree in self.trees],
        }
        spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/trees")
        save_dictionary(self.binning.dictionary, f"{path}/dictionary")


def load_boosted_trees(spark: SparkSession, path: str) -> BoostedTrees:
    content = json.loads(spark.read.text(f"{path}/trees").first()["value"])
    schema = FeatureSchema(tuple(content["categorical"]), tuple(content["numeric"]))
    trees = [{int(n): Node(**node) for n, node in tree.items()} for tree in content["trees"]]
    dictionary = load_dictionary(spark, f"{path}/dictionary")
    return BoostedTrees(Binning(schema, content["cuts"], dictionary, level_counts(dictionary)), trees)


def start_boosting(
    train: DataFrame, schema: FeatureSchema, target: str, id_column: str, settings: Mapping[str, float] | None = None,
    validation: DataFrame | None = None, seed: int = 42, binning: Binning | None = None, max_bins: int = MAX_BINS,
) -> Booster:
    """Bins fitted on train; the binned rows of both frames are written once. Rows without a label are left out."""
    binning = binning or fit_binning(train, schema, max_bins)
    both = train.withColumn("_held", F.lit(False))
    if validation is not None:
        both = both.unionByName(validation.withColumn("_held", F.lit(True)))
    both = binning.apply(both.where(F.col(target).isNotNull()))
    rows = both.select(F.col(id_column).alias("_id"), F.col(target).cast("double").alias("_y"), "_held", *binning.bins, F.lit(0.0).alias("_margin"))
    booster = Booster(rows, binning, {**SETTINGS, **(settings or {})}, seed)
    booster._write(rows)
    return booster


def fit_second_order(
    train: DataFrame, schema: FeatureSchema, target: str, id_column: str, settings: Mapping[str, float] | None = None,
    validation: DataFrame | None = None, seed: int = 42, patience: int = PATIENCE, max_bins: int = MAX_BINS,
) -> Booster:
    """``num_round`` rounds, fewer if the validation PR-AUC stops rising; ``.model()`` is cut at the best round."""
    booster = start_boosting(train, schema, target, id_column, settings, validation, seed, max_bins=max_bins)
    booster.grow(int(booster.settings["num_round"]), validation is not None, patience if validation is not None else None)
    booster.close()
    return booster
