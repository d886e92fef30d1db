"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

Equal vectors of a label are one point with a weight. Points of a label are cut into cells of bounded size by nested
pivots with shrinking radii; pairs of cells are followed level by level and dropped where their balls lie too far apart.
Each remaining pair of cells is one task: cover trees over both, traversed together. Tasks return the number of links of
each point and a spanning forest, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .components import connected_components
from .covertree import CoverTree, Links, traverse

THRESHOLD = 0.93
CELL = 8192  # points of a cell, the unit of work
PIVOTS = 64  # children of a cell that is split
SAMPLE = 1024  # points of a cell among which pivots are chosen; radii are measured over all points
LEVELS = 12  # rounds of splitting; cells that stay too large are then cut by hash, which loses pruning only
_POINT = "k1 bigint, k2 bigint, node bigint, weight bigint, vector array<double>, cell string"


def _unit(vectors) -> tuple[np.ndarray, np.ndarray]:
    raw = np.array(list(map(np.asarray, vectors)), np.float64)
    norms = np.sqrt((raw**2).sum(axis=1))
    return raw, raw / norms[:, None]


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x))


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components that are not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def choose_pivots(sample: pd.DataFrame) -> pd.DataFrame:
    """A net over a sample: the reach halves until enough points lie further apart than it."""
    _, points = _unit(sample["vector"])
    chosen, distance = [0], CoverTree.distances(points, points[0])
    reach = distance.max()
    while len(chosen) < PIVOTS and reach > 0:
        reach /= 2
        while len(chosen) < PIVOTS and distance.max() > reach:
            chosen.append(int(distance.argmax()))
            distance = np.minimum(distance, CoverTree.distances(points, points[chosen[-1]]))
        reach = min(reach, distance.max())
    return pd.DataFrame({"cell": sample["cell"].iloc[0], "number": np.arange(len(chosen)), "centre": [p.tolist() for p in points[chosen]]})


def _assign(points: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """Every point to its nearest pivot."""
    if not len(points):
        return pd.DataFrame({"k1": [], "k2": [], "node": [], "weight": [], "vector": [], "cell": [], "parent": [], "away": []})
    pivots = pivots.sort_values("number")
    _, own = _unit(points["vector"])
    centres = np.array(pivots["centre"].tolist())
    nearest = (own @ centres.T).argmax(axis=1)
    return points.drop(columns="chunk").assign(
        parent=points["cell"], cell=points["cell"] + "/" + pd.Series(pivots["number"].to_numpy()[nearest].astype(str), index=points.index),
        away=np.sqrt(((own - centres[nearest]) ** 2).sum(axis=1)),
    )


def _split(points: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points with the cells of one more level, and the new cells (parent, cell, centre, radius)."""
    marked = points.join(large, "cell", "left")
    sample = marked.filter(F.pmod("k1", "size") < SAMPLE).select("k1", "cell", "vector")
    pivots = materialise(sample.groupBy("cell").applyInPandas(choose_pivots, "cell string, number bigint, centre array<double>"), "cover-pivots")
    # A cell none of whose points falls into the sample keeps them together and is cut by hash in the end.
    known = large.join(pivots.select("cell").distinct(), "cell").withColumn("chunks", F.ceil(F.col("size") / CELL))
    dealt = points.join(known, "cell", "left")
    chunked = dealt.filter("chunks IS NOT NULL").withColumn("chunk", F.pmod("k2", "chunks")).select(*points.columns, "chunk")
    copies = pivots.join(known, "cell").select("cell", "number", "centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    assigned = materialise(
        chunked.groupBy("cell", "chunk").cogroup(copies.groupBy("cell", "chunk")).applyInPandas(_assign, f"{_POINT}, parent string, away double"),
        "cover-assigned",
    )
    cells = assigned.groupBy("parent", "cell").agg(F.max("away").alias("radius"))
    centres = pivots.select(F.col("cell").alias("parent"), F.concat_ws("/", "cell", F.col("number").cast("string")).alias("cell"), "centre")
    kept = dealt.filter("chunks IS NULL").select(*points.columns)
    return kept.unionByName(assigned.select(*points.columns)), cells.join(centres, ["parent", "cell"])


def _follow(pairs: DataFrame, cells: DataFrame, reach: float) -> DataFrame:
    """Pairs of cells one level down; cells that were not split stay, pairs of balls too far apart go."""
    for side in ("a", "b"):
        below = cells.select(F.col("parent").alias(side), *(F.col(c).alias(f"new_{c}") for c in ("cell", "centre", "radius")))
        pairs = pairs.join(below, side, "left").withColumns({
            f"next_{side}": F.coalesce("new_cell", side),
            f"centre_{side}": F.coalesce("new_centre", f"centre_{side}"),
            f"radius_{side}": F.coalesce("new_radius", f"radius_{side}"),
        }).drop("new_cell", "new_centre", "new_radius")
    apart = _distance(F.col("centre_a"), F.col("centre_b")) > F.col("radius_a") + F.col("radius_b") + reach + 1e-6
    once = (F.col("a") != F.col("b")) | (F.col("next_a") <= F.col("next_b"))
    return pairs.filter(once & ~F.coalesce(apart & (F.col("next_a") != F.col("next_b")), F.lit(False))).select(
        F.col("next_a").alias("a"), F.col("next_b").alias("b"), "centre_a", "radius_a", "centre_b", "radius_b"
    )


def _solve(threshold: float):
    reach = float(np.sqrt(2 - 2 * threshold))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "node", "k1", "k2"], ignore_index=True)
        raw, unit = _unit(rows["vector"])
        norms = np.sqrt((raw**2).sum(axis=1))
        links = Links(rows["weight"].to_numpy(np.float64))

        def linked(x, y):
            return (raw[x] * raw[y]).sum(axis=1) / (norms[x] * norms[y]) >= threshold

        left = int((rows["side"] == 0).sum())
        if (rows["a"] == rows["b"]).all():
            traverse(CoverTree(unit), None, linked, reach, links)
        else:
            traverse(CoverTree(unit[:left]), CoverTree(unit[left:]), linked, reach, links, left)
        anchors = np.array([links.root(i) for i in range(len(rows))], np.int64)
        nodes = rows["node"].to_numpy()
        found = rows[["k1", "k2", "node"]].assign(links=links.count.astype(np.int64), anchor=nodes[anchors] if len(rows) else nodes)
        return found[found["links"] > 0]

    return solve


def near_duplicates(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    threshold: float = THRESHOLD, cell: int = CELL,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id (smallest id reachable, itself included), kept.

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine in double precision is
    at least the threshold. Vectors that are null, zero or hold null or non-finite components link with nothing; so do
    rows without an id, whose component is null and which are not kept. Equal vectors and repeated rows link with each
    other. ``threshold`` must be above -1. Ids must be whole numbers. Other columns are not read.
    """
    vector = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"), F.col(label_column).cast("string").alias("label"))
    good = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    keys = {"k1": F.when(F.col("good"), F.xxhash64("label", "vector")), "k2": F.when(F.col("good"), F.xxhash64(F.lit(1), "vector", "label"))}
    points = (
        rows.filter("good").withColumns(keys).groupBy("k1", "k2", "label", "vector")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
        .select("k1", "k2", "node", "weight", "vector", F.concat_ws("|", F.size("vector").cast("string"), "label").alias("cell"))
    )
    points = weighted = materialise(points, "cover-points")
    none = F.lit(None)
    pairs = points.select("cell").distinct().select(
        F.col("cell").alias("a"), F.col("cell").alias("b"), none.cast("array<double>").alias("centre_a"), none.cast("double").alias("radius_a"),
        none.cast("array<double>").alias("centre_b"), none.cast("double").alias("radius_b"),
    )
    reach = float(np.sqrt(2 - 2 * threshold))
    for level in range(LEVELS + 1):
        large = materialise(points.groupBy("cell").agg(F.count("*").alias("size")).filter(F.col("size") > cell), "cover-large")
        if large.isEmpty():
            break
        if level < LEVELS:
            points, cells = _split(points, large)
            points, cells = materialise(points, "cover-points"), materialise(cells, "cover-cells")
        else:
            part = F.concat_ws("#", "cell", F.pmod("k2", F.ceil(F.col("size") / cell)).cast("string"))
            cut = points.join(large, "cell", "left").withColumn("part", F.when(F.col("size").isNotNull(), part).otherwise(F.col("cell")))
            cells = cut.filter("size IS NOT NULL").select(F.col("cell").alias("parent"), F.col("part").alias("cell"),
                none.cast("array<double>").alias("centre"), none.cast("double").alias("radius")).distinct()
            points = cut.select(*(c for c in points.columns if c != "cell"), F.col("part").alias("cell"))
        pairs = materialise(_follow(pairs, cells, reach), "cover-pairs")

    def sent(own: str, other: str, side: int) -> DataFrame:
        """Points of one cell of each pair, but for those that the other cell's ball rules out."""
        far = _distance(F.col("unit"), F.col(f"centre_{other}")) > F.col(f"radius_{other}") + reach + 1e-6
        return (
            with_unit.join(pairs.filter("a <> b") if side else pairs, F.col("cell") == F.col(own))
            .filter((F.col("a") == F.col("b")) | ~F.coalesce(far, F.lit(False)))
            .select("k1", "k2", "node", "weight", "vector", "a", "b", F.lit(side).alias("side"))
        )

    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    with_unit = points.withColumn("norm", norm).withColumn("unit", F.transform("vector", lambda x: x / F.col("norm")))
    found = materialise(
        sent("a", "b", 0).unionByName(sent("b", "a", 1)).groupBy("a", "b")
        .applyInPandas(_solve(threshold), "k1 bigint, k2 bigint, node bigint, links bigint, anchor bigint"),
        "cover-links",
    )
    counts = found.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "node", "anchor")
    named = weighted.join(counts, ["k1", "k2"], "left").join(roots, "node", "left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("component")
    )
    named = materialise(named, "cover-named")
    answered = rows.withColumns(keys).select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return answered.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
