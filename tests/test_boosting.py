from __future__ import annotations

import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from riskmart.operators import attribution, boosting, dictionaries, search
from riskmart.operators.modeling import FeatureSchema
from riskmart.plans import evaluation as jobs

KIND = "id long, y int, a string, b string, x double, z long"
SCHEMA = FeatureSchema(("a", "b"), ("x", "z"))
PLAIN = {"subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 0.0, "lambda": 0.0}


def rows(seed, n=200, levels=8):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, x = rng.choice([None, *(f"l{j}" for j in range(levels))]), rng.choice([None, float("nan"), 0.5, 1.5, 2.5, 3.5])
        pull = (zlib.crc32(f"{a}/{seed}".encode()) % 5 - 2) + (0 if x is None or x != x else x - 2)
        out.append((i, int(rng.random() < 1 / (1 + math.exp(-pull))), a, rng.choice("uvw"), x, rng.randrange(4)))
    return out


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(rows(1), KIND)
    return df, boosting.fit_second_order(df, SCHEMA, "y", "id", {**PLAIN, "num_round": 2, "max_depth": 3, "lambda": 1.0}).model()


def gain(gl, hl, g, h):
    return gl**2 / hl + (g - gl) ** 2 / (h - hl) - g**2 / h


def test_level_sets_equal_all_subsets(spark):
    data = [r for r in rows(2) if r[2] is not None]
    df = spark.createDataFrame(data, KIND)
    tree = boosting.fit_second_order(df, FeatureSchema(("a",), ()), "y", "id", {**PLAIN, "num_round": 1, "max_depth": 1}).model().trees[0]
    levels = sorted({r[2] for r in data})
    sums = {level: (sum(0.5 - r[1] for r in data if r[2] == level), sum(0.25 for r in data if r[2] == level)) for level in levels}
    g, h = (sum(s[i] for s in sums.values()) for i in (0, 1))
    best = max(
        gain(sum(sums[x][0] for x in subset), sum(sums[x][1] for x in subset), g, h)
        for n in range(1, len(levels)) for subset in itertools.combinations(levels, n)
    )
    left = [x for i, x in enumerate(levels) if tree[1].words[0] >> i & 1]
    assert gain(sum(sums[x][0] for x in left), sum(sums[x][1] for x in left), g, h) == pytest.approx(best)
    assert tree[2].weight == pytest.approx(-0.1 * sum(sums[x][0] for x in left) / sum(sums[x][1] for x in left))


def test_missing_rows_go_to_the_better_side(spark):
    data = [(i, int(i % 3 == 0 or i < 40), None, "u", None if i < 40 else float(i % 2), 0) for i in range(120)]
    tree = boosting.fit_second_order(spark.createDataFrame(data, KIND), FeatureSchema((), ("x",)), "y", "id", {**PLAIN, "num_round": 1, "max_depth": 1}).model().trees[0]
    g = {side: sum(0.5 - r[1] for r in data if r[4] == side) for side in (None, 0.0, 1.0)}
    h = {side: 0.25 * sum(r[4] == side for r in data) for side in (None, 0.0, 1.0)}
    tried = {
        (True, 1): gain(g[None] + g[0.0], h[None] + h[0.0], sum(g.values()), sum(h.values())),
        (False, 1): gain(g[0.0], h[0.0], sum(g.values()), sum(h.values())),
        (False, 2): gain(g[0.0] + g[1.0], h[0.0] + h[1.0], sum(g.values()), sum(h.values())),  # all present ones left
    }
    node = tree[1]
    assert tried[(node.missing_left, node.cut)] == pytest.approx(max(tried.values()))


def test_many_levels_need_no_bins(spark):
    data = [(i, int(i % 7 < 2), f"level{i % 5000}", "u", 1.0, 0) for i in range(10_000)]
    df = spark.createDataFrame(data, KIND)
    found = boosting.fit_second_order(df, FeatureSchema(("a",), ()), "y", "id", {**PLAIN, "num_round": 1, "max_depth": 1}).model()
    left = {r.id for r in found.add_margin(df).where("margin > 0").collect()}
    rates = {}
    for i, y, a, *_ in data:
        rates.setdefault(a, []).append(y)
    assert left == {i for i, _, a, *_ in data if sum(rates[a]) / len(rates[a]) > 0.5} or left == {i for i, _, a, *_ in data if sum(rates[a]) > 0}


def test_quantile_bins(spark):
    data = [(i, int(i > 600), None, "u", i / 7, 0) for i in range(1000)]
    df = spark.createDataFrame(data, KIND)
    binning = boosting.fit_binning(df, FeatureSchema((), ("x",)), max_bins=16)
    assert 8 <= len(binning.cuts["x"]) < 16
    binned = {r.id: r._b0 for r in binning.apply(df).collect()}
    assert all(binned[i] == sum(c <= i / 7 for c in binning.cuts["x"]) for i in range(1000))


def test_saved_trees_score_alike(spark, model, tmp_path):
    df, fitted = model
    fitted.save(spark, str(tmp_path))
    other = spark.createDataFrame([(1000, 0, "never seen", None, None, None), (1001, 1, None, "u", 99.0, -5)], KIND)
    loaded = boosting.load_boosted_trees(spark, str(tmp_path))
    both = df.unionByName(other)
    assert sorted(map(str, fitted.add_score(both).collect())) == sorted(map(str, loaded.add_score(both).collect()))
    assert fitted.add_score(both).columns == [*both.columns, "score"]


def test_stops_after_patience_and_cuts_at_the_best_round(spark, monkeypatch):
    df = spark.createDataFrame(rows(3, 80), KIND)
    values = iter([0.3, 0.5, 0.4, 0.45, 0.6, 0.5, 0.5, 0.6, 0.9])  # dips, recovers within three rounds, then does not

    class Found:
        def first(self):
            return {"pr_auc": next(values)}

    monkeypatch.setattr(boosting, "ranking_metrics", lambda *_: Found())
    settings = {**PLAIN, "num_round": 9, "max_depth": 1}
    booster = boosting.fit_second_order(df, SCHEMA, "y", "id", settings, df, patience=3)
    assert (len(booster.trees), booster.best_round(), len(booster.model().trees)) == (8, 4, 5)


def test_empty_and_constant_inputs(spark):
    none = spark.createDataFrame([], KIND)
    assert [vars(n) for t in boosting.fit_second_order(none, SCHEMA, "y", "id", {"num_round": 1}).model().trees for n in t.values()][0]["weight"] == 0
    same = spark.createDataFrame([(i, 1, "l", "u", 1.0, 1) for i in range(5)], KIND)
    tree = boosting.fit_second_order(same, SCHEMA, "y", "id", {**PLAIN, "num_round": 1}).model().trees[0]
    assert list(tree) == [1] and tree[1].weight == pytest.approx(0.1 * 2.5 / 1.25)


def coalition_value(tree, bins, known, number=1):
    """Expected leaf weight when only the known features are followed."""
    node = tree[number]
    if node.feature is None:
        return node.weight
    if node.feature in known:
        b = bins[node.feature]
        left = node.missing_left if b is None else (b < node.cut if node.words is None else node.words[b // boosting.WORD] >> b % boosting.WORD & 1)
        return coalition_value(tree, bins, known, 2 * number + (not left))
    return sum(tree[c].cover / node.cover * coalition_value(tree, bins, known, c) for c in (2 * number, 2 * number + 1))


def test_contributions_equal_enumeration(spark, model):
    df, fitted = model
    sample = df.limit(25)
    found = {(r.id, r.feature): r.contribution for r in attribution.path_contributions(fitted, sample, "id").collect()}
    names, every = SCHEMA.order, range(4)
    for row in fitted.binning.apply(sample).withColumn("m", fitted.margin()).collect():
        bins = [row[b] for b in fitted.binning.bins]
        total = attribution.expected_margin(fitted)
        for i in every:
            rest = [j for j in every if j != i]
            exact = sum(
                math.factorial(len(s)) * math.factorial(3 - len(s)) / math.factorial(4)
                * sum(coalition_value(t, bins, {*s, i}) - coalition_value(t, bins, set(s)) for t in fitted.trees)
                for n in range(4) for s in itertools.combinations(rest, n)
            )
            assert found.get((row.id, names[i]), 0.0) == pytest.approx(exact, abs=1e-12)
            total += exact
        assert total == pytest.approx(row.m)


def test_tree_attribution_names_every_feature(spark, model):
    df, fitted = model
    found = attribution.tree_attribution(fitted, df, "id", n=50).collect()
    assert sorted(r.feature for r in found) == sorted(SCHEMA.order) and {r.method for r in found} == {"tree_path"}
    assert [r.mean_abs for r in found] == sorted((r.mean_abs for r in found), reverse=True) and found[0].mean_abs > 0


def test_halving_refits_the_winner(spark):
    train, validation = spark.createDataFrame(rows(5, 150), KIND), spark.createDataFrame(rows(6, 80), KIND)
    ranges = {**search.SEARCH_RANGES, "max_depth": (1, 2, "integer"), "num_round": (2, 4, "integer")}
    trials, fitted = search.halving_search(train, validation, SCHEMA, "y", "id", trials=4, rungs=(1, 3), ranges=ranges)
    found = sorted(trials.collect(), key=lambda r: r.trial)
    assert [r.rung for r in found].count(2) == 2 and [r.rung for r in found].count(1) == 2
    winner = next(r for r in found if r.won)
    assert winner.pr_auc == max(r.pr_auc for r in found if r.rung == 2)
    assert 1 <= len(fitted.trees) <= winner.num_round and fitted.add_score(validation).count() == 80


def test_dictionary_of_many_levels(spark, monkeypatch):
    df = spark.range(30_000).select(F.format_string("v%06d", "id").alias("c"), F.when(F.col("id") % 3 > 0, "hot").alias("d"))
    levels = dictionaries.fit_dictionary(df, ["c", "d"])
    assert dictionaries.level_counts(levels) == {"c": 30_000, "d": 1}
    monkeypatch.setattr(dictionaries, "FEW_LEVELS", 10)
    encoded = dictionaries.encode_levels(df, levels, {"c": "k", "d": "l"})
    assert encoded.where("k <> cast(substr(c, 2) as int) OR (l = 0) <> (d IS NOT NULL)").count() == 0 and encoded.count() == 30_000
    unseen = spark.createDataFrame([("new", None), ("v000001", "hot")], "c string, d string")
    assert sorted((r.k, r.l) for r in dictionaries.encode_levels(unseen, levels, {"c": "k", "d": "l"}).collect() if r.k is not None) == [(1, 0)]


def test_saved_dictionary(spark, tmp_path):
    df = spark.createDataFrame([("b", "1"), ("a", None), ("ä", "1"), ("B", "0")], "`odd name` string, e string")
    levels = dictionaries.fit_dictionary(df, ["odd name", "e"])
    dictionaries.save_dictionary(levels, str(tmp_path))
    loaded = dictionaries.load_dictionary(spark, str(tmp_path))
    assert sorted(loaded.collect()) == sorted(levels.collect())
    assert sorted(r.value for r in loaded.where("level = 0").collect()) == ["0", "B"]


def test_jobs_take_second_order_trees(spark):
    data = [r for r in rows(7, 300) if r[4] is not None and r[4] == r[4]]
    df, few = spark.createDataFrame(data, KIND), {**PLAIN, "num_round": 1, "max_depth": 1}
    models = jobs.fit_models(df, df, SCHEMA, "y", few, id_column="id")
    assert isinstance(models.boosted, boosting.BoostedTrees) and len(models.boosted.trees) == 1
    found = attribution.ablate(df, df, SCHEMA.order, "b", "y", params=few, id_column="id").collect()
    assert {r.variant for r in found} == {"with", "without"} and {r["value"] for r in found} == {"u", "v", "w"}
    assert all(0 <= r.test_pr_auc <= 1 for r in found)


def binned(spark, seed=8):
    df = spark.createDataFrame(rows(seed), KIND)
    return boosting.start_boosting(df, SCHEMA, "y", "id", {**PLAIN, "num_round": 2, "max_depth": 2, "lambda": 1.0})


def test_sums_in_arrays_equal_brute_force(spark, monkeypatch):
    booster = binned(spark)
    features = list(zip(range(4), booster.binning.bins, booster.binning.sizes()))
    at = booster.rows.select("*", F.expr("cast(_id % 3 * 2 + 1 AS int) AS node"), F.expr("_id / 7 AS g"), F.expr("_y + 1 AS h"))
    at = at.where("node <> 5").repartition(3)
    wanted = {}
    for r in at.collect():
        for i, name, _ in features:
            g, h = wanted.get((r.node, i, r[name]), (0, 0))
            wanted[r.node, i, r[name]] = (g + r.g, h + r.h)
    assert any(b is None for _, _, b in wanted)
    monkeypatch.setattr(boosting, "ARRAY_ROWS", 20)
    for cells in (1 << 17, 12, 0):  # all features in arrays, some, none
        monkeypatch.setattr(boosting, "ARRAY_CELLS", cells)
        found = {(r.node, r.feature, r.bin): (r.g, r.h) for r in boosting._bin_sums(at, features, [1, 3]).collect()}
        assert found.keys() == wanted.keys()
        assert all(found[k] == pytest.approx(wanted[k]) for k in wanted)


def test_a_level_reads_the_rows_once(spark):
    booster = binned(spark)
    read, n = spark.sparkContext.accumulator(0), booster.rows.count()

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    booster.rows = booster.rows.mapInArrow(count, booster.rows.schema)
    tree = booster._grow_tree()
    assert max(tree) > 3 and read.value == 2 * n


def test_unwritten_trees_count(spark, monkeypatch):
    trees = []
    for limit in (0, 1000):
        monkeypatch.setattr(boosting, "UNWRITTEN", limit)
        booster = binned(spark)
        first = booster.path
        booster.grow(2, watch=False)
        assert (booster.path == first) == (limit == 1000)
        margins = {r._id: r._margin for r in booster.scored().collect()}
        assert margins == pytest.approx({r.id: r.margin for r in booster.model().add_margin(spark.createDataFrame(rows(8), KIND)).collect()})
        trees.append([{n: vars(node) for n, node in t.items()} for t in booster.trees])
        booster.close()
    assert str(trees[0]) == str(trees[1])


def test_halving_bins_the_rows_once(spark, monkeypatch):
    train, validation = spark.createDataFrame(rows(5, 60), KIND), spark.createDataFrame(rows(6, 40), KIND)
    calls, started = [], []
    apply, start = boosting.Binning.apply, boosting.start_boosting
    monkeypatch.setattr(boosting.Binning, "apply", lambda self, df: calls.append(1) or apply(self, df))
    monkeypatch.setattr(search, "start_boosting", lambda *a: started.append(start(*a)) or started[-1])
    ranges = {**search.SEARCH_RANGES, "max_depth": (1, 1, "integer"), "num_round": (1, 2, "integer")}
    trials, fitted = search.halving_search(train, validation, SCHEMA, "y", "id", trials=3, rungs=(1, 2), ranges=ranges)
    assert len(calls) == 1 and started[0].path == ""  # the shared rows are gone
    winner = next(r for r in trials.collect() if r.won)
    drawn = search.draw_settings(3, ranges=ranges)[winner.trial]
    alone = boosting.fit_second_order(train, SCHEMA, "y", "id", drawn, validation).model()
    assert str([{n: vars(x) for n, x in t.items()} for t in alone.trees]) == str([{n: vars(x) for n, x in t.items()} for t in fitted.trees])
