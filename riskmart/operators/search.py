"""Seeded random search over boosting settings, scored on the fixed validation split."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession

from ..session import compiled_methods, materialise
from .boosting import PATIENCE, Booster, BoostedTrees, start_boosting
from .modeling import FeatureSchema, encoded_rows, fit_encoder, fit_trees, most_levels
from .ranking import ranking_metrics

# Search ranges as (low, high, scale), number of trials, trials run at once.
SEARCH_RANGES = {
    "max_depth": (3, 8, "integer"),
    "num_round": (100, 1000, "integer"),
    "eta": (0.01, 0.3, "log"),
    "subsample": (0.6, 1.0, "linear"),
    "colsample_bytree": (0.6, 1.0, "linear"),
    "min_child_weight": (1, 10, "linear"),
    "lambda": (0, 10, "linear"),
}
MAX_TRIALS = 25
MAX_PARALLEL = 4


def draw_settings(n: int, seed: int = 42, ranges: dict | None = None) -> list[dict[str, float]]:
    """``n`` parameter sets; the same for the same seed."""
    source, drawn = random.Random(seed), []
    for _ in range(n):
        settings: dict[str, float] = {}
        for name, (low, high, scale) in (ranges or SEARCH_RANGES).items():
            if scale == "integer":
                settings[name] = source.randint(int(low), int(high))
            elif scale == "log":
                settings[name] = math.exp(source.uniform(math.log(low), math.log(high)))
            else:
                settings[name] = source.uniform(low, high)
        drawn.append(settings)
    return drawn


def random_search(
    train: DataFrame, validation: DataFrame, schema: FeatureSchema, target: str, trials: int = MAX_TRIALS,
    parallelism: int = MAX_PARALLEL, seed: int = 42, ranges: dict | None = None,
) -> tuple[DataFrame, dict[str, float]]:
    """Trial table ``trial, <settings>, pr_auc`` and the best settings by validation PR-AUC.

    ``lambda`` is drawn and reported for completeness; MLlib's trees have no such penalty.
    """
    spark: SparkSession = train.sparkSession
    fitted = fit_encoder(train, schema)
    rows = materialise(encoded_rows(fitted, train, target, validation), "encoded")  # encoded once for all trials
    held_out = rows.where("_validation")

    def run(numbered: tuple[int, dict[str, float]]) -> tuple:
        i, settings = numbered
        trees = fit_trees(rows, target, most_levels(fitted), settings, stop_early=True, seed=seed)
        scored = trees.transform(held_out).select(target, vector_to_array("probability")[1].alias("_score"))
        pr_auc = ranking_metrics(scored, "_score", target).first()["pr_auc"]
        return (i, *[float(v) for v in settings.values()], pr_auc)

    drawn = draw_settings(trials, seed, ranges)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        results = list(pool.map(run, enumerate(drawn)))
    names = list(drawn[0])
    fields = ", ".join(["trial int", *[f"`{n}` double" for n in names], "pr_auc double"])
    best = max(results, key=lambda r: (r[-1] is not None, r[-1] or 0.0, -r[0]))
    return spark.createDataFrame(results, fields), dict(zip(names, best[1:-1]))


# Rounds after each rung, and the share of trials that goes on.
RUNGS = (25, 75, 225)
SURVIVORS = 1 / 3


def halving_search(
    train: DataFrame, validation: DataFrame, schema: FeatureSchema, target: str, id_column: str, trials: int = MAX_TRIALS,
    rungs: Sequence[int] = RUNGS, parallelism: int = MAX_PARALLEL, seed: int = 42, ranges: dict | None = None, patience: int = PATIENCE,
) -> tuple[DataFrame, BoostedTrees]:
    """Successive halving over second-order boosting: the trial table and the winner, refitted at its settings.

    All trials grow to the first rung; the best third by validation PR-AUC go on from their margins to the next one.
    Columns are binned and the binned rows written once for all trials and the refit. Train and validation must not share an entity (see the split operators). The table
    has a row per trial: ``trial, <settings>, rounds, pr_auc, best_rounds, rung, won``. The refit runs the winner's settings anew,
    up to its drawn number of rounds, with early stopping.
    """
    spark = train.sparkSession
    drawn = draw_settings(trials, seed, ranges)
    shared = start_boosting(train, schema, target, id_column, None, validation, seed)
    alive: dict[int, Booster] = {}
    results: dict[int, tuple] = {}

    def grow(number: int, rung: int, rounds: int) -> None:
        if number not in alive:
            alive[number] = shared.start_anew(drawn[number])
        booster = alive[number]
        booster.grow(min(rounds, int(drawn[number]["num_round"])) - len(booster.trees), patience=patience)
        results[number] = (len(booster.trees), max(booster.quality, default=0.0), booster.best_round() + 1 if booster.quality else 0, rung)

    going = list(range(trials))
    with compiled_methods(spark):  # set here, since the threads below share the session
        for rung, rounds in enumerate(rungs, 1):
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                list(pool.map(lambda number: grow(number, rung, rounds), going))
            going.sort(key=lambda number: (-results[number][1], number))
            stay = going[: max(1, math.ceil(len(going) * SURVIVORS))]
            for number in set(going) - set(stay):
                alive.pop(number).close()
            going = stay
        winner = going[0]
        for booster in alive.values():
            booster.close()
        refit = shared.start_anew(drawn[winner])
        refit.grow(int(refit.settings["num_round"]), patience=patience)
    refit.close()
    shared.close()
    model = refit.model()
    names = list(drawn[0])
    fields = ", ".join(["trial int", *[f"`{n}` double" for n in names], "rounds int, pr_auc double, best_rounds int, rung int, won boolean"])
    rows = [(i, *[float(v) for v in drawn[i].values()], *results[i], i == winner) for i in range(trials)]
    return spark.createDataFrame(rows, fields), model
