"""MLlib pipelines: encoders fitted on train only, logistic and boosted models, calibration, the saved bundle."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
)
from pyspark.ml.feature import (
    ElementwiseProduct, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import flag_at, platt
from ..session import materialise, shared_folder
from .cleaning import check_features
from .ranking import ranking_metrics

# Default settings of a single boosted fit.
DEFAULT_BOOSTING = {
    "max_depth": 6, "eta": 0.1, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 1.0,
    "num_round": 200, "scale_pos_weight": 1.0,
}


@dataclass(frozen=True)
class FeatureSchema:
    """Which columns a model reads, in frozen order: categorical first, then numeric."""

    categorical: tuple[str, ...]
    numeric: tuple[str, ...]

    @property
    def order(self) -> list[str]:
        return [*self.categorical, *self.numeric]

    def to_dict(self) -> dict[str, list[str]]:
        return {"categorical_columns": list(self.categorical), "numeric_columns": list(self.numeric),
                "feature_order": self.order}


def feature_schema(df: DataFrame, features: Sequence[str], target: str) -> FeatureSchema:
    """Strings are categorical, everything else numeric."""
    check_features(features, target)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return FeatureSchema(tuple(c for c in features if c in text), tuple(c for c in features if c not in text))


def _typed_inputs(schema: FeatureSchema, null_level: str | None) -> SQLTransformer:
    """Saved with the pipeline: text columns as ``<c>__text`` (NULL as its own level if named), numbers as doubles."""
    def text(c: str) -> str:
        return f"coalesce(`{c}`, '{null_level}')" if null_level else f"`{c}`"

    parts = [f"{text(c)} AS `{c}__text`" for c in schema.categorical]
    parts += [f"CAST(`{c}` AS DOUBLE) AS `{c}__number`" for c in schema.numeric]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _indexer(schema: FeatureSchema) -> StringIndexer:
    """Levels from train in alphabetical order; NULL and unseen values share one extra level."""
    return StringIndexer(
        inputCols=[f"{c}__text" for c in schema.categorical], outputCols=[f"{c}__level" for c in schema.categorical],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )


def encoder(schema: FeatureSchema) -> Pipeline:
    """Train-fitted category levels and double numerics in one vector, NULL numbers as NaN."""
    levels = [f"{c}__level" for c in schema.categorical]
    numbers = [f"{c}__number" for c in schema.numeric]
    stages = [_typed_inputs(schema, None)] + ([_indexer(schema)] if levels else [])
    stages.append(VectorAssembler(inputCols=[*levels, *numbers], outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def category_levels(model: PipelineModel) -> dict[str, list[str]]:
    """Learned levels per categorical column."""
    found: dict[str, list[str]] = {}
    for stage in model.stages:
        if stage.__class__.__name__ == "StringIndexerModel":
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                found[column.removesuffix("__text")] = list(labels)
    return found


def logistic_regression(n: int, target: str, c: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """L2-penalised fit whose optimum is that of ``C * sum(loss) + |w|^2 / 2`` with a free intercept."""
    return LogisticRegression(
        featuresCol="features", labelCol=target, regParam=1.0 / (c * n), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=1e-9,
    )


def fit_logistic(train: DataFrame, schema: FeatureSchema, target: str, c: float = 1.0) -> PipelineModel:
    """One-hot categories, standardised numbers, logistic regression."""
    n = train.count()
    levels, slots = [f"{c_}__level" for c_ in schema.categorical], [f"{c_}__slots" for c_ in schema.categorical]
    stages = [_typed_inputs(schema, "Missing")]
    if levels:
        # The dropped last slot is the unknown level, so an unseen value becomes all zeros.
        stages += [_indexer(schema), OneHotEncoder(inputCols=levels, outputCols=slots, dropLast=True)]
    inputs = list(slots)
    if schema.numeric:
        # The scaler divides by the sample deviation; the factor turns that into the population deviation.
        factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        stages += [
            VectorAssembler(inputCols=[f"{c_}__number" for c_ in schema.numeric], outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
            ElementwiseProduct(inputCol="scaled", outputCol="standardised",
                               scalingVec=Vectors.dense([factor] * len(schema.numeric))),
        ]
        inputs.append("standardised")
    stages += [VectorAssembler(inputCols=inputs, outputCol="features"), logistic_regression(n, target, c)]
    return Pipeline(stages=stages).fit(train)


def fit_plain_logistic(train: DataFrame, columns: Sequence[str], target: str, c: float = 1.0) -> PipelineModel:
    """Logistic regression on a few unscaled columns.

    Rows with equal columns and label are counted first and weigh that much, so the iterations read cells, not rows; the
    optimum is the same.
    """
    cells = train.groupBy(*columns, target).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    cells = materialise(cells, "logistic-cells")
    n = cells.agg(F.sum("_weight")).first()[0] or 0
    assembled = VectorAssembler(inputCols=list(columns), outputCol="features")
    learner = logistic_regression(n, target, c).setWeightCol("_weight")
    return Pipeline(stages=[assembled, learner]).fit(cells)


def coefficients(model: PipelineModel) -> tuple[list[float], float]:
    fitted: LogisticRegressionModel = model.stages[-1]
    return [float(w) for w in fitted.coefficients], float(fitted.intercept)


def fit_encoder(train: DataFrame, schema: FeatureSchema) -> PipelineModel:
    """Encoder fitted on train. A tree learner holds a bin per level, so levels bound its memory, not a refusal here."""
    return encoder(schema).fit(train)


def most_levels(fitted_encoder: PipelineModel) -> int:
    return max([len(v) for v in category_levels(fitted_encoder).values()] or [0])


def encoded_rows(
    fitted_encoder: PipelineModel, train: DataFrame, target: str, validation: DataFrame | None = None
) -> DataFrame:
    """``features, target, _validation`` of both splits."""
    rows = train.withColumn("_validation", F.lit(False))
    if validation is not None:
        rows = rows.unionByName(validation.withColumn("_validation", F.lit(True)))
    return fitted_encoder.transform(rows).select("features", target, "_validation")


def fit_trees(
    rows: DataFrame, target: str, levels: int, params: Mapping[str, float] | None = None, stop_early: bool = False,
    seed: int = 42, validation_tolerance: float = 0.001,
) -> GBTClassificationModel:
    """Gradient-boosted trees with logistic loss on encoded rows; checkpoints go to the shared folder."""
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    p = {**DEFAULT_BOOSTING, **(params or {})}
    weight = F.when(F.col(target) == 1, F.lit(float(p["scale_pos_weight"]))).otherwise(F.lit(1.0))
    trees = GBTClassifier(
        featuresCol="features", labelCol=target, weightCol="_weight", lossType="logistic", seed=seed,
        maxDepth=int(p["max_depth"]), stepSize=float(p["eta"]), maxIter=int(p["num_round"]),
        subsamplingRate=float(p["subsample"]), featureSubsetStrategy=str(float(p["colsample_bytree"])),
        minInstancesPerNode=max(1, round(p["min_child_weight"])), maxBins=max(32, levels + 2),
        validationTol=validation_tolerance, checkpointInterval=10, cacheNodeIds=True,
    )
    if stop_early:
        trees = trees.setValidationIndicatorCol("_validation")
    return trees.fit(rows.withColumn("_weight", weight))


def fit_boosted(
    train: DataFrame, schema: FeatureSchema, target: str, params: Mapping[str, float] | None = None,
    validation: DataFrame | None = None, seed: int = 42, validation_tolerance: float = 0.001,
) -> PipelineModel:
    """Encoder and trees; stops early on validation loss when a validation frame is given."""
    fitted = fit_encoder(train, schema)
    rows = encoded_rows(fitted, train, target, validation)
    trees = fit_trees(rows, target, most_levels(fitted), params, validation is not None, seed, validation_tolerance)
    return PipelineModel(stages=[*fitted.stages, trees])


def add_score(df: DataFrame, model, output: str = "score") -> DataFrame:
    """Input columns plus the positive-class probability; identifiers ride along unread.

    ``model`` is a pipeline or anything that adds scores itself, as second-order trees do.
    """
    if not isinstance(model, PipelineModel):
        return model.add_score(df, output)
    scored = model.transform(df).withColumn(output, vector_to_array("probability")[1])
    return scored.select(*df.columns, output)


def fit_platt(df: DataFrame, score: str, label: str) -> tuple[float, float]:
    """Slope and offset of the one-column logistic calibration, fitted on probabilities."""
    rows = df.select(F.col(score).cast("double").alias("_score"), F.col(label).alias("_label"))
    weights, intercept = coefficients(fit_plain_logistic(rows, ["_score"], "_label"))
    return weights[0], intercept


def calibration_report(df: DataFrame, raw: str, calibrated: str, label: str) -> DataFrame:
    """ROC-AUC and Brier score before and after, one row each."""
    pairs = F.array(F.struct(F.lit("uncalibrated").alias("stage"), F.col(raw).alias("score")),
                    F.struct(F.lit("calibrated").alias("stage"), F.col(calibrated).alias("score")))
    long = df.select(F.col(label), F.explode(pairs).alias("p")).select(label, "p.stage", "p.score")
    return ranking_metrics(long, "score", label, ["stage"]).select("stage", "roc_auc", "brier_score")


# --- the deployable unit ----------------------------------------------------------------------------------------

BUNDLE_PARTS = ["calibrator", "threshold", "feature_schema"]


@dataclass(frozen=True)
class Bundle:
    """Model, calibration, frozen threshold and feature order; scored and shipped together."""

    model: object
    calibrator: dict
    threshold: dict
    feature_schema: dict

    def score(self, df: DataFrame, id_column: str, keep: Sequence[str] = ()) -> DataFrame:
        """``id, keep..., probability, prediction`` through the frozen chain."""
        if id_column in self.feature_schema["feature_order"]:
            raise ValueError(f"{id_column} is a model input")
        df.select(*[F.col(f"`{c}`") for c in self.feature_schema["feature_order"]])  # missing column: analysis error
        raw = add_score(df, self.model, "_raw")
        probability = platt(F.col("_raw"), self.calibrator["a"], self.calibrator["b"])
        scored = raw.withColumn("probability", probability)
        return scored.select(id_column, *keep, "probability",
                             flag_at(F.col("probability"), self.threshold["threshold"]).alias("prediction"))


def _write_json(spark: SparkSession, path: str, content: dict) -> None:
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def save_bundle(
    spark: SparkSession, path: str, model, schema: FeatureSchema, a: float, b: float,
    threshold: float, alert_fraction: float, frozen_at: str,
) -> None:
    pipeline = isinstance(model, PipelineModel)
    if pipeline:
        model.write().overwrite().save(f"{path}/model")
    else:
        model.save(spark, f"{path}/model")
    _write_json(spark, f"{path}/calibrator", {"a": a, "b": b})
    _write_json(spark, f"{path}/feature_schema", {**schema.to_dict(), "learner": "pipeline" if pipeline else "second_order"})
    _write_json(spark, f"{path}/threshold", {
        "threshold": threshold, "target_alert_fraction": alert_fraction, "selected_on": "validation",
        "frozen_at": frozen_at,
    })


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """All parts or nothing."""
    parts = {}
    for part in BUNDLE_PARTS:
        try:
            parts[part] = json.loads(spark.read.text(f"{path}/{part}").first()["value"])
        except AnalysisException as error:
            raise FileNotFoundError(f"bundle {path} lacks {part}") from error
    from .boosting import load_boosted_trees  # that module builds on this one

    load = {"pipeline": PipelineModel.load, "second_order": lambda at: load_boosted_trees(spark, at)}
    try:
        model = load[parts["feature_schema"].get("learner", "pipeline")](f"{path}/model")
    except Exception as error:  # the loader's error class depends on the file system
        raise FileNotFoundError(f"bundle {path} lacks its model") from error
    return Bundle(model=model, **parts)
