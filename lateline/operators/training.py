"""Classifiers over one feature vector, with balanced weights and stored feature order."""

from __future__ import annotations

import json
import logging
import math
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lateline.functions.expressions import quoted
from lateline.operators.boosting import fit_boosting
from lateline.schema import SEED, TARGET
from lateline.session import kept, stage

logger = logging.getLogger(__name__)

# Parameters of each model.
PARAMS: dict[str, dict] = {
    "logistic_regression": {"C": 0.5, "max_iter": 2000},
    "random_forest": {"n_estimators": 200, "max_depth": 20, "min_samples_leaf": 2, "max_features": "sqrt"},
    "xgboost": {"n_estimators": 200, "max_depth": 8, "learning_rate": 0.05, "subsample": 0.8,
                "colsample_bytree": 0.8, "min_child_weight": 3, "gamma": 0.1, "patience": 10},
}
MODELS = list(PARAMS)
FEATURES, SCALED, LABEL, WEIGHT, STOP = "features", "scaled", "label", "weight", "held_out"
#: Rows of a part from which the rows of a fit are dealt out again, and about as many as a part then has.
PART_ROWS = 200_000


def assemble(df: DataFrame, features: Sequence[str], target: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The features in order as one vector, nulls as zero; a missing feature is an error."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"features missing from input: {missing}")
    values = F.array(*[F.coalesce(quoted(f).cast("double"), F.lit(0.0)) for f in features])
    columns = [quoted(c) for c in keep] + [array_to_vector(values).alias(FEATURES)]
    if target:
        columns.append(quoted(target).cast("double").alias(LABEL))
    return df.select(*columns)


def dealt(df: DataFrame) -> DataFrame:
    """The rows in parts of about ``PART_ROWS``, if they are in larger ones.

    Files of a few bytes a row make parts of millions of rows, which a fit would hold and read whole.
    """
    parts = df.select(F.spark_partition_id().alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.agg(F.max("n").alias("top"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("parts")).first()
    if (sizes["top"] or 0) <= PART_ROWS:
        return df
    number = max(sizes["parts"], -(-sizes["rows"] // PART_ROWS))
    return df.withColumn("_spot", F.monotonically_increasing_id()).repartition(number, "_spot").drop("_spot")


def weighted(df: DataFrame, scheme: str | None) -> DataFrame:
    """``balanced`` gives both classes half the total weight, ``positive`` lifts class 1 to class 0."""
    if scheme is None:
        return df.withColumn(WEIGHT, F.lit(1.0))
    counts = {r[LABEL]: r["n"] for r in df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).collect()}
    zero, one = counts.get(0.0, 0), counts.get(1.0, 0)
    if not zero or not one:
        return df.withColumn(WEIGHT, F.lit(1.0))
    total = zero + one
    pair = (total / (2.0 * zero), total / (2.0 * one)) if scheme == "balanced" else (1.0, zero / one)
    return df.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, pair[1]).otherwise(pair[0]))


#: Families that ``boosting`` fits, by their growth. The first starts from the usual settings of second-order
#: boosting, the other from those of best-first growth, where drawing rows is off unless a frequency is set.
HISTOGRAM = {"xgboost": {"growth": "level"},
             "leaf_wise": {"growth": "leaf", "num_leaves": 31, "min_child_samples": 20, "min_child_weight": 1e-3,
                           "reg_lambda": 0.0, "subsample_freq": 0}}


def estimator(kind: str, params: Mapping, rows: int, features_col: str):
    """MLlib estimator for a model family and its parameters."""
    common = {"featuresCol": features_col, "labelCol": LABEL, "weightCol": WEIGHT}
    if kind == "logistic_regression":
        # The penalty is per summed loss; MLlib's is per mean loss.
        return LogisticRegression(maxIter=params["max_iter"], tol=params.get("tol", 1e-4), regParam=1.0 / (params["C"] * max(rows, 1)),
                                  elasticNetParam=0.0, standardization=False, **common)
    if kind == "random_forest":
        return RandomForestClassifier(
            numTrees=params["n_estimators"], maxDepth=min(params["max_depth"], 30),
            minInstancesPerNode=params.get("min_samples_leaf", 1),
            featureSubsetStrategy=str(params.get("max_features", "sqrt")), seed=SEED, cacheNodeIds=True, **common)
    return GBTClassifier(
        maxIter=params["n_estimators"], maxDepth=min(params["max_depth"], 30), stepSize=params["learning_rate"],
        subsamplingRate=params.get("subsample", 1.0), featureSubsetStrategy=str(params.get("colsample_bytree", "all")),
        minInstancesPerNode=params.get("min_child_weight", 1), seed=SEED, cacheNodeIds=True, **common)

@dataclass
class TrainedModel:
    """A fitted pipeline with the feature order it expects."""

    name: str
    model: PipelineModel
    features: list[str]
    params: dict = field(default_factory=dict)
    seconds: float = 0.0

    def score(self, df: DataFrame, keep: Sequence[str] | None = None, target: str | None = None,
              probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        """Class-1 probability and class of each row, next to the ``keep`` columns."""
        keep = list(df.columns if keep is None else keep)
        ready = assemble(df, self.features, target, keep)
        scored = self.model.transform(ready)
        labels = [F.col(LABEL)] if target else []
        return scored.select(*[quoted(c) for c in keep], *labels,
                             vector_to_array("probability")[1].alias(probability),
                             F.col("prediction").cast("int").alias(prediction))

    def importance(self, spark: SparkSession) -> DataFrame:
        """(feature, importance, rank): tree importances or absolute coefficients."""
        last = self.model.stages[-1]
        values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
        values = [abs(float(v)) for v in values.toArray()]
        names = self.features if len(self.features) == len(values) else [f"feature_{i}" for i in range(len(values))]
        ordered = sorted(zip(names, values), key=lambda pair: (-pair[1], pair[0]))
        return spark.createDataFrame([(n, v, i + 1) for i, (n, v) in enumerate(ordered)],
                                     "feature string, importance double, rank int")

    def metadata(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.name, self.seconds, len(self.features), json.dumps(self.params), json.dumps(self.features))],
            "model string, training_seconds double, feature_count int, params string, features string")

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/pipeline")
        self.metadata(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TrainedModel:
        try:
            row = spark.read.parquet(f"{path}/metadata").first()
        except AnalysisException as problem:
            raise FileNotFoundError(f"no model in {path}") from problem
        return TrainedModel(row["model"], PipelineModel.load(f"{path}/pipeline"), json.loads(row["features"]),
                            json.loads(row["params"]), row["training_seconds"])


def fit_scaler(rows: DataFrame) -> StandardScalerModel:
    return StandardScaler(inputCol=FEATURES, outputCol=SCALED, withMean=True, withStd=True).fit(rows)


def fit_vectors(kind: str, params: Mapping, rows: DataFrame, scheme: str | None, scale: bool | StandardScalerModel,
                held_out: DataFrame | None = None) -> PipelineModel:
    """Fit on (features, label) rows; ``held_out`` rows only decide when boosting stops.

    ``scale`` says whether the features are scaled, or is a scaler fitted on the same rows before.
    """
    ready = weighted(rows, scheme)
    total = rows.count() if kind == "logistic_regression" else 0
    stages, column = [], FEATURES
    if scale:
        stages.append(fit_scaler(ready) if scale is True else scale)
        column = SCALED
    fit_on = ready
    if held_out is not None and kind not in HISTOGRAM:
        raise ValueError(f"{kind} doesn't stop early")
    if held_out is not None:
        fit_on = ready.withColumn(STOP, F.lit(False)).unionByName(
            held_out.withColumn(WEIGHT, F.lit(1.0)).withColumn(STOP, F.lit(True)))
    for step in stages:
        fit_on = step.transform(fit_on)
    if kind in HISTOGRAM:
        model = fit_boosting(fit_on, {"seed": SEED, **HISTOGRAM[kind], **params}, column, LABEL, WEIGHT, STOP if held_out is not None else None)
    else:
        model = estimator(kind, params, total, column).fit(fit_on)
    return PipelineModel([*stages, model])


class Trainer:
    """Fits the models of one training table, which is assembled and kept once."""

    SCHEMES = {"logistic_regression": "balanced", "random_forest": "balanced", "xgboost": "positive"}

    def __init__(self, train: DataFrame, features: Sequence[str] | None = None, validation: DataFrame | None = None,
                 target: str = TARGET, params: Mapping[str, Mapping] | None = None) -> None:
        numeric = [f.name for f in train.schema.fields if isinstance(f.dataType, NumericType) and f.name != target]
        self.features = list(features or numeric)
        self.spark = train.sparkSession
        self.rows = assemble(train, self.features, target)
        self.held_out = None if validation is None else assemble(validation, self.features, target)
        self.params = {name: {**base, **(params or {}).get(name, {})} for name, base in PARAMS.items()}

    def train(self, name: str, use_early_stopping: bool = False) -> TrainedModel:
        if name not in PARAMS:
            raise ValueError(f"unknown model {name!r}")
        with kept(dealt(self.rows)) as rows:
            return self._train(name, rows, use_early_stopping)

    def _train(self, name: str, rows: DataFrame, use_early_stopping: bool = False) -> TrainedModel:
        start = time.time()
        held_out = self.held_out if use_early_stopping and name == "xgboost" else None
        model = fit_vectors(name, self.params[name], rows, self.SCHEMES[name], name == "logistic_regression", held_out)
        return TrainedModel(name, model, self.features, self.params[name], time.time() - start)

    def train_all(self, names: Sequence[str] | None = None) -> dict[str, TrainedModel]:
        """Train the named models; an unknown name is skipped with a warning."""
        models = {}
        with kept(dealt(self.rows)) as rows:
            for name in names or MODELS:
                if name not in PARAMS:
                    logger.warning("unknown model %r skipped", name)
                    continue
                models[name] = self._train(name, rows)
        return models


def train_models(train: DataFrame, validation: DataFrame | None = None, models: Sequence[str] | None = None,
                 save_to: str | None = None, **options) -> dict[str, TrainedModel]:
    trained = Trainer(train, validation=validation, **options).train_all(models)
    if save_to:
        for name, model in trained.items():
            model.save(train.sparkSession, f"{save_to}/{name}")
    return trained


def scaler_parameters(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation the scaler uses, one row per feature."""
    model = fit_scaler(assemble(df, features))
    rows = [(f, float(m), float(s)) for f, m, s in zip(features, model.mean.toArray(), model.std.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, mean double, std double")


def folded(df: DataFrame, k: int, label: str = LABEL, column: str = "fold") -> DataFrame:
    """Fold of each row: its rank among the rows of its label, modulo ``k``, so folds differ by at most one row a label.

    The rows are written once, and ranked by their place in a part behind the rows of the parts before.
    Equal rows have ranks of their own; a null label is a label. No window holds more than one part.
    """
    if k < 2:
        raise ValueError("folds must be at least 2")
    own, place = F.col("__row"), F.col("__place")
    part = F.shiftrightunsigned(place, 33).alias("__part")
    written = stage(df.select(F.struct("*").alias("__row"), F.monotonically_increasing_id().alias("__place")), "folds")
    placed = written.select("__row", "__place", part, own[label].alias("__label"))
    counts = placed.groupBy("__part", "__label").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__label").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("__part").alias("__at"), F.col("__label").alias("__of"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__part", "__label").orderBy("__place"))
    ranked = placed.withColumn("__rank", inside).join(
        starts, (F.col("__part") == F.col("__at")) & F.col("__label").eqNullSafe(F.col("__of")))
    return ranked.select("__row.*", F.pmod(F.col("__start") + F.col("__rank") - 1, F.lit(k)).cast("int").alias(column))


def spread(values: Sequence[float]) -> tuple[float, float]:
    mean = sum(values) / len(values)
    return mean, math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
