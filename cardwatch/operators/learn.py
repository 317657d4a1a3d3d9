"""Fitting and applying the models, which are Spark ML's."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.scalar import one_hot, standardised
from cardwatch.functions.spread import exact_quantiles
from cardwatch.operators.boosting import as_model, boost
from cardwatch.operators.prepare import Prep, with_weight


class Counts(NamedTuple):
    n: int
    frauds: int

    @property
    def ratio(self) -> float:
        """Legitimate rows per fraud."""
        if not self.frauds:
            raise ValueError("no positive row to learn from")
        return (self.n - self.frauds) / self.frauds


@contextmanager
def _labelled(train: DataFrame, inputs: Sequence[str], extra: Sequence[str] = ()) -> Iterator[tuple[DataFrame, Counts]]:
    """The labelled rows with their inputs, computed once and kept for all passes of a fit, and their numbers."""
    label = F.col("is_fraud").cast("double").alias("label")
    stored = train.where(F.col("is_fraud").isNotNull()).select(*inputs, *extra, "is_fraud", label).persist()
    try:
        counts = Counts(*stored.agg(F.count("*"), F.count_if("is_fraud")).first())
        yield _dealt(stored), counts
    finally:
        stored.unpersist()


def _fit(
    train: DataFrame,
    inputs: Sequence[str],
    classifier: Callable[[Counts], Estimator],
    fraud_weight: Callable[[Counts], float] | None = None,
) -> PipelineModel:
    """Assemble the inputs of the labelled rows and fit."""
    with _labelled(train, inputs) as (rows, counts):
        weighted = rows if fraud_weight is None else with_weight(rows, fraud_weight(counts))
        vector = VectorAssembler(inputCols=list(inputs), outputCol="features")
        return Pipeline(stages=[vector, classifier(counts)]).fit(weighted)


def _dealt(rows: DataFrame) -> DataFrame:
    """Stored rows in as many partitions as there are cores.

    Every iteration reads all partitions and each of its tasks answers the driver, so tasks and answers of a fit grow
    with the partitions. The learners keep the rows in their own form, and in these partitions.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    found = rows.rdd.getNumPartitions()
    return rows if found == cores else rows.coalesce(cores) if found > cores else rows.repartition(cores)


def _logistic(counts: Counts) -> LogisticRegression:
    """Unit L2 penalty on the summed loss, which is 1/n on Spark's mean loss."""
    return LogisticRegression(maxIter=1000, tol=1e-4, regParam=1.0 / counts.n, standardization=False)


def fit_logistic(train: DataFrame, inputs: Sequence[str]) -> PipelineModel:
    """Logistic regression without class weights."""
    return _fit(train, inputs, _logistic)


def fit_boosted(
    train: DataFrame,
    inputs: Sequence[str],
    trees: int = 300,
    step: float = 0.05,
    depth: int = 5,
    seed: int = 42,
    validation: str | None = None,
) -> PipelineModel:
    """Gradient-boosted trees; a fraud weighs as much as the legitimate rows per fraud."""
    extra = [validation] if validation else []
    with _labelled(train, inputs, extra) as (stored, counts):
        weights, spark = (1.0, float(counts.ratio)), train.sparkSession
        tops, layout = boost(stored.drop("label"), inputs, weights, trees, step, depth, validation)
        params = {"maxIter": trees, "stepSize": step, "maxDepth": depth, "weightCol": "weight", "seed": seed}
        if validation:
            params["validationIndicatorCol"] = validation
        model = as_model(spark, tops, layout, weights, step, params)
    return PipelineModel([VectorAssembler(inputCols=list(inputs), outputCol="features"), model])


def apply_model(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds `score`, the fraud probability."""
    scored = model.transform(df)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Impurity gain per input of a tree model, as (feature, importance)."""
    inputs, trees = model.stages[0].getInputCols(), model.stages[-1]
    rows = [(name, float(v)) for name, v in zip(inputs, trees.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_importances(spark: SparkSession, model: PipelineModel, k: int = 15) -> DataFrame:
    return importances(spark, model).orderBy(F.desc("importance"), "feature").limit(k)


def fit_reconstruction(train: DataFrame, inputs: Sequence[str], size: int = 3) -> PipelineModel:
    """Linear autoencoder with a `size`-unit bottleneck, fitted on legitimate rows only."""
    legit = train.where(~F.col("is_fraud")).select(*inputs)
    stages = [
        VectorAssembler(inputCols=list(inputs), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False),
        PCA(k=size, inputCol="centred", outputCol="code"),
    ]
    return Pipeline(stages=stages).fit(legit)


def reconstruction_error(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds `error`, the mean squared reconstruction error over the features.

    The components are orthonormal, so what the code does not hold is the difference of squared lengths.
    """
    def squares(vector: str):
        return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda acc, x: acc + x * x)

    size = F.size(vector_to_array("centred"))
    coded = model.transform(df)
    return coded.withColumn("error", F.greatest(squares("centred") - squares("code"), F.lit(0.0)) / size).drop(
        "features", "centred", "code"
    )


def anomaly_flags(errors: DataFrame, legit_train: DataFrame, q: float = 0.99) -> DataFrame:
    """Adds `flag`: error at or above the q-quantile of the legitimate training rows' errors."""
    limit = exact_quantiles(legit_train, "error", [q]).select("q_0").scalar()
    return errors.withColumn("flag", F.col("error") >= limit)


def flatten_sequences(
    seq: DataFrame,
    prep: Prep,
    length: int = 5,
    numeric: Sequence[str] = ("amount", "home_distance_km", "hour"),
) -> tuple[DataFrame, list[str]]:
    """Sequence steps as one column per step and field, with the client's segment and income."""
    encoded = {}
    for i in range(length):
        step = F.col("steps")[i]
        for c in numeric:
            mean, std = prep.scale[c]
            encoded[f"x{i}_{c}"] = (step[c].cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)
        for c in ("channel", "auth_method"):
            for v in prep.categories[c]:
                encoded[f"x{i}_{c}_{v}"] = F.coalesce((step[c] == F.lit(v)).cast("double"), F.lit(0.0))
    encoded |= {f"x_{n}": c for n, c in one_hot("segment", prep.categories["segment"]).items()}
    encoded["x_net_income"] = standardised("net_income", *prep.scale["net_income"])
    return seq.withColumns(encoded), list(encoded)


def fit_sequence_classifier(train: DataFrame, inputs: Sequence[str]) -> PipelineModel:
    """Classifier over flattened sequences; a fraud weighs the square root of the class ratio."""
    return _fit(
        train,
        inputs,
        lambda counts: _logistic(counts).setWeightCol("weight"),
        lambda counts: math.sqrt(counts.ratio),
    )
