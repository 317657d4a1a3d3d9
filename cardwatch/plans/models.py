"""Models fitted on the given tables: temporal split, preparation, and one fit per application."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.operators import learn, windows
from cardwatch.operators.oversample import oversample
from cardwatch.operators.prepare import Prep, apply_prep, fit_prep
from cardwatch.plans import inputs
from cardwatch.session import run_dir

TREES = 300


class Split(NamedTuple):
    train: DataFrame
    test: DataFrame
    prep: Prep


@lru_cache(maxsize=8)
def split(spark: SparkSession, src: str) -> Split:
    """First 80 % of the labelled rows for training, with the features prepared on them.

    The labelled rows are a table of the shared folder: the split, the preparation, the fits and all queries on either side
    read them again, and deriving them joins the facts with all dimensions.
    """
    labelled, folder = inputs.labelled(spark, src), run_dir(spark, "labelled")
    labelled.write.parquet(folder)
    rows = windows.split_positional(spark.read.schema(labelled.schema).parquet(folder))
    train, test = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")
    prep = fit_prep(train)
    return Split(apply_prep(train, prep), apply_prep(test, prep), prep)


@lru_cache(maxsize=8)
def logistic(spark: SparkSession, src: str) -> PipelineModel:
    data = split(spark, src)
    return learn.fit_logistic(data.train, data.prep.columns)


@lru_cache(maxsize=8)
def oversampled_logistic(spark: SparkSession, src: str) -> PipelineModel:
    data = split(spark, src)
    return learn.fit_logistic(oversample(data.train, data.prep.columns), data.prep.columns)


@lru_cache(maxsize=8)
def boosted(spark: SparkSession, src: str) -> PipelineModel:
    data = split(spark, src)
    return learn.fit_boosted(data.train, data.prep.columns, trees=TREES)


@lru_cache(maxsize=8)
def reconstruction(spark: SparkSession, src: str) -> PipelineModel:
    data = split(spark, src)
    return learn.fit_reconstruction(data.train, data.prep.columns)
