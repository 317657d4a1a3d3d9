"""Run log, check results, summaries and fitted models."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.sources.tables import append

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("mode", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("n_rows", T.LongType(), True),
        T.StructField("n_rejected", T.LongType(), True),
        T.StructField("n_duplicates", T.LongType(), True),
        T.StructField("duration_ms", T.LongType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("at", T.TimestampType(), False),
    ]
)


def run_log_event(spark: SparkSession, **fields) -> DataFrame:
    """One status event of a run: RUNNING when it starts, OK or ERROR when it ends."""
    row = {f.name: fields.get(f.name) for f in RUN_LOG.fields if f.name != "at"}
    named = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in RUN_LOG.fields if f.name != "at"]
    return spark.range(1).select(*named, F.coalesce(F.lit(fields.get("at")).cast("timestamp"), F.current_timestamp()).alias("at"))


def run_log_state(events: DataFrame) -> DataFrame:
    """Current state of each run: its latest event, and when it started."""
    # A final status outranks RUNNING when both carry the same time.
    rank = F.struct("at", F.when(F.col("status") == "RUNNING", 0).otherwise(1))
    last = {c: F.max_by(c, rank).alias(c) for c in ("source", "mode", "status", "n_rows", "duration_ms", "message")}
    return events.groupBy("run_id").agg(
        *last.values(),
        F.min("at").alias("started_at"),
        F.max(F.when(F.col("status") != "RUNNING", F.col("at"))).alias("ended_at"),
    )


def log_results(results: DataFrame, path: str, as_of: Column | None = None) -> None:
    """Append check or audit results with their time."""
    append(results.withColumn("executed_at", as_of if as_of is not None else F.current_timestamp()), path)


def summary(sections: Mapping[str, DataFrame]) -> DataFrame:
    """One-row result frames as one long frame (section, key, value), values as text."""
    parts = []
    for section, frame in sections.items():
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in frame.columns)
        parts.append(
            frame.selectExpr(f"'{section}' AS section", f"stack({len(frame.columns)}, {pairs}) AS (key, value)")
        )
    return reduce(DataFrame.unionByName, parts)


def export_json(df: DataFrame, path: str) -> None:
    """A summary or report as JSON lines."""
    df.write.mode("overwrite").json(path)


def audit_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("status") == "OK").alias("n_ok"), F.count("*").alias("n_total"))


def save_model(spark: SparkSession, model: PipelineModel, threshold: float, path: str) -> None:
    """The fitted pipeline, and beside it the decision threshold."""
    model.write().overwrite().save(f"{path}/pipeline")
    spark.range(1).select(F.lit(float(threshold)).alias("threshold")).write.mode("overwrite").parquet(f"{path}/threshold")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, float]:
    threshold = spark.read.parquet(f"{path}/threshold").first()["threshold"]
    return PipelineModel.load(f"{path}/pipeline"), threshold


def model_run(spark: SparkSession, name: str, version: int, path: str, metrics: Mapping[str, float]) -> DataFrame:
    """One entry of the run-metrics log, a row per metric."""
    rows = [(name, version, path, k, float(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "name string, version int, path string, metric string, value double")


def production_model(runs: DataFrame) -> DataFrame:
    """For every model name the path of its highest version."""
    return runs.groupBy("name").agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"))
