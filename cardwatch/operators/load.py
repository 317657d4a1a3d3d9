"""Loading staged transactions into the star schema; batch jobs and streams share these functions."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schema
from cardwatch.operators.dimensions import Dims, fact_key
from cardwatch.sources.logs import run_log_event
from cardwatch.sources.tables import append, read_or_empty


class Loaded(NamedTuple):
    facts: DataFrame
    rejects: DataFrame


def fill_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Default value for every missing column and every NULL."""
    filled = {
        name: F.coalesce(F.col(name), value) if name in df.columns else value
        for name, value in defaults.items()
    }
    return df.withColumns(filled)


def staging_defaults(as_of: Column | None = None) -> dict[str, Column]:
    return {"ingested_at": as_of if as_of is not None else F.current_timestamp()}


def client_defaults(as_of: Column | None = None) -> dict[str, Column]:
    return {
        "status": F.lit("active"),
        "created_at": as_of if as_of is not None else F.current_timestamp(),
    }


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key. A map-side minimum, so a key with many copies costs one row per task."""
    others = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*others), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(best).select(key, "_row.*").select(*df.columns)


def unseen(batch: DataFrame, existing: DataFrame, key: str = "transaction_bk") -> DataFrame:
    """Rows of the batch whose key is not stored yet."""
    return batch.join(existing.select(key), key, "left_anti")


def stage_insert(batch: DataFrame, existing: DataFrame | None, order: Sequence[str] = ("event_ts",)) -> DataFrame:
    """Rows to append to staging: the first writer of a business key wins, replays add nothing."""
    once = first_per_key(batch, "transaction_bk", order)
    return once if existing is None else unseen(once, existing)


def pending(staging: DataFrame, fact: DataFrame | None = None, mode: str | None = None) -> DataFrame:
    """Staged rows that are not in the fact table yet, of one ingestion mode or of all."""
    chosen = staging if mode is None else staging.where(F.col("ingestion_mode") == mode)
    return chosen if fact is None else unseen(chosen, fact)


def processed(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged rows that have reached the fact table."""
    return staging.join(fact.select("transaction_bk"), "transaction_bk", "left_semi")


def resolve(rows: DataFrame, dims: Dims) -> DataFrame:
    """Dimension keys of staged rows: unknown clients drop out, unknown hours and channels get key 0.

    The client join carries no hint: Catalyst broadcasts the client table when its size permits, and
    adaptive execution splits the skewed keys of the shuffle join otherwise.
    """
    clients = dims.client.select("client_id", "client_key")
    hours = dims.time.select("time_key", F.col("hour_ts").alias("_hour"))
    channels = dims.channel.select("channel_key", "channel", "mcc_code")
    return (
        rows.join(clients, "client_id")
        .withColumn("_hour", F.date_trunc("hour", "event_ts"))
        .join(hours, "_hour", "left")
        .join(channels, ["channel", "mcc_code"], "left")
        .withColumns(
            {
                "time_key": F.coalesce("time_key", F.lit(schema.UNKNOWN_KEY)),
                "channel_key": F.coalesce("channel_key", F.lit(schema.UNKNOWN_KEY)),
                "currency": F.lit(schema.CURRENCY),
                "home_country": F.lit(schema.HOME_COUNTRY),
                "transaction_key": fact_key(),
            }
        )
        .drop("_hour")
    )


FACT_COLUMNS = [
    "transaction_key", "transaction_bk", "client_id", "client_key", "time_key", "channel_key", "event_ts",
    "amount", "currency", "tx_country", "home_country", "home_distance_km", "auth_method", "is_fraud",
    "fraud_type", "ingestion_mode", "created_at",
]


def load_facts(
    staging: DataFrame,
    dims: Dims,
    fact: DataFrame | None = None,
    mode: str | None = None,
    as_of: Column | None = None,
) -> Loaded:
    """New facts of the staged rows, and the rows whose client is unknown, which stay pending.

    Staging holds each business key once (`stage_insert`), so leaving out the keys already loaded makes
    the load idempotent.
    """
    todo = pending(staging, fact, mode)
    created = as_of if as_of is not None else F.current_timestamp()
    facts = resolve(todo, dims).withColumn("created_at", created).select(*FACT_COLUMNS)
    rejects = todo.join(dims.client.select("client_id"), "client_id", "left_anti")
    return Loaded(facts, rejects)


def complete_labels(fact: DataFrame, labels: DataFrame) -> DataFrame:
    """Fill labels that arrived later; a label that is already set stays.

    Of several labels for one transaction a fraud outranks a legitimate one.
    """
    late = labels.groupBy("transaction_bk").agg(F.max(F.struct("is_fraud", "fraud_type")).alias("_l"))
    late = late.select(
        "transaction_bk", F.col("_l.is_fraud").alias("_late"), F.col("_l.fraud_type").alias("_late_type")
    )
    open_case = F.col("is_fraud").isNull()
    return (
        fact.join(late, "transaction_bk", "left")
        .withColumns(
            {
                "fraud_type": F.when(open_case, F.col("_late_type")).otherwise(F.col("fraud_type")),
                "is_fraud": F.coalesce("is_fraud", "_late"),
            }
        )
        .drop("_late", "_late_type")
    )


def star(fact: DataFrame, dims: Dims) -> DataFrame:
    """Fact with its client, hour and channel. Unknown members are rows of the dimensions, so no fact is lost."""
    clients = dims.client.select("client_key", "segment", "net_income")
    hours = dims.time.select("time_key", "hour_ts", "hour", "dow", "day", "month", "is_weekend", "is_night")
    channels = dims.channel.select("channel_key", "channel")
    return fact.join(clients, "client_key").join(hours, "time_key").join(channels, "channel_key")


def labelled_transactions(fact: DataFrame, dims: Dims) -> DataFrame:
    """The labelled (batch) facts with the attributes that profiling and the models use."""
    return star(fact.where(F.col("ingestion_mode") == "batch"), dims).select(
        "transaction_bk", "client_id", "event_ts", "hour_ts",
        F.col("amount").cast("double").alias("amount"),
        F.col("home_distance_km").cast("double").alias("home_distance_km"),
        F.col("net_income").cast("double").alias("net_income"),
        "hour", "dow", "day", "month",
        F.col("is_weekend").cast("int").alias("is_weekend"),
        F.col("is_night").cast("int").alias("is_night"),
        "auth_method", "channel", "segment", "is_fraud", "fraud_type",
        (F.col("tx_country") != F.col("home_country")).alias("unusual_country"),
    )


def load_and_log(
    staging: DataFrame, dims: Dims, path: str, log_path: str, run_id: str, mode: str = "batch"
) -> None:
    """Append the new facts of a batch load to the fact table and its outcome to the run log."""
    spark = staging.sparkSession
    run = {"run_id": run_id, "source": "load", "mode": mode}
    began = time.monotonic()
    append(run_log_event(spark, **run, status="RUNNING"), log_path)
    try:
        stored = read_or_empty(spark, path, T.StructType([T.StructField("transaction_bk", T.StringType())]))
        todo = pending(staging, stored, mode).persist()
        loaded = load_facts(todo, dims)
        n_rows, n_rejected = todo.count(), loaded.rejects.count()
        append(loaded.facts, path)
        todo.unpersist()
        spent = int((time.monotonic() - began) * 1000)
        done = run_log_event(
            spark, **run, status="OK", n_rows=n_rows - n_rejected, n_rejected=n_rejected, duration_ms=spent
        )
    except Exception as exc:
        append(run_log_event(spark, **run, status="ERROR", message=str(exc)), log_path)
        raise
    append(done, log_path)
