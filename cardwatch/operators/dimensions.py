"""Dimension tables: calendar, surrogate keys and unknown members."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch import schema
from cardwatch.functions.scalar import calendar_parts


class Dims(NamedTuple):
    branch: DataFrame
    client: DataFrame
    time: DataFrame
    channel: DataFrame


def assign_keys(df: DataFrame, natural: Sequence[str], name: str) -> DataFrame:
    """Surrogate keys 1, 2, ... in the order of the natural key (0 stays free for the unknown member).

    Meant for dimensions of bounded size such as hours and channels: the numbering is one ordered pass.
    """
    return df.withColumn(name, F.row_number().over(Window.orderBy(*natural)))


def grow_keys(stored: DataFrame, members: DataFrame, natural: Sequence[str], name: str) -> DataFrame:
    """The stored members with the keys they have, and new members with keys above them, in their own order.

    Stored facts stay right when members are added. Meant for dimensions of bounded size, as `assign_keys` is.
    """
    fresh = members.select(*natural).distinct().join(stored, list(natural), "left_anti")
    top = stored.agg(F.coalesce(F.max(name), F.lit(0)).alias("top")).first()["top"]
    numbered = assign_keys(fresh, natural, name).withColumn(name, F.col(name) + F.lit(top))
    return stored.select(name, *natural).unionByName(numbered.select(name, *natural))


def fact_key(bk: str = "transaction_bk") -> Column:
    """Fact key that any executor derives from the business key alone, stable across reloads."""
    return F.xxhash64(bk)


def hours_between(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per hour of the closed range given by two columns."""
    return df.select(
        F.explode(
            F.sequence(F.date_trunc("hour", start), F.date_trunc("hour", end), F.expr("INTERVAL 1 HOUR"))
        ).alias("hour_ts")
    )


def time_dimension(hours: DataFrame, with_unknown: bool = True) -> DataFrame:
    """Calendar rows for a frame of distinct hours (`hour_ts`), numbered in time order."""
    parts = assign_keys(hours.select("hour_ts"), ["hour_ts"], "time_key").select(
        "time_key", "hour_ts", *[c.alias(n) for n, c in calendar_parts("hour_ts").items()]
    )
    if not with_unknown:
        return parts
    unknown = hours.sparkSession.range(1).select(
        F.lit(schema.UNKNOWN_KEY).alias("time_key"),
        F.lit(schema.UNKNOWN_HOUR).cast("timestamp").alias("hour_ts"),
    )
    attributes = {**calendar_parts("hour_ts"), "is_night": F.lit(False)}
    unknown = unknown.select("*", *[c.alias(n) for n, c in attributes.items()])
    return parts.unionByName(unknown)


def calendar(spark: SparkSession, start: str, end: str, with_unknown: bool = True) -> DataFrame:
    """Gap-free calendar between two times."""
    span = spark.range(1).select(
        F.lit(start).cast("timestamp").alias("s"), F.lit(end).cast("timestamp").alias("e")
    )
    return time_dimension(hours_between(span, "s", "e"), with_unknown)


def channel_dimension(pairs: DataFrame, with_unknown: bool = True) -> DataFrame:
    """Channel rows for distinct (channel, mcc_code) pairs."""
    keyed = assign_keys(pairs.select("channel", "mcc_code"), ["channel", "mcc_code"], "channel_key")
    keyed = keyed.select("channel_key", "channel", "mcc_code")
    if not with_unknown:
        return keyed
    unknown = pairs.sparkSession.range(1).select(
        F.lit(schema.UNKNOWN_KEY).alias("channel_key"),
        F.lit(schema.UNKNOWN_CHANNEL).alias("channel"),
        F.lit(schema.UNKNOWN_MCC).alias("mcc_code"),
    )
    return keyed.unionByName(unknown)
