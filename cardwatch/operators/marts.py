"""Reporting views over the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import percent_of


def _frauds() -> Column:
    return F.count_if(F.col("is_fraud"))


def _rate() -> Column:
    """Frauds in percent of the labelled rows."""
    return percent_of(_frauds(), F.count("is_fraud"))


def mart_kpis(fact: DataFrame) -> DataFrame:
    """One row of totals; the fraud rate counts labelled rows only."""
    return fact.agg(
        F.count("*").alias("n_transactions"),
        _frauds().alias("n_frauds"),
        _rate().alias("fraud_rate_pct"),
        F.round(F.sum(F.when(F.col("is_fraud"), F.col("amount"))), 2).cast("double").alias("fraud_amount"),
        F.count_if(F.col("is_fraud").isNull()).alias("n_unlabelled"),
    )


def mart_ingestion(fact: DataFrame) -> DataFrame:
    return fact.groupBy("ingestion_mode").agg(
        F.count("*").alias("n_transactions"),
        _frauds().alias("n_frauds"),
        F.min("created_at").alias("first_write"),
        F.max("created_at").alias("last_write"),
    )


def mart_hourly(fact: DataFrame, time: DataFrame) -> DataFrame:
    """Profile by hour of day, in hour order."""
    return (
        fact.join(time.select("time_key", "hour"), "time_key")
        .groupBy("hour")
        .agg(
            F.count("*").alias("n_transactions"),
            _frauds().alias("n_frauds"),
            _rate().alias("fraud_rate_pct"),
        )
        .orderBy("hour")
    )


def mart_fraud_type(fact: DataFrame) -> DataFrame:
    """Frauds by type, most frequent first."""
    return (
        fact.where("is_fraud")
        .groupBy("fraud_type")
        .agg(
            F.count("*").alias("n_frauds"),
            F.round(F.sum("amount"), 2).cast("double").alias("amount_total"),
            F.round(F.avg("amount"), 2).cast("double").alias("amount_mean"),
        )
        .orderBy(F.desc("n_frauds"), "fraud_type")
    )
