"""Privacy audit as data checks over the schemas and rows of the warehouse."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Parts of column names that give away a person's identity, and tables about companies.
FORBIDDEN = (
    "nom", "prenom", "email", "telephone", "adresse", "iban", "numero_carte", "card_number", "cvv",
)
EXEMPT_TABLES = ("branch",)
CARD_WORDS = ("carte", "card")
UUID_PATTERN = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


def catalog_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of the warehouse tables as (table, column, type)."""
    rows = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "table string, column string, type string")


def metastore_columns(spark: SparkSession, database: str) -> DataFrame:
    """The same from the session's catalog."""
    rows = [
        (t.name, c.name, c.dataType)
        for t in spark.catalog.listTables(database)
        for c in spark.catalog.listColumns(t.name if t.isTemporary else f"{database}.{t.name}")
    ]
    return spark.createDataFrame(rows, "table string, column string, type string")


def _named_like(words: Iterable[str]) -> Column:
    return F.lower("column").rlike("|".join(words))


def forbidden_columns(columns: DataFrame, words: Iterable[str] = FORBIDDEN, exempt: Iterable[str] = EXEMPT_TABLES) -> DataFrame:
    return columns.where(_named_like(words) & ~F.col("table").isin(*exempt))


def card_columns(columns: DataFrame) -> DataFrame:
    return columns.where(_named_like(CARD_WORDS) & ~F.col("table").contains("card_block"))


def identity_mappings(columns: DataFrame, words: Iterable[str] = FORBIDDEN) -> DataFrame:
    """Tables that hold a client id next to an identifying column."""
    return (
        columns.groupBy("table")
        .agg(F.max(F.col("column") == "client_id").alias("has_id"), F.max(_named_like(words)).alias("has_name"))
        .where("has_id AND has_name")
    )


def expired(facts: DataFrame, as_of: Column, retention: str = "5 YEARS", ts: str = "event_ts") -> DataFrame:
    """Facts older than the retention period."""
    return facts.where(F.col(ts) < as_of - F.expr(f"INTERVAL {retention}"))


def audit(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    clients: DataFrame,
    facts: DataFrame,
    explained: DataFrame | None,
    as_of: Column,
    key_pattern: str = UUID_PATTERN,
    retention: str = "5 YEARS",
    forbidden: Iterable[str] = FORBIDDEN,
) -> DataFrame:
    """One row per control: how many findings it has, and OK when it has none.

    `explained` holds scored rows with their `top_features`.
    """
    columns = catalog_columns(spark, tables)

    def control(name: str, principle: str, findings: DataFrame) -> DataFrame:
        return findings.agg(F.count("*").alias("findings")).select(
            F.lit(principle).alias("principle"), F.lit(name).alias("control"), "findings"
        )

    missing_logs = [t for t in ("run_log", "check_results") if t not in tables]
    logs = spark.range(len(missing_logs))
    unexplained = spark.range(1) if explained is None else explained.where(F.size("top_features") == 0)
    results = [
        control("no_identifying_column", "minimisation", forbidden_columns(columns, forbidden)),
        control("client_key_opaque", "pseudonymisation", clients.where(~F.col("client_id").rlike(key_pattern))),
        control("no_card_data", "security", card_columns(columns)),
        control("decisions_explained", "explanation", unexplained),
        control("processing_logged", "accountability", logs),
        control("retention_respected", "storage_limitation", expired(facts, as_of, retention)),
        control("no_identity_mapping", "subject_rights", identity_mappings(columns, forbidden)),
    ]
    return reduce(DataFrame.unionByName, results).withColumn(
        "status", F.when(F.col("findings") == 0, "OK").otherwise("KO")
    )
