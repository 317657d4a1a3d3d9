"""Data-quality rules, referential checks and table constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import failed_rules, percent_of
from cardwatch.operators.dimensions import Dims
from cardwatch.operators.load import pending
from cardwatch.schema import Constraints


def dangling(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Rows whose key has no match in the parent table."""
    return child.join(parent.select(key), key, "left_anti")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key, NULL keys not counted as distinct; one row `value`."""
    copies = df.select(key).groupBy(key).agg(F.count("*").alias("n"))
    extra = F.when(F.col(key).isNull(), F.col("n")).otherwise(F.col("n") - 1)
    return copies.agg(F.coalesce(F.sum(extra), F.lit(0)).cast("double").alias("value"))


def label_mismatch() -> Column:
    """A fraud without type, or a legitimate row with one; unlabelled rows are never wrong here."""
    fraud = F.col("is_fraud")
    return (fraud.eqNullSafe(True) & F.col("fraud_type").isNull()) | (
        fraud.eqNullSafe(False) & F.col("fraud_type").isNotNull()
    )


def stale(staging: DataFrame, fact: DataFrame | None, as_of: Column, minutes: int = 10) -> DataFrame:
    """Staged rows still waiting after the given delay."""
    limit = as_of - F.expr(f"INTERVAL {minutes} MINUTES")
    return pending(staging.where(F.col("ingested_at") < limit), fact)


# Name, category and threshold of each rule, in report order; `low` is the lower bound of a range.
RULES = [
    {"check": "fact_keys_complete", "category": "completeness", "threshold": 0.0},
    {"check": "staging_client_known", "category": "integrity", "threshold": 0.0},
    {"check": "business_key_unique", "category": "uniqueness", "threshold": 0.0},
    {"check": "amount_positive", "category": "coherence", "threshold": 0.0},
    {"check": "distance_not_negative", "category": "coherence", "threshold": 0.0},
    {"check": "label_coherent", "category": "coherence", "threshold": 0.0},
    {"check": "fraud_rate_plausible", "category": "plausibility", "threshold": 3.0, "low": 0.5},
    {"check": "staging_transformed", "category": "completeness", "threshold": 0.0},
    {"check": "branch_rows", "category": "completeness"},
    {"check": "channel_rows", "category": "completeness"},
]


def run_checks(
    staging: DataFrame,
    fact: DataFrame,
    dims: Dims,
    as_of: Column,
    loaded: DataFrame | None = None,
    branches: int = 10,
    channels: int = 10,
) -> DataFrame:
    """Ten rules, one row each: value, threshold and OK or KO. A rule without value is KO.

    The rules on the fact table share one aggregation; uniqueness runs on the key column alone.
    `loaded` narrows the fact table used to find waiting rows, when it is known to suffice.
    """
    frauds, labelled = F.count_if(F.col("is_fraud")), F.count("is_fraud")
    measures = {
        "fact_keys_complete": F.count_if(
            F.col("client_key").isNull() | F.col("time_key").isNull() | F.col("channel_key").isNull()
        ).cast("double"),
        "amount_positive": F.count_if(F.col("amount") <= 0).cast("double"),
        "distance_not_negative": F.count_if(F.col("home_distance_km") < 0).cast("double"),
        "label_coherent": F.count_if(label_mismatch()).cast("double"),
        "fraud_rate_plausible": percent_of(frauds, labelled),
    }
    fused = fact.agg(*[m.alias(n) for n, m in measures.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in measures)
    values = fused.selectExpr(f"stack({len(measures)}, {pairs}) AS (check_name, value)")

    def counted(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").cast("double").alias("value")).select(F.lit(name).alias("check_name"), "value")

    others = [
        counted("staging_client_known", dangling(staging.select("client_id"), "client_id", dims.client)),
        duplicate_count(fact, "transaction_bk").select(F.lit("business_key_unique").alias("check_name"), "value"),
        counted("staging_transformed", stale(staging, loaded if loaded is not None else fact, as_of)),
        counted("branch_rows", dims.branch),
        counted("channel_rows", dims.channel),
    ]
    values = reduce(DataFrame.unionByName, others, values)
    expected = {"branch_rows": float(branches), "channel_rows": float(channels)}
    name, value = F.col("check_name"), F.col("value")
    category, threshold, passed = F.lit(None), F.lit(None), F.lit(False)
    for rule in RULES:
        is_rule = name == rule["check"]
        limit = expected.get(rule["check"], rule.get("threshold"))
        category = F.when(is_rule, F.lit(rule["category"])).otherwise(category)
        threshold = F.when(is_rule, F.lit(limit)).otherwise(threshold)
        holds = value.between(rule["low"], limit) if "low" in rule else value == limit
        passed = F.when(is_rule, holds).otherwise(passed)
    return values.select(
        name,
        category.alias("category"),
        value,
        threshold.alias("threshold"),
        F.when(F.coalesce(passed, F.lit(False)), "OK").otherwise("KO").alias("status"),
    )


def assert_passed(results: DataFrame) -> None:
    """Raise when any check failed (the results are one row per rule)."""
    failed = [r["check_name"] for r in results.where(F.col("status") != "OK").select("check_name").collect()]
    if failed:
        raise AssertionError(f"data-quality checks failed: {', '.join(sorted(failed))}")


def violations(df: DataFrame, rules: Constraints, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Counts per broken constraint, one row each; constraints that hold are left out.

    `parents` maps the table names used by the foreign keys to frames that have the key column.
    """
    row_rules: dict[str, Column] = {f"not_null:{c}": F.col(c).isNotNull() for c in rules.not_null}
    for c, size in rules.max_length.items():
        row_rules[f"length:{c}"] = F.coalesce(F.length(c) <= size, F.lit(True))
    for c, allowed in rules.domain.items():
        row_rules[f"domain:{c}"] = F.coalesce(F.col(c).isin(*allowed), F.lit(True))
    found = [
        df.select(F.explode(failed_rules(row_rules)).alias("rule")).groupBy("rule").agg(F.count("*").alias("n_rows"))
    ]
    for key in rules.unique:
        copies = df.dropna(subset=list(key)).groupBy(*key).agg(F.count("*").alias("n"))  # as UNIQUE does
        extra = copies.agg(F.sum(F.col("n") - 1).cast("long").alias("n_rows"))
        found.append(extra.select(F.lit("unique:" + ",".join(key)).alias("rule"), "n_rows"))
    for key, parent in rules.foreign.items():
        if parents and parent in parents:
            orphans = dangling(df.where(F.col(key).isNotNull()), key, parents[parent])
            found.append(
                orphans.agg(F.count("*").alias("n_rows")).select(F.lit(f"foreign:{key}").alias("rule"), "n_rows")
            )
    return reduce(DataFrame.unionByName, found).where(F.col("n_rows") > 0)


def enforce(
    df: DataFrame,
    rules: Constraints,
    parents: Mapping[str, DataFrame] | None = None,
    order: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the constraints, and the others with the rules they break.

    Of the rows that satisfy everything else, the first of each unique key stays (in the given order of
    columns, all columns by default; equal rows are one). A foreign key without a parent frame raises.
    """
    row_rules: dict[str, Column] = {f"not_null:{c}": F.col(c).isNotNull() for c in rules.not_null}
    for c, size in rules.max_length.items():
        row_rules[f"length:{c}"] = F.coalesce(F.length(c) <= size, F.lit(True))
    for c, allowed in rules.domain.items():
        row_rules[f"domain:{c}"] = F.coalesce(F.col(c).isin(*allowed), F.lit(True))
    columns = df.columns
    for i, (key, parent) in enumerate(rules.foreign.items()):
        there = (parents or {})[parent].select(F.col(key).alias(f"_key_{i}")).distinct()
        df = df.join(there, F.col(key) == F.col(f"_key_{i}"), "left")
        row_rules[f"foreign:{key}"] = F.col(key).isNull() | F.col(f"_key_{i}").isNotNull()
    judged = df.withColumn("broken_rules", failed_rules(row_rules)).select(*columns, "broken_rules")
    for key in rules.unique:
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        counts = judged.where((F.size("broken_rules") == 0) & whole)
        best = F.min(F.struct(*(order or columns))).alias("_first")
        first = counts.groupBy(*[F.col(c).alias(f"_u_{c}") for c in key]).agg(best)
        same = [F.col(c) == F.col(f"_u_{c}") for c in key]
        again = (F.size("broken_rules") == 0) & ~F.struct(*(order or columns)).eqNullSafe(F.col("_first"))
        rule = F.array(F.lit("unique:" + ",".join(key)))
        judged = judged.join(first, same, "left").select(
            *columns, F.when(F.col("_first").isNotNull() & again, rule).otherwise(F.col("broken_rules")).alias("broken_rules")
        )
    return judged.where(F.size("broken_rules") == 0).drop("broken_rules"), judged.where(F.size("broken_rules") > 0)
