"""Drift between a reference and a current frame, column by column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import shift_cyclic
from cardwatch.functions.spread import running_totals
from cardwatch.session import shared_dir

ALERT_SHARE = 0.20
DRIFT_THRESHOLD = 0.1
# A numeric column with at most this many distinct reference values is compared by frequency.
FEW_VALUES = 5


def inject_drift(df: DataFrame, cycle: str = "month", period: int = 12, bk: str = "transaction_bk") -> DataFrame:
    """Shift the hour by nine, raise amounts by 1.8 and move the cyclic column by four to six; the rest stays."""
    draw = F.conv(F.substring(F.md5(F.col(bk)), 1, 4), 16, 10).cast("int")
    step = F.lit(4) + draw % 3
    return df.withColumns(
        {
            "hour": ((F.col("hour") + 9) % 24).cast("int"),
            "amount": F.bround(F.col("amount") * 1.8, 2),
            cycle: shift_cyclic(F.col(cycle), step, period, start=1).cast("int"),
        }
    )


def _value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Occurrences of each value on both sides, as (feature, x, ref, cur); combined before the shuffle."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {kind})" for c in columns)
    melted = f"stack({len(columns)}, {pairs}) AS (feature, x)"
    both = reference.selectExpr(melted).withColumn("side", F.lit(0)).unionByName(
        current.selectExpr(melted).withColumn("side", F.lit(1))
    )
    return (
        both.where(F.col("x").isNotNull())
        .groupBy("feature", "x")
        .agg(F.count_if(F.col("side") == 0).alias("ref"), F.count_if(F.col("side") == 1).alias("cur"))
    )


def numeric_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Wasserstein distance per column, divided by the reference's population deviation (0.001 at least)."""
    return _wasserstein(_value_counts(reference, current, columns, "DOUBLE"))


def _wasserstein(counts: DataFrame) -> DataFrame:
    steps = running_totals(counts, ["x"], ["ref", "cur"], by=["feature"], next_of="x")
    sizes = counts.groupBy("feature").agg(
        F.sum("ref").alias("n_ref"),
        F.sum("cur").alias("n_cur"),
        (F.sum(F.col("x") * F.col("ref")) / F.sum("ref")).alias("mean"),
        F.count_if(F.col("ref") > 0).alias("n_values"),
    )
    placed = steps.join(F.broadcast(sizes), "feature")  # one row per column
    gap = F.abs(F.col("run_ref") / F.col("n_ref") - F.col("run_cur") / F.col("n_cur"))
    moved = F.sum(gap * (F.coalesce("next_x", "x") - F.col("x"))).alias("distance")
    spread = F.sqrt(
        F.sum(F.col("ref") * (F.col("x") - F.col("mean")) * (F.col("x") - F.col("mean"))) / F.max("n_ref")
    )
    return (
        placed.groupBy("feature")
        .agg(moved, spread.alias("std"), F.max("n_values").alias("n_values"))
        .select(
            "feature",
            F.lit("wasserstein").alias("method"),
            (F.col("distance") / F.greatest(F.col("std"), F.lit(0.001))).alias("score"),
            "n_values",
        )
    )


def categorical_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance (base 2) between the value frequencies of each column."""
    return _jensen_shannon(_value_counts(reference, current, columns, "STRING"))


def _jensen_shannon(counts: DataFrame) -> DataFrame:
    sizes = counts.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    shares = counts.join(F.broadcast(sizes), "feature").select(  # one row per column
        "feature", (F.col("ref") / F.col("n_ref")).alias("p"), (F.col("cur") / F.col("n_cur")).alias("q")
    )
    middle = (F.col("p") + F.col("q")) / 2

    def part(share: str):
        return F.when(F.col(share) > 0, F.col(share) * F.log2(F.col(share) / middle)).otherwise(0.0)

    divergence = F.sum((part("p") + part("q")) / 2)
    return shares.groupBy("feature").agg(
        F.lit("jensen_shannon").alias("method"),
        F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("score"),
        F.count_if(F.col("p") > 0).alias("n_values"),
    )


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    threshold: float = DRIFT_THRESHOLD,
) -> DataFrame:
    """Score and verdict per column; numeric columns with few values are compared by frequency.

    The values of the numeric columns are counted once; each column then goes to one of the two methods.
    """
    shared_dir(reference.sparkSession)
    counts = _value_counts(reference, current, numeric, "DOUBLE").checkpoint()
    sizes = counts.groupBy("feature").agg(F.count_if(F.col("ref") > 0).alias("n"))
    few = [r["feature"] for r in sizes.where(F.col("n") <= FEW_VALUES).collect()]  # names of columns
    by_name = counts.where(F.col("feature").isin(few)).withColumn("x", F.col("x").cast("string"))
    if categorical:
        by_name = by_name.unionByName(_value_counts(reference, current, categorical, "STRING"))
    scores = _wasserstein(counts.where(~F.col("feature").isin(few))).unionByName(_jensen_shannon(by_name))
    return scores.select(
        "feature",
        "method",
        F.round("score", 6).alias("score"),
        (F.col("score") >= threshold).alias("drifted"),
    )


def drift_verdict(scores: DataFrame, scenario: str, alert_share: float = ALERT_SHARE) -> DataFrame:
    """Share of drifted columns, their names, and the alert when the share exceeds the limit."""
    drifted = F.count_if("drifted")
    share = F.avg(F.col("drifted").cast("int"))
    return scores.agg(
        F.lit(scenario).alias("scenario"),
        F.count("*").alias("n_columns"),
        drifted.alias("n_drifted"),
        F.bround(share * 100, 2).alias("drifted_pct"),
        (share > alert_share).alias("alert"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))).alias("drifted_columns"),
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    scenario: str,
    threshold: float = DRIFT_THRESHOLD,
) -> DataFrame:
    return drift_verdict(column_drift(reference, current, numeric, categorical, threshold), scenario)
