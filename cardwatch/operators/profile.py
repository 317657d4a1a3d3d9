"""Exploratory profiles: class balance, fraud rates, distributions and univariate outlier detectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import f1, log10_floor, ratio
from cardwatch.functions.spread import exact_quantiles


def class_imbalance(df: DataFrame) -> DataFrame:
    """Class counts, fraud percentage and the number of legitimate rows per fraud (half to even)."""
    n, fraud = F.count("*"), F.count_if(F.col("is_fraud"))
    return df.agg(
        n.alias("n_total"),
        fraud.alias("n_fraud"),
        (n - fraud).alias("n_legit"),
        F.bround(F.try_divide(F.lit(100.0) * fraud, n), 3).alias("fraud_rate_pct"),
        F.bround(F.try_divide((n - fraud).cast("double"), fraud), 0).cast("long").alias("legit_per_fraud"),
    )


def fraud_rate_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and fraud percentage per value of each column, as (dimension, value, n, rate).

    One pass over the rows groups by all columns together; the per-column figures are grouping sets
    over that small frame of value combinations.
    """
    combos = df.groupBy(*columns).agg(
        F.count("is_fraud").alias("_n"), F.count_if(F.col("is_fraud")).alias("_fraud")
    )
    sets = combos.groupingSets([[c] for c in columns], *columns).agg(
        F.sum("_n").alias("n"),
        F.sum("_fraud").alias("_fraud"),
        *[F.grouping(c).alias(f"_off_{c}") for c in columns],
    )
    dimension, value = F.lit(None), F.lit(None)
    for c in columns:
        here = F.col(f"_off_{c}") == 0
        dimension = F.when(here, F.lit(c)).otherwise(dimension)
        value = F.when(here, F.col(c).cast("string")).otherwise(value)
    rate = F.bround(F.lit(100.0) * ratio(F.col("_fraud"), F.col("n")), 2)
    return sets.select(
        dimension.alias("dimension"), value.alias("value"), "n", rate.alias("fraud_rate_pct")
    )


def country_pivot(df: DataFrame) -> DataFrame:
    """Fraud percentage at home and abroad, 0 where no row exists."""
    rates = df.groupBy().pivot("unusual_country", [False, True]).agg(F.avg(F.col("is_fraud").cast("int")) * 100)
    return rates.select(
        F.bround(F.coalesce("false", F.lit(0.0)), 2).alias("usual_country_pct"),
        F.bround(F.coalesce("true", F.lit(0.0)), 2).alias("unusual_country_pct"),
    )


def first_peak(rates: DataFrame, value: str, rate: str) -> DataFrame:
    """Value with the highest rate; the lowest value wins a tie. One row, merged map-side."""
    best = F.min_by(F.struct(value, rate), F.struct(-F.col(rate), F.col(value))).alias("_best")
    return rates.agg(best).select(f"_best.{value}", f"_best.{rate}")


def peaks(df: DataFrame) -> DataFrame:
    """The hour and the channel with the highest fraud percentage."""
    result = None
    for column in ("hour", "channel"):
        rates = df.groupBy(column).agg((F.avg(F.col("is_fraud").cast("int")) * 100).alias("rate"))
        top = first_peak(rates, column, "rate").select(
            F.lit(column).alias("dimension"),
            F.col(column).cast("string").alias("value"),
            F.bround("rate", 2).alias("fraud_rate_pct"),
        )
        result = top if result is None else result.unionByName(top)
    return result


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    return df.where(F.col("is_fraud").isNotNull()).selectExpr(
        "is_fraud", f"stack({len(columns)}, {pairs}) AS (feature, x)"
    )


def describe_by_class(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each column and class."""
    keys = ["feature", "is_fraud"]
    rows = _long(df, columns)
    moments = rows.groupBy(*keys).agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    quartiles = exact_quantiles(rows, "x", [0.25, 0.5, 0.75], by=keys)
    return moments.join(quartiles, keys).select(
        *keys,
        "n",
        *[F.bround(c, 2).alias(c) for c in ("mean", "std", "min")],
        *[F.bround(q, 2).alias(n) for q, n in (("q_0", "q25"), ("q_1", "q50"), ("q_2", "q75"))],
        F.bround("max", 2).alias("max"),
    )


def boxplot(df: DataFrame, column: str) -> DataFrame:
    """Quartiles per class and the outermost values inside 1.5 interquartile ranges of the box."""
    rows = _long(df, [column])
    box = exact_quantiles(rows, "x", [0.25, 0.5, 0.75], by=["is_fraud"])
    reach = F.lit(1.5) * (F.col("q_2") - F.col("q_0"))
    fenced = rows.join(F.broadcast(box), "is_fraud")  # one row per class
    inside = F.col("x").between(F.col("q_0") - reach, F.col("q_2") + reach)
    return fenced.groupBy("is_fraud").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max("q_0").alias("q25"),
        F.max("q_1").alias("q50"),
        F.max("q_2").alias("q75"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
    )


def histogram(df: DataFrame, value: Column, by: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the extremes of each class, with counts and densities."""
    rows = df.where(F.col(by).isNotNull()).select(F.col(by), F.round(value, 9).alias("x"))
    span = rows.groupBy(by).agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("total")
    )
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / F.lit(float(bins))).otherwise(1.0)
    placed = rows.join(F.broadcast(span.withColumn("width", width)), by)  # one row per class
    number = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("int")
    counts = placed.groupBy(by, number.alias("bin")).agg(
        F.count("x").alias("n"),
        F.first("lo").alias("lo"),
        F.first("width").alias("width"),
        F.first("total").alias("total"),
    )
    return counts.select(
        by,
        "bin",
        F.round(F.col("lo") + F.col("bin") * F.col("width"), 6).alias("bin_start"),
        "n",
        F.round(F.col("n") / (F.col("total") * F.col("width")), 6).alias("density"),
    )


def log_amount_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(df, log10_floor(F.col("amount")), "is_fraud", bins)


def zscore_flags(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """Adds `flag`: more than `limit` sample deviations away from the mean."""
    x = F.col(column).cast("double")
    stats = df.agg(F.struct(F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).alias("st")).scalar()
    return df.withColumn("flag", F.coalesce(F.abs(F.try_divide(x - stats["m"], stats["s"])) > limit, F.lit(False)))


def iqr_flags(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Adds `flag`: above the third quartile by more than `reach` interquartile ranges."""
    box = exact_quantiles(df, column, [0.25, 0.75])
    fence = box.select(F.col("q_1") + F.lit(reach) * (F.col("q_1") - F.col("q_0"))).scalar()
    return df.withColumn("flag", F.col(column).cast("double") > fence)


def detector_card(df: DataFrame, digits: int = 3) -> DataFrame:
    """Signals, hits, false alarms, precision, recall and F1 of `flag` against the label."""
    flag, fraud = F.col("flag"), F.col("is_fraud")
    counts = df.agg(
        F.count_if(flag).alias("n_signals"),
        F.count_if(flag & fraud).alias("tp"),
        F.count_if(flag & ~fraud).alias("fp"),
        F.count_if(~flag & fraud).alias("fn"),
    )
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(
        "n_signals",
        "tp",
        "fp",
        F.bround(precision, digits).alias("precision"),
        F.bround(recall, digits).alias("recall"),
        F.bround(f1(precision, recall), digits).alias("f1"),
    )
