"""Scoring requests: validation, decisions, additive explanations and online enrichment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import failed_rules, risk_band

DEFAULT_THRESHOLD = 0.5

# Accepted authentication methods, channels and segments of a scoring request.
REQUEST_DOMAINS = {
    "auth_method": ("puce_pin", "3ds", "none"),
    "channel": ("en_ligne", "puce", "sans_contact", "distributeur"),
    "segment": ("particulier", "premium", "professionnel"),
}


def request_rules(domains: Mapping[str, Sequence[str]] = REQUEST_DOMAINS) -> dict[str, Column]:
    """Rule per request field; a missing value breaks its rule."""
    rules = {
        "amount": F.col("amount") > 0,
        "home_distance_km": F.col("home_distance_km") >= 0,
        "net_income": F.col("net_income") > 0,
        "hour": F.col("hour").between(0, 23),
        "dow": F.col("dow").between(1, 7),
        "month": F.col("month").between(1, 12),
        "is_weekend": F.col("is_weekend").isNotNull(),
        "is_night": F.col("is_night").isNotNull(),
    }
    for name, allowed in domains.items():
        rules[name] = F.col(name).isin(*allowed)
    return rules


def judge_requests(df: DataFrame, domains: Mapping[str, Sequence[str]] = REQUEST_DOMAINS) -> DataFrame:
    """Adds `errors`, the names of the fields that are out of their domain."""
    return df.withColumn("errors", failed_rules(request_rules(domains)))


def validate_requests(
    df: DataFrame, domains: Mapping[str, Sequence[str]] = REQUEST_DOMAINS
) -> tuple[DataFrame, DataFrame]:
    """Accepted requests, and rejected ones with `errors`."""
    judged = judge_requests(df, domains)
    return judged.where(F.size("errors") == 0).drop("errors"), judged.where(F.size("errors") > 0)


def decide(df: DataFrame, tuned: float, score: str = "score", default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Rounded score, both binary decisions and the risk band (taken before rounding)."""
    p = F.col(score)
    return df.withColumns(
        {
            "fraud_at_default": p >= default,
            "fraud_at_tuned": p >= tuned,
            "risk_level": risk_band(p, tuned, default),
            score: F.bround(p, 4),
        }
    )


def top_contributions(contributions: Mapping[str, Column], k: int = 5) -> Column:
    """The k largest contributions by absolute value, rounded to four places, as an array of structs."""
    items = F.array(
        *[F.struct(F.lit(n).alias("feature"), c.cast("double").alias("impact")) for n, c in contributions.items()]
    )
    return top_of(items, k)


def top_of(items: Column, k: int = 5) -> Column:
    """First k of an array of (feature, impact) structs by falling absolute impact, then by name."""
    keyed = F.transform(
        items, lambda x: F.struct((-F.abs(x["impact"])).alias("k"), x["feature"].alias("f"), x["impact"].alias("i"))
    )
    return F.transform(
        F.slice(F.array_sort(keyed), 1, k),
        lambda x: F.struct(x["f"].alias("feature"), F.bround(x["i"], 4).alias("impact")),
    )


def linear_contributions(coefficients: Mapping[str, float], means: Mapping[str, float]) -> dict[str, Column]:
    """coefficient * (x - mean) per feature: the exact additive explanation of a linear score."""
    return {
        name: F.lit(float(w)) * (F.col(name).cast("double") - F.lit(float(means[name])))
        for name, w in coefficients.items()
    }


def enrich_online(df: DataFrame, features: DataFrame, key: str = "client_id") -> DataFrame:
    """Adds `online` with the client's counters; an unknown client or missing counters give NULL."""
    n, amount = F.col("nb_tx_1h"), F.col("amount_1h")
    online = F.struct(
        F.coalesce(n, F.lit(0)).cast("long").alias("nb_tx_1h"),
        F.bround(F.coalesce(amount.cast("double"), F.lit(0.0)), 2).alias("amount_1h"),
    )
    known = features.select(key, "nb_tx_1h", "amount_1h")
    return (
        df.join(known, key, "left")
        .withColumn("online", F.when(n.isNotNull() | amount.isNotNull(), online))
        .drop("nb_tx_1h", "amount_1h")
    )
