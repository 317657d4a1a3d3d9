"""Feature preparation, fitted on the training rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import one_hot, standardised

# The model's inputs. The country is left out on purpose, it separates the classes perfectly.
NUMERIC = ("amount", "home_distance_km", "net_income", "hour", "dow", "month")
BINARY = ("is_weekend", "is_night")
CATEGORICAL = ("auth_method", "channel", "segment")
FEATURES = (*NUMERIC, *BINARY, *CATEGORICAL)


@dataclass(frozen=True)
class Prep:
    """Mean and population deviation per numeric column, sorted known values per categorical one."""

    scale: dict[str, tuple[float, float]]
    binary: tuple[str, ...]
    categories: dict[str, tuple[str, ...]]

    @property
    def columns(self) -> list[str]:
        """Names of the encoded features, in vector order."""
        hot = [f"{c}_{v}" for c, values in self.categories.items() for v in values]
        return [f"x_{n}" for n in (*self.scale, *self.binary, *hot)]


def known_values(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Sorted distinct values of the categorical columns, in one pass: each becomes an input of the model."""
    if not columns:
        return {}
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    melted = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (feature, value)").where("value IS NOT NULL")
    found = melted.distinct().collect()
    return {c: tuple(sorted(r["value"] for r in found if r["feature"] == c)) for c in columns}


def fit_prep(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    binary: Sequence[str] = BINARY,
    categorical: Sequence[str] = CATEGORICAL,
) -> Prep:
    """Parameters of the preparation: one aggregation, and the distinct values of each category."""
    row = train.agg(
        F.count("*").alias("n"),
        *[F.avg(c).cast("double").alias(f"m_{c}") for c in numeric],
        *[F.stddev_pop(c).cast("double").alias(f"s_{c}") for c in numeric],
    ).first()
    scale = {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in numeric}
    return Prep(scale, tuple(binary), known_values(train, categorical))


def apply_prep(df: DataFrame, prep: Prep) -> DataFrame:
    """Adds the encoded features as columns `x_...`."""
    encoded = {f"x_{c}": standardised(c, *stats) for c, stats in prep.scale.items()}
    encoded |= {f"x_{c}": F.col(c).cast("double") for c in prep.binary}
    for c, values in prep.categories.items():
        encoded |= {f"x_{name}": column for name, column in one_hot(c, values).items()}
    return df.withColumns(encoded)


def class_ratio(df: DataFrame, label: str = "is_fraud") -> float:
    """Legitimate rows per fraud."""
    row = df.agg(F.count_if(~F.col(label)).alias("n"), F.count_if(F.col(label)).alias("p")).first()
    if not row["p"]:
        raise ValueError("no positive row to learn from")
    return row["n"] / row["p"]


def with_weight(df: DataFrame, positive: float, label: str = "is_fraud") -> DataFrame:
    """Adds `weight`: `positive` for frauds, 1 for the others."""
    return df.withColumn("weight", F.when(F.col(label), F.lit(float(positive))).otherwise(1.0))
