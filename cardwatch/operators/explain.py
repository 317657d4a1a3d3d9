"""Additive explanations of tree ensembles: Shapley values in log-odds, per decision and in summary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.score import linear_contributions, top_of
from cardwatch.session import run_dir, with_package


def _tree_nodes(model: PipelineModel, spark) -> dict[int, dict[int, dict]]:
    """Nodes of every tree; a fitted ensemble is small (trees times nodes of bounded depth)."""
    path = run_dir(spark, "trees")
    model.stages[-1].save(path)
    trees: dict[int, dict[int, dict]] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toLocalIterator():
        trees.setdefault(row["treeID"], {})[row["id"]] = row.asDict(recursive=True)
    return trees


def _leaves(nodes: dict[int, dict], weight: float) -> Iterator[tuple[float, dict[int, list]]]:
    """Weighted value of each leaf and, per feature on its path, [low, high, share of rows that pass]."""
    stack = [(0, {})]
    while stack:
        node_id, path = stack.pop()
        node = nodes[node_id]
        if node["leftChild"] < 0:
            yield weight * node["prediction"], path
            continue
        feature, limit = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
        for child, is_left in ((node["leftChild"], True), (node["rightChild"], False)):
            low, high, share = path.get(feature, [-np.inf, np.inf, 1.0])
            low, high = (low, min(high, limit)) if is_left else (max(low, limit), high)
            passed = nodes[child]["rawCount"] / node["rawCount"]
            stack.append((child, {**path, feature: [low, high, share * passed]}))


def _leaf_table(value: float, shares: Sequence[float]) -> np.ndarray:
    """Shapley values of a leaf for every pattern of satisfied path features (rows are bit patterns).

    The coalitions of each size are added up as the coefficients of a product of one factor per other feature.
    """
    n = len(shares)
    held = ((np.arange(1 << n)[:, None] >> np.arange(n)) & 1).astype(float)
    weights = np.array([factorial(k) * factorial(n - k - 1) / factorial(n) for k in range(n)])
    table = np.zeros((1 << n, n))
    for i in range(n):
        sizes = np.zeros((1 << n, n))
        sizes[:, 0] = 1.0
        for j in range(n):
            if j != i:
                grown = sizes * shares[j]
                grown[:, 1:] += sizes[:, :-1] * held[:, [j]]
                sizes = grown
        table[:, i] = value * (sizes @ weights) * (held[:, i] - shares[i])
    return table


def ensemble_tables(model: PipelineModel, spark) -> tuple[float, list[tuple]]:
    """Mean log-odds over the training rows, and one lookup table per distinct box of the leaves.

    Leaves of several trees with the same conditions have the same patterns, so their tables are added. The
    boosted margin is doubled, which is the log-odds of the fraud class.
    """
    base, boxes = 0.0, {}
    trees = _tree_nodes(model, spark)
    for tree_id, weight in enumerate(model.stages[-1].treeWeights):
        for value, path in _leaves(trees[tree_id], 2.0 * weight):
            features = sorted(path)
            shares = [path[f][2] for f in features]
            base += value * float(np.prod(shares))
            box, table = tuple((f, *path[f][:2]) for f in features), _leaf_table(value, shares)
            boxes[box] = boxes[box] + table if box in boxes else table
    return base, [([f for f, _, _ in box], *zip(*[side[1:] for side in box]), table) for box, table in boxes.items() if box]


def _explained(x: np.ndarray, leaves: Sequence[tuple]) -> np.ndarray:
    """Contributions by (input, row) for inputs given in the same form; each condition on an input is judged once."""
    total, held = np.zeros(x.shape), {}
    for features, lows, highs, table in leaves:
        pattern = np.zeros(x.shape[1], np.min_scalar_type(len(table) - 1))
        for bit, side in enumerate(zip(features, lows, highs)):
            if side not in held:
                f, low, high = side
                held[side] = ((x[f] > low) & (x[f] <= high)).view(np.uint8)
            pattern |= held[side].astype(pattern.dtype, copy=False) << np.uint8(bit)
        for f, column in zip(features, table.T):
            total[f] += column.take(pattern)
    return total


def tree_contributions(df: DataFrame, model: PipelineModel, keep: Sequence[str] = ("transaction_bk",)) -> DataFrame:
    """`base` and the array `contributions` in the order of the model's inputs; together the log-odds.

    Each Arrow batch is scored leaf by leaf with array operations; the leaf tables travel as a broadcast
    whose size depends on the model alone.
    """
    spark = df.sparkSession
    with_package(spark)
    inputs = model.stages[0].getInputCols()
    tables = spark.sparkContext.broadcast(ensemble_tables(model, spark))
    kept = list(keep)

    def explain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, leaves = tables.value
        for batch in batches:
            n = batch.num_rows
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype("float64") for c in inputs])
            flat = np.ascontiguousarray(_explained(x, leaves).T).ravel()
            each = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, len(x), dtype=np.int32), flat)
            columns = [*map(batch.column, kept), pa.array(np.full(n, base)), each]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "base", "contributions"])

    fields = [f for f in df.select(*kept).schema.fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return df.select(*kept, *[c for c in inputs if c not in kept]).mapInArrow(
        explain_batches, f"{ddl}, base double, contributions array<double>"
    )


def logistic_contributions(
    df: DataFrame, model: PipelineModel, background: DataFrame, keep: Sequence[str] = ("transaction_bk",)
) -> DataFrame:
    """The same for a logistic model: coefficient times distance from the background mean, all in columns."""
    inputs, fitted = model.stages[0].getInputCols(), model.stages[-1]
    weights = dict(zip(inputs, map(float, fitted.coefficients.toArray())))
    means = background.agg(*[F.avg(c).alias(c) for c in inputs]).first().asDict()
    base = float(fitted.intercept) + sum(weights[c] * means[c] for c in inputs)
    parts = linear_contributions(weights, means)
    return df.select(
        *keep, F.lit(base).alias("base"), F.array(*[parts[c] for c in inputs]).alias("contributions")
    )


def top_factors(explained: DataFrame, inputs: Sequence[str], k: int = 5) -> DataFrame:
    """Adds `top_features`, the k largest contributions by absolute value."""
    names = F.array(*[F.lit(n.removeprefix("x_")) for n in inputs])
    items = F.zip_with(
        names, F.col("contributions"), lambda n, v: F.struct(n.alias("feature"), v.alias("impact"))
    )
    return explained.withColumn("top_features", top_of(items, k))


def contribution_summary(explained: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Distribution of the contributions of each feature: mean size, mean, extremes and spread."""
    sized = [
        F.struct(
            F.lit(n.removeprefix("x_")).alias("feature"), F.col("contributions")[i].alias("impact")
        )
        for i, n in enumerate(inputs)
    ]
    flat = explained.select(F.explode(F.array(*sized)).alias("f")).select("f.*")
    return flat.groupBy("feature").agg(
        F.avg(F.abs("impact")).alias("mean_abs"),
        F.avg("impact").alias("mean"),
        F.min("impact").alias("min"),
        F.max("impact").alias("max"),
        F.stddev_pop("impact").alias("std"),
    )
