"""Oversampling of the fraud class by interpolation between a fraud and one of its nearest frauds."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.spread import running_totals
from cardwatch.session import with_package

# Random projection trees, points of a leaf (about), and children of a node at most.
TREES = 24
LEAF = 160
FAN = 8


def leaves(points: DataFrame, trees: int, leaf: int, fan: int, seed: int) -> DataFrame:
    """Each point once per tree with its leaf `node`: (tree, node, id, v).

    A level cuts every node into at most `fan` parts of about equal size along a random direction. The cuts come from a
    sketch per node, which tasks merge, so no task holds a node; directions are drawn from the seed alone.
    """
    n, width = points.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    rng = np.random.default_rng(seed)
    placed = points.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("node", F.lit(0).cast("bigint"))
    parts = max(1.0, n / leaf)
    levels = math.ceil(math.log(parts, fan) - 1e-9)
    fan = math.ceil(parts ** (1 / levels) - 1e-9) if levels else 1
    share = [i / fan for i in range(1, fan)]
    for _ in range(levels):
        axes = F.lit([rng.normal(size=width).tolist() for _ in range(trees)])
        along = F.aggregate(F.zip_with("v", F.get(axes, F.col("tree")), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
        placed = placed.withColumn("p", along).checkpoint()
        cuts = placed.groupBy("tree", "node").agg(F.percentile_approx("p", share, 1000).alias("cuts"))
        part = F.size(F.filter("cuts", lambda c: F.col("p") > c))
        placed = placed.join(cuts, ["tree", "node"]).select("id", "v", "tree", (F.col("node") * fan + part).alias("node"))
    return placed


def nearest(
    points: DataFrame, k: int, trees: int = TREES, leaf: int = LEAF, fan: int = FAN, seed: int = 7
) -> DataFrame:
    """About the `k` nearest other points of each point: (id, other, other_v, distance, place).

    Input: `id` and the array `v`, all vectors distinct. Points are compared with those of their leaf in each of some
    random projection trees, so a point has at most about `trees * leaf` candidates, however many
    points there are. The search is approximate; its recall is tested against brute force.
    """
    with_package(points.sparkSession)
    kind = points.schema["id"].dataType.simpleString()
    placed = leaves(points, trees, leaf, fan, seed)

    def near_in_leaf(members: pa.Table) -> pa.Table:
        return _nearest_of(members, k)

    # the nearest of all trees are among the nearest of each, so only those leave a leaf
    found = placed.groupBy("tree", "node").applyInArrow(near_in_leaf, f"id {kind}, other {kind}, distance double")
    found = found.repartition("id").dropDuplicates(["id", "other"])
    by_distance = Window.partitionBy("id").orderBy("distance", "other")
    best = found.withColumn("place", F.row_number().over(by_distance)).where(F.col("place") <= k)
    others = points.select(F.col("id").alias("other"), F.col("v").alias("other_v"))
    return best.join(others, "other").select("id", "other", "other_v", "distance", "place")


def _nearest_of(members: pa.Table, k: int, tile: int = 1024) -> pa.Table:
    """The `k` nearest others of each point of a leaf; equal distances are ordered by id."""
    members = members.sort_by("id").combine_chunks()
    n, ids = members.num_rows, members.column("id")
    x = members.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    take = min(k, n - 1)
    at, distances = [], []
    for lo in range(0, n, tile):
        own = x[lo : lo + tile]
        total = np.zeros((len(own), n))
        for d in range(x.shape[1]):
            apart = own[:, d, None] - x[None, :, d]
            total += apart * apart
        gap = np.sqrt(total)
        gap[np.arange(len(own)), np.arange(lo, lo + len(own))] = np.inf
        first = np.argsort(gap, axis=1, kind="stable")[:, :take]
        at.append(first)
        distances.append(np.take_along_axis(gap, first, axis=1))
    mine, theirs = np.repeat(np.arange(n), take), np.concatenate(at).ravel()
    return pa.table({"id": ids.take(pa.array(mine)), "other": ids.take(pa.array(theirs)), "distance": np.concatenate(distances).ravel()})


def _draw(seed: int, *parts: Column) -> Column:
    """Uniform number in [0, 1) that depends on the parts and the seed only."""
    return F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def oversample(
    train: DataFrame,
    inputs: Sequence[str],
    ratio: float = 0.3,
    k: int = 5,
    seed: int = 42,
    bk: str = "transaction_bk",
) -> DataFrame:
    """Training rows and synthetic frauds, so that there are `ratio` frauds per legitimate row.

    Result: the inputs, `is_fraud` and `synthetic`. Equal vectors are kept once with their number, since
    copies are each other's nearest neighbours at distance 0.
    """
    sizes = train.agg(F.count_if(F.col("is_fraud")).alias("p"), F.count_if(~F.col("is_fraud")).alias("n")).first()
    missing = int(ratio * sizes["n"]) - sizes["p"]
    real = train.where(F.col("is_fraud").isNotNull()).select(*inputs, "is_fraud", F.lit(False).alias("synthetic"))
    if missing <= 0 or sizes["p"] < 2:
        return real
    frauds = train.where("is_fraud").select(bk, F.array(*[F.col(c).cast("double") for c in inputs]).alias("v"))
    points = frauds.groupBy("v").agg(F.min(bk).alias("id"), F.count("*").alias("copies")).checkpoint()
    # The nearest k copies of other vectors, as far as the point's own copies leave room.
    weights = points.select(F.col("id").alias("other"), F.col("copies").alias("other_copies"))
    upto = Window.partitionBy("id").orderBy("place")
    if points.count() == 1:
        found = points.select(
            "id", F.lit("").alias("other"), F.col("v").alias("other_v"), F.lit(0.0).alias("distance"), F.lit(1).alias("place")
        ).where(F.lit(False))
    else:
        found = nearest(points.select("id", "v"), k)
    near = (
        found
        .join(weights, "other")
        .withColumn("reach", F.sum("other_copies").over(upto))
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("reach", "other_v"))).alias("near"))  # at most k entries
    )
    table = points.join(near, "id", "left")
    # Every fraud is used equally often; the first ones in hash order once more.
    each, extra = divmod(missing, sizes["p"])
    order = frauds.select(bk, "v", F.xxhash64(F.col(bk), F.lit(seed)).alias("_h"), F.lit(1).alias("_one"))
    ranked = running_totals(order, ["_h", bk], ["_one"])
    uses = F.lit(each) + F.when(F.col("run__one") <= extra, 1).otherwise(0)
    seeds = ranked.withColumn("_uses", uses).where("_uses > 0").select(
        bk, "v", F.explode(F.sequence(F.lit(1), F.col("_uses"))).alias("_i")
    )
    joined = seeds.join(table.select("v", "copies", "near"), "v")
    own = F.col("copies") - 1
    last = F.coalesce(F.element_at(F.transform("near", lambda n: n["reach"]), -1), F.lit(0))
    choice = F.floor(_draw(seed, F.col(bk), F.col("_i")) * F.least(F.lit(k), own + last))
    partner = F.when(
        choice >= own, F.filter("near", lambda n: n["reach"] > choice - own)[0]["other_v"]
    ).otherwise(F.col("v"))
    share = _draw(seed + 1, F.col(bk), F.col("_i"))
    drawn = joined.withColumns({"_partner": partner, "_share": share}).withColumn(
        "_new", F.zip_with("v", "_partner", lambda x, y: x + F.col("_share") * (y - x))
    )
    made = drawn.select(
        *[F.col("_new")[i].alias(c) for i, c in enumerate(inputs)],
        F.lit(True).alias("is_fraud"),
        F.lit(True).alias("synthetic"),
    )
    return real.unionByName(made)
