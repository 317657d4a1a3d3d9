"""Helpers that keep ordered work spread out when one key or value dominates.

Spark evaluates a window group in one task. The helpers below cut the long groups into
consecutive pieces and hand each piece what it needs from the pieces before it, so that no
task ever holds an unbounded group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.session import shared_dir

# A window group with more rows than this is cut into pieces.
MAX_GROUP_ROWS = 5_000_000
# Accuracy of the sketch that brackets quantiles.
SKETCH_ACCURACY = 10_000


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    totals: Sequence[str],
    by: Sequence[str] = (),
    next_of: str | None = None,
) -> DataFrame:
    """Running sums `run_<c>` and whole sums `all_<c>` of the columns `totals` in the given order, per `by` group.

    The frame is range-partitioned on (by, order), each range is summed on its own, and the sums of
    the ranges before it are added: neither a long group nor the whole frame meets in one task.
    Callers aggregate to one row per order key first, so equal keys cannot pile up in a range.
    The ranges come from sampling, hence the checkpoint that pins them. `next_of` names an
    ascending order column for which `next_<c>` holds the following value.
    """
    shared_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()).checkpoint()
    )
    sums = [F.sum(c).alias(f"_sum_{c}") for c in totals]
    if next_of:
        sums.append(F.min(next_of).alias("_first"))
    # One row per (group, range): bounded by the number of groups and shuffle partitions.
    ranges = ranged.groupBy(*by, "_range").agg(*sums)
    across = Window.partitionBy(*by).orderBy("_range")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *by,
        "_range",
        *[F.sum(f"_sum_{c}").over(earlier).alias(f"_before_{c}") for c in totals],
        *[F.sum(f"_sum_{c}").over(Window.partitionBy(*by)).alias(f"all_{c}") for c in totals],
        *([F.lead("_first").over(across).alias("_next_first")] if next_of else []),
    )
    inside = Window.partitionBy(*by, "_range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select(
        "*",
        *[F.sum(c).over(upto).alias(f"_local_{c}") for c in totals],
        *([F.lead(next_of).over(inside).alias("_local_next")] if next_of else []),
    )
    result = local.join(offsets, [*by, "_range"])
    if next_of:
        result = result.withColumn(f"next_{next_of}", F.coalesce("_local_next", "_next_first"))
    for c in totals:
        result = result.withColumn(f"run_{c}", F.col(f"_local_{c}") + F.coalesce(f"_before_{c}", F.lit(0)))
    sums_out = [f"{kind}_{c}" for c in totals for kind in ("run", "all")]
    keep = [*df.columns, *sums_out, *([f"next_{next_of}"] if next_of else [])]
    return result.select(*keep)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Linearly interpolated quantiles `q_<i>`, one row per `by` group (one row when `by` is empty).

    The narrow frame of keys and values is stored first, and all further passes read it. A sketch brackets each
    quantile; rows outside the brackets are only counted, and the few inside are added up per distinct value and
    put in order. No task or driver receives all values of a group, which the built-in exact percentile needs.
    """
    keys = list(by) or ["_all"]
    source = (df if by else df.withColumn("_all", F.lit(0))).where(F.col(value).isNotNull())
    shared_dir(df.sparkSession)
    source = source.select(*keys, F.col(value).cast("double").alias("_v")).checkpoint()
    # A bracket reaches three rows and three errors of the sketch to either side at least; of the widths
    # asked for, each group takes the least that does.
    widths = [3.0 / accuracy * 4**j for j in range(math.ceil(math.log(accuracy / 3, 4)) + 1)]
    ends = [min(max(p + d, 0.0), 1.0) for p in probs for w in widths for d in (-w, w)]
    sketch = source.groupBy(*keys).agg(
        F.count("*").alias("_total"), F.percentile_approx("_v", ends, accuracy).alias("_ends")
    )
    wide = F.ceil(F.log(accuracy / F.col("_total")) / math.log(4))
    wide = F.least(F.lit(len(widths) - 1), F.greatest(F.lit(0), wide)).cast("int")
    bounds = []
    for i in range(len(probs)):
        at = wide * 2 + 2 * len(widths) * i
        bounds.append(F.get("_ends", at).alias(f"_from_{i}"))
        bounds.append(F.get("_ends", at + 1).alias(f"_to_{i}"))
    brackets = sketch.select(*keys, "_total", *bounds).checkpoint()  # one row per group
    placed = source.join(brackets, keys)
    inside = F.lit(False)
    for i in range(len(probs)):
        inside = inside | F.col("_v").between(F.col(f"_from_{i}"), F.col(f"_to_{i}"))
    skipped = placed.where(~inside).groupBy(*keys).agg(
        *[F.count_if(F.col("_v") < F.col(f"_from_{i}")).alias(f"_skip_{i}") for i in range(len(probs))]
    )
    counts = placed.where(inside).groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    ranked = running_totals(counts, ["_v"], ["_n"], by=keys)
    groups = brackets.join(skipped, keys, "left")
    ranked = ranked.join(groups, keys)
    picks = []
    for i, p in enumerate(probs):
        at = (F.col("_total") - 1) * F.lit(float(p))
        upto = F.col("run__n") + F.coalesce(f"_skip_{i}", F.lit(0))
        mine = F.col("_v") >= F.col(f"_from_{i}")
        picks.append(F.min(F.when(mine & (upto > F.floor(at)), F.col("_v"))).alias(f"_lo_{i}"))
        picks.append(F.min(F.when(mine & (upto > F.ceil(at)), F.col("_v"))).alias(f"_hi_{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_w_{i}"))
    row = ranked.groupBy(*keys).agg(*picks)
    return row.select(
        *by,
        *[
            (F.col(f"_lo_{i}") + (F.col(f"_hi_{i}") - F.col(f"_lo_{i}")) * F.col(f"_w_{i}")).alias(f"q_{i}")
            for i in range(len(probs))
        ],
    )


def time_chunks(df: DataFrame, key: str, ts: str, max_rows: int = MAX_GROUP_ROWS, slot_s: int = 60) -> DataFrame:
    """Cut the keys with more than `max_rows` rows into chunks of consecutive time slots: adds `_chunk`.

    Ordinary keys keep one chunk (number 0); a cut key gets chunks 1, 2, ... in time order, without
    gaps in the numbers. Rows with the same time always share a chunk.

    One plan for all sizes: the rows per key and slot are counted and stored, the slots of the keys over the
    limit (at most all rows / max_rows of them) get their chunk, and that table, empty when no key is over it, is
    joined to the rows.
    """
    shared_dir(df.sparkSession)
    slot = F.floor(F.unix_micros(ts) / F.lit(slot_s * 1_000_000))
    per_slot = df.groupBy(key, slot.alias("_slot")).agg(F.count("*").alias("_n")).checkpoint()
    heavy = per_slot.groupBy(key).agg(F.sum("_n").alias("_n")).where(F.col("_n") > max_rows).select(key)
    in_time = Window.partitionBy(key).orderBy("_slot")
    earlier = in_time.rowsBetween(Window.unboundedPreceding, -1)
    slots = (
        per_slot.join(heavy, key, "left_semi")
        .withColumn("_piece", F.floor(F.coalesce(F.sum("_n").over(earlier), F.lit(0)) / F.lit(max_rows)))
        .withColumn("_chunk", F.dense_rank().over(Window.partitionBy(key).orderBy("_piece")))
        .select(key, "_slot", "_chunk")
        .checkpoint()
    )
    cut = df.withColumn("_slot", slot).join(slots, [key, "_slot"], "left").drop("_slot")
    cut = cut.withColumn("_chunk", F.coalesce("_chunk", F.lit(0)))
    # An explicit exchange: a plan already hashed on the key alone would otherwise keep the skew.
    return cut.repartition(key, "_chunk")


def with_history(chunked: DataFrame, key: str, order: Sequence[str], rows: int) -> DataFrame:
    """Give every chunk of a cut key the last `rows` rows before it, marked `_carried`.

    Each chunk holds at least one row, so the last rows of the `rows` chunks before it suffice.
    """
    latest = Window.partitionBy(key, "_chunk").orderBy(*[F.desc(c) for c in order])
    tail = (
        chunked.where(F.col("_chunk") > 0)
        .withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") <= rows)
        .drop("_rank")
    )
    carried = tail.withColumn(
        "_chunk", F.explode(F.sequence(F.col("_chunk") + 1, F.col("_chunk") + rows))
    ).withColumn("_carried", F.lit(True))
    both = chunked.withColumn("_carried", F.lit(False)).unionByName(carried)
    return both.repartition(key, "_chunk")
