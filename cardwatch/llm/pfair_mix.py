"""Mixing sources to target weights by Pfair scheduling, with DataFrame and SQL functions only.

A source's text is a row of blocks of `block_chars` characters; a document lies in the block that its first
character falls into. With integer weights n of sum D, block k of a source with weight n may take a slot from
its release floor(k * D / n) on and must have one before its deadline ceil((k + 1) * D / n). Earliest
deadline first gives every block a slot inside its window, so in each prefix of the slots every source is
less than one block away from its share. The windows repeat after D slots, in which each source has exactly
n blocks, so one such period is scheduled (its size depends on weights, not on documents) and block k goes
to slot k / n * D plus its slot in the period.

No row is dropped or repeated: when a source has no more blocks its slots stay empty, and the others go on
in the same proportions. Documents of a source are taken in the order of a hash of their id. The order of
the mixture is (slot, block_offset, order_key).

Defined results: null and empty texts have no characters and lie where the text before them ends. A null
source is a source of its own. Equal ids follow the hash of their text, repeated rows lie side by side. An
empty table gives an empty one. Columns named like one of the result are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_CHARS = 65_536
#: Slots that a source with all the text would get; the default weights grow with the root of a source's text.
SLOTS = 100
#: Documents of a source are numbered in so many ranges of their hash first (a power of 16).
RANGE_DIGITS = 3


def root_weights(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Integer weight of each source: `slots` times the root of its share of all characters, one at least."""
    sizes = docs.groupBy(_key().alias("mix_source")).agg(F.sum(_chars()).alias("chars"))
    sizes = sizes.withColumn("total", F.sum("chars").over(Window.partitionBy(F.lit(0))))  # a row per source
    share = F.when(F.col("total") > 0, F.col("chars") / F.col("total")).otherwise(0.0)
    return sizes.select(
        "mix_source", F.greatest(F.lit(1), F.floor(slots * F.sqrt(share))).cast("bigint").alias("n")
    )


def _key():
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _chars():
    return F.coalesce(F.length("text"), F.lit(0)).cast("bigint")


def schedule(weights: DataFrame) -> DataFrame:
    """mix_source, n, period (sum of all n), k and slot: one period of the schedule by earliest deadline first."""
    packed = weights.where("n > 0").agg(
        F.sort_array(F.collect_list(F.struct("mix_source", "n"))).alias("w"), F.sum("n").alias("period")
    )
    ready = """
        array_min(transform(
            filter(transform(w, (x, i) -> struct(i, x.n AS n, state.done[i] AS k)),
                   x -> x.k < x.n AND (x.k * period) div x.n <= t),
            x -> struct(((x.k + 1) * period + x.n - 1) div x.n AS deadline, x.i AS i, x.k AS k)))
    """
    fold = f"""
        aggregate(sequence(0L, period - 1),
            struct(transform(w, x -> 0L) AS done, cast(array() AS array<struct<i: int, k: bigint>>) AS slots),
            (state, t) -> transform(array({ready}), p -> struct(
                transform(state.done, (d, i) -> d + if(i = p.i, 1L, 0L)) AS done,
                concat(state.slots, array(struct(p.i AS i, p.k AS k))) AS slots))[0],
            state -> state.slots)
    """
    return (
        packed.where("period > 0")
        .withColumn("slots", F.expr(fold))
        .select("w", "period", F.posexplode("slots").alias("slot", "p"))
        .select(
            F.expr("w[p.i].mix_source").alias("mix_source"),
            F.expr("w[p.i].n").alias("n"),
            "period",
            F.col("p.k").alias("k"),
            F.col("slot").cast("bigint").alias("slot"),
        )
    )


def mix(
    docs: DataFrame, keep: list[str], weights: DataFrame | None = None, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Columns `keep` of every row, chars, block, slot, block_offset and order_key.

    `weights` has mix_source ('=' and the source's name, '' for null) and the integer n > 0 of every source.
    """
    weights = weights if weights is not None else root_weights(docs)
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text_digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    mine = ["chars", "block", "slot", "block_offset", "order_key"]
    keep = [c for c in keep if c not in mine]
    rows = docs.select(
        *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)),
        _key().alias("mix_source"),
        _chars().alias("chars"),
        F.concat_ws("-", digest, text_digest).alias("order_key"),
    ).withColumn("range", F.substring("order_key", 1, RANGE_DIGITS))
    ranges = docs.select(_key().alias("mix_source"), _chars().alias("chars"), F.substring(digest, 1, RANGE_DIGITS).alias("range"))
    sums = ranges.groupBy("mix_source", "range").agg(F.sum("chars").alias("own"))
    over = Window.partitionBy("mix_source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("mix_source", "range", F.coalesce(F.sum("own").over(over), F.lit(0)).alias("before"))
    within = Window.partitionBy("mix_source", "range").orderBy("order_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("chars").over(within), F.lit(0))).join(before, ["mix_source", "range"])
    begin = F.col("before") + F.col("inside")
    placed = placed.withColumn("block", F.expr(f"(before + inside) div {block_chars}")).withColumn(
        "block_offset", begin % block_chars
    )
    plan = schedule(weights)
    periods = plan.select("mix_source", "n", "period").distinct()
    slots = plan.select("mix_source", "k", F.col("slot").alias("in_period"))
    return (
        placed.join(periods, "mix_source")
        .withColumn("k", F.expr("block % n"))
        .join(slots, ["mix_source", "k"])
        .select(
            *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)),
            "chars",
            "block",
            F.expr("(block div n) * period + in_period").alias("slot"),
            "block_offset",
            "order_key",
        )
    )
