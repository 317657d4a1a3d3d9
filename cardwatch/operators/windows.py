"""Per-client sequences and activity counters, and temporal splits.

A client may hold a large share of all rows. Such a client is cut into chunks of consecutive time slots
(`time_chunks`), and each chunk receives what it needs from the chunks before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.spread import (
    MAX_GROUP_ROWS,
    exact_quantiles,
    running_totals,
    time_chunks,
    with_history,
)

STEP_FIELDS = ("amount", "home_distance_km", "hour", "channel", "auth_method")


def sequences(
    df: DataFrame,
    length: int = 5,
    fields: Sequence[str] = STEP_FIELDS,
    key: str = "client_id",
    ts: str = "event_ts",
    bk: str = "transaction_bk",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Every row with its `length - 1` predecessors of the same client as an array `steps`, oldest first.

    Rows with fewer predecessors give no sequence; all columns of the target row are kept.
    """
    rows = with_history(time_chunks(df, key, ts, max_rows), key, [ts, bk], length - 1)
    w = Window.partitionBy(key, "_chunk").orderBy(ts, bk).rowsBetween(-(length - 1), 0)
    return (
        rows.withColumn("steps", F.collect_list(F.struct(*fields)).over(w))
        .where(~F.col("_carried") & (F.size("steps") == length))
        .drop("_carried", "_chunk")
    )


def session_counters(
    df: DataFrame,
    gap_s: int = 3600,
    key: str = "client_id",
    ts: str = "event_ts",
    bk: str = "transaction_bk",
    amount: str = "amount",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Running count `n_session` and sum `amount_session` that restart after `gap_s` seconds of silence."""
    chunked = time_chunks(df, key, ts, max_rows)
    w = Window.partitionBy(key, "_chunk").orderBy(ts, bk)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    micros = F.unix_micros(ts)
    gap = F.lit(gap_s * 1_000_000)
    opens = F.coalesce(micros - F.lag(micros).over(w) >= gap, F.lit(False))
    value = F.col(amount).cast("decimal(38,2)")
    counted = chunked.withColumns(
        {"_opens": opens, "_n": F.row_number().over(w), "_s": F.sum(value).over(upto)}
    )
    # Totals before the latest restart inside the chunk; NULL while the chunk has not restarted yet.
    counted = counted.withColumns(
        {
            "_base_n": F.last(F.when(F.col("_opens"), F.col("_n") - 1), ignorenulls=True).over(upto),
            "_base_s": F.last(F.when(F.col("_opens"), F.col("_s") - value), ignorenulls=True).over(upto),
        }
    )
    counted = counted.withColumns(
        {
            "n_session": F.col("_n") - F.coalesce("_base_n", F.lit(0)),
            "amount_session": F.col("_s") - F.coalesce("_base_s", F.lit(0)),
        }
    )
    counted = _carry_sessions(counted, key, ts, bk, gap)
    return counted.select(
        *df.columns,
        F.col("n_session").cast("long").alias("n_session"),
        F.col("amount_session").cast("double").alias("amount_session"),
    )


def _carry_sessions(counted: DataFrame, key: str, ts: str, bk: str, gap) -> DataFrame:
    """Add the open session of the chunks before to the rows ahead of a chunk's first restart.

    The carry is computed on one row per chunk of the cut clients.
    """
    last = F.max_by(F.struct("n_session", "amount_session"), F.struct(ts, bk))
    chunks = (
        counted.where(F.col("_chunk") > 0)
        .groupBy(key, "_chunk")
        .agg(
            F.min(F.unix_micros(ts)).alias("_from"),
            F.max(F.unix_micros(ts)).alias("_to"),
            F.max("_opens").alias("_restarts"),
            last.alias("_tail"),
        )
    )
    by_time = Window.partitionBy(key).orderBy("_chunk")
    fresh = F.coalesce(F.col("_from") - F.lag("_to").over(by_time) >= gap, F.lit(True))
    chunks = chunks.withColumn("_fresh", fresh).withColumn(
        "_run", F.sum((F.col("_fresh") | F.col("_restarts")).cast("int")).over(by_time)
    )
    in_run = Window.partitionBy(key, "_run").orderBy("_chunk")
    chunks = chunks.withColumns(
        {
            "_open_n": F.sum("_tail.n_session").over(in_run),
            "_open_s": F.sum("_tail.amount_session").over(in_run),
        }
    )
    carry = chunks.select(
        key,
        "_chunk",
        F.when(~F.col("_fresh"), F.lag("_open_n").over(by_time)).alias("_carry_n"),
        F.when(~F.col("_fresh"), F.lag("_open_s").over(by_time)).alias("_carry_s"),
    )
    first_part = F.col("_base_n").isNull()
    return counted.join(carry, [key, "_chunk"], "left").withColumns(
        {
            "n_session": F.col("n_session")
            + F.when(first_part, F.coalesce("_carry_n", F.lit(0))).otherwise(0),
            "amount_session": F.col("amount_session")
            + F.when(first_part, F.coalesce("_carry_s", F.lit(0))).otherwise(0),
        }
    )


def trailing_counters(
    df: DataFrame,
    span_s: int = 3600,
    key: str = "client_id",
    ts: str = "event_ts",
    amount: str = "amount",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Count `n_trailing` and sum `amount_trailing` of the client's rows in (t - span, t].

    Each row enters at its time and leaves `span_s` seconds later; the counters are running sums over
    entries and exits, which stays linear however many rows one span holds.
    """
    moves = df.select(
        "*",
        F.explode(
            F.array(
                F.struct(F.col(ts).alias("at"), F.lit(1).alias("sign")),
                F.struct((F.col(ts) + F.expr(f"INTERVAL {span_s} SECONDS")).alias("at"), F.lit(-1).alias("sign")),
            )
        ).alias("_m"),
    ).select(
        *df.columns,
        F.col("_m.at").alias("_at"),
        F.col("_m.sign").alias("_sign"),
        (F.col(amount).cast("decimal(37,2)") * F.col("_m.sign")).alias("_delta"),
    )
    chunked = time_chunks(moves, key, "_at", max_rows)
    # A range frame, so that rows of the same instant count for each other.
    w = (
        Window.partitionBy(key, "_chunk")
        .orderBy(F.unix_micros("_at"))
        .rangeBetween(Window.unboundedPreceding, 0)
    )
    run = chunked.withColumns(
        {"n_trailing": F.sum("_sign").over(w), "amount_trailing": F.sum("_delta").over(w)}
    )
    sums = (
        chunked.where(F.col("_chunk") > 0)
        .groupBy(key, "_chunk")
        .agg(F.sum("_sign").alias("_n"), F.sum("_delta").alias("_d"))
    )
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        key,
        "_chunk",
        F.sum("_n").over(earlier).alias("_carry_n"),
        F.sum("_d").over(earlier).alias("_carry_d"),
    )
    run = run.join(carry, [key, "_chunk"], "left").withColumns(
        {
            "n_trailing": F.col("n_trailing") + F.coalesce("_carry_n", F.lit(0)),
            "amount_trailing": F.col("amount_trailing") + F.coalesce("_carry_d", F.lit(0)),
        }
    )
    return run.where(F.col("_sign") == 1).select(
        *df.columns,
        F.col("n_trailing").cast("long").alias("n_trailing"),
        F.col("amount_trailing").cast("double").alias("amount_trailing"),
    )


def split_positional(
    df: DataFrame, ratio: float = 0.8, ts: str = "event_ts", bk: str = "transaction_bk"
) -> DataFrame:
    """Adds `split`: train for the first int(n * ratio) rows in the order of time and key, test for the rest.

    The first test row is found from counts per hour and a running count inside one hour only, so no
    task sorts the whole table; the split itself is a comparison with that row.
    """
    hours = df.groupBy(F.date_trunc("hour", ts).alias("_hour")).agg(F.count("*").alias("_n"))
    in_time = Window.orderBy("_hour")  # one row per hour of the calendar
    placed = hours.withColumns(
        {
            "_upto": F.sum("_n").over(in_time),
            "_total": F.sum("_n").over(Window.partitionBy()),
        }
    ).withColumn("_cut", F.floor(F.col("_total") * F.lit(float(ratio))))
    spot = placed.where(F.col("_upto") > F.col("_cut")).orderBy("_hour").limit(1).first()
    if spot is None:
        return df.withColumn("split", F.lit("train"))
    hour = F.lit(spot["_hour"])
    inside = df.where((F.col(ts) >= hour) & (F.col(ts) < hour + F.expr("INTERVAL 1 HOUR")))
    ranked = running_totals(inside.select(ts, bk, F.lit(1).alias("_one")), [ts, bk], ["_one"])
    place = spot["_cut"] - (spot["_upto"] - spot["_n"]) + 1
    first_test = ranked.where(F.col("run__one") == place).first()
    at, key = F.lit(first_test[ts]), F.lit(first_test[bk])
    before = (F.col(ts) < at) | ((F.col(ts) == at) & (F.col(bk) < key))
    return df.withColumn("split", F.when(before, "train").otherwise("test"))


def split_quantile(df: DataFrame, q: float = 0.8, ts: str = "event_ts") -> DataFrame:
    """Adds `split`: train strictly before the interpolated time quantile, test from it on."""
    times = df.select(F.unix_micros(ts).alias("_us"))
    cut = exact_quantiles(times, "_us", [q]).select("q_0").scalar()
    return df.withColumn("split", F.when(F.unix_micros(ts) < cut, "train").otherwise("test"))


def split_summary(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Rows, frauds, fraud percentage and time range of each side."""
    return df.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("is_fraud")).alias("n_fraud"),
        F.bround(F.avg(F.col("is_fraud").cast("int")) * 100, 3).alias("fraud_rate_pct"),
        F.date_format(F.min(ts), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
        F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss").alias("last_ts"),
    )


def _keyed_hash(column: str, seed: int):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(column)))


def holdout_split(df: DataFrame, share: float = 0.1, seed: int = 42, bk: str = "transaction_bk") -> DataFrame:
    """Adds `is_validation` for about `share` of the rows, chosen by a hash of key and seed."""
    draw = F.conv(F.substring(_keyed_hash(bk, seed), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return df.withColumn("is_validation", draw < F.lit(share))


def sample_rows(df: DataFrame, n: int, seed: int = 42, bk: str = "transaction_bk") -> DataFrame:
    """`n` rows without replacement in the order of a keyed hash: the same rows on every run."""
    return df.orderBy(_keyed_hash(bk, seed), bk).limit(n)


def sample_with_replacement(df: DataFrame, share: float, seed: int = 42, bk: str = "transaction_bk") -> DataFrame:
    """Each row as often as a Poisson number of mean `share` says, drawn from a hash of key and seed.

    The same rows come on every run, however the rows are dealt. A draw has 32 bits, so the distribution is followed
    until what is left of it is far below one draw, whatever the share.
    """
    draw = F.conv(F.substring(_keyed_hash(bk, seed), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    steps, below, k = [], 0.0, 0
    while share > 0:
        term = math.exp(k * math.log(share) - share - math.lgamma(k + 1))
        if k > share and term < 1e-17:
            break
        below, k = below + term, k + 1
        steps.append(below)
    # the draw is bound to a variable, as it is asked at every step
    above = F.transform(F.array(draw), lambda d: F.size(F.filter(F.array(*map(F.lit, steps)), lambda step: step <= d)))
    copies = F.explode(F.array_repeat(F.lit(True), above[0] if steps else F.lit(0)))
    return df.withColumn("_copy", copies).drop("_copy")


def random_keys(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """`n` random key values; an empty table is an error."""
    keys = df.select(key).distinct()
    if keys.isEmpty():
        raise ValueError(f"no {key} to draw from")
    return keys.orderBy(_keyed_hash(key, seed), key).limit(n)
