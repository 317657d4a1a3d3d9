"""Trailing counters on a stream: rows are gathered in sliding windows, which come out when the watermark has passed them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.session import with_package
from cardwatch.streaming.ingest import DEDUP_MEMORY


def trailing_stream(
    events: DataFrame,
    span_s: int = 3600,
    delay: str = DEDUP_MEMORY,
    key: str = "client_id",
    ts: str = "event_ts",
    amount: str = "amount",
    bk: str = "transaction_bk",
    pieces: int = 1,
) -> DataFrame:
    """Count `n_trailing` and sum `amount_trailing` of the client's rows in (t - span, t] for each streamed row.

    Equal to `windows.trailing_counters`, in whatever order rows come within `delay`. Time is cut into slots of
    span / pieces; a window is a slot with the `pieces` slots before it, which are its context. Spark's state is that of
    a client and window, so a busy client is spread over windows, and more pieces make smaller ones for more copies. When
    the watermark passes a window's end the rows of its last slot come out and its state goes, also that of a client who
    is silent since. Rows of a null client are one client. A row without a time is dropped, as the batch form has no
    place for it either; one without an amount counts with nothing.
    """
    if span_s % pieces:
        raise ValueError("the span must be a whole number of seconds times the pieces")
    span, slot_s = span_s * 1_000_000, span_s // pieces
    cents = F.coalesce((F.col(amount).cast("decimal(18,2)") * 100).cast("bigint"), F.lit(0))
    row = F.struct(F.unix_micros(ts).alias("at"), cents.alias("cents"), F.col(bk).alias("bk"))
    gathered = (
        events.where(F.col(ts).isNotNull())
        .withWatermark(ts, f"{delay} 1 millisecond")  # a window whose end the watermark only touches stays open
        .groupBy(key, F.window(ts, f"{span_s + slot_s} seconds", f"{slot_s} seconds").alias("w"))
        .agg(F.collect_list(row).alias("rows"))
        .select(key, F.unix_micros("w.start").alias("_start"), F.col("rows.at").alias("_at"), F.col("rows.cents").alias("_cents"), F.col("rows.bk").alias("_bk"))
    )
    names = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    ddl = f"`{bk}` {names[bk]}, `{key}` {names[key]}, _at bigint, n_trailing bigint, _sum bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _count(batch, key, bk, span, span + slot_s * 1_000_000)

    with_package(events.sparkSession)
    counted = gathered.mapInArrow(work, ddl)
    return counted.select(
        bk, key, F.timestamp_micros("_at").alias(ts), "n_trailing", (F.col("_sum") / 100.0).cast("double").alias("amount_trailing")
    )


def _count(batch: pa.RecordBatch, key: str, bk: str, span: int, width: int) -> pa.RecordBatch:
    """Counters of the rows in the last slot of each window of a batch; the windows lie side by side on one axis."""
    lists = batch.column("_at")
    window = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    at, cents = (batch.column(c).flatten().to_numpy() for c in ("_at", "_cents"))
    inside = at - batch.column("_start").to_numpy()[window]
    place = window * (width + span) + inside
    order = np.argsort(place, kind="stable")
    place, upto = place[order], np.concatenate([[0], np.cumsum(cents[order])])
    own = np.flatnonzero(inside[order] >= span)
    lo, hi = np.searchsorted(place, place[own] - span, "right"), np.searchsorted(place, place[own], "right")
    picked = order[own]
    columns = [
        batch.column("_bk").flatten().take(pa.array(picked)), batch.column(key).take(pa.array(window[picked])),
        pa.array(at[picked]), pa.array(hi - lo), pa.array(upto[hi] - upto[lo]),
    ]
    return pa.RecordBatch.from_arrays(columns, [bk, key, "_at", "n_trailing", "_sum"])
