"""Trailing counters on a stream: equal to the batch form, in any order of arrival; state goes with the watermark."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwatch.operators.windows import trailing_counters
from cardwatch.session import run_dir
from cardwatch.streaming.trailing import trailing_stream

SCHEMA = "transaction_bk string, client_id string, event_ts timestamp, amount decimal(12,2)"
START = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def rows_of(n, seed):
    """A hot client with a third of all rows, a null client, equal instants, null amounts and edges of one span."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        client = rng.choice(["hot", "a", None] if i % 2 else ["hot", "b", "c"])
        at = START + datetime.timedelta(minutes=rng.randrange(60 * 12), seconds=rng.choice([0, 0, 30]), microseconds=rng.choice([0, 1]))
        out.append((f"T{i}", client, at, rng.choice([None, rng.randrange(10_000) / 100])))
    return out


def feed(spark, waves, pieces):
    root = run_dir(spark, "trailing-test")
    frame = None
    progress = None
    for i, wave in enumerate(waves):
        frame = spark.createDataFrame([(k, c, t, None if a is None else Decimal(str(a))) for k, c, t, a in wave], SCHEMA)
        frame.write.parquet(f"{root}/in/{i}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in/*")
        counted = trailing_stream(stream, delay="6 hours", pieces=pieces)
        query = counted.writeStream.option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start(f"{root}/out", format="parquet")
        query.awaitTermination()
        progress = query.lastProgress or progress
    return spark.read.parquet(f"{root}/out"), progress


@pytest.mark.parametrize("pieces", [1, 4])
def test_equals_the_batch_form(spark, pieces):
    rows = rows_of(240, 3)
    # the first two waves overlap by hours, the third only moves the watermark behind them all
    early = [r for r in rows if r[2] < START + datetime.timedelta(hours=6)]
    late = [r for r in rows if r[2] >= START + datetime.timedelta(hours=3) and r not in early]
    mark = [("end", "z", START + datetime.timedelta(days=2), 1)]
    got, progress = feed(spark, [early[::-1], late, mark], pieces)
    all_rows = spark.createDataFrame([(k, c, t, None if a is None else Decimal(str(a))) for k, c, t, a in early + late], SCHEMA)
    want = trailing_counters(all_rows)
    columns = ["transaction_bk", "client_id", "event_ts", "n_trailing", F.coalesce("amount_trailing", F.lit(0.0)).alias("amount_trailing")]
    found, expected = (sorted(df.select(*columns).collect(), key=lambda r: r["transaction_bk"]) for df in (got, want))
    assert len(found) == len(rows) and found == expected
    # of all clients only the one of the last row has state, in its slot and those after it
    assert progress["stateOperators"][0]["numRowsTotal"] == 1 + pieces


def test_state_is_kept_by_spark_and_no_python_runs_per_group(spark):
    stream = spark.readStream.format("rate").load().select(
        F.lit("x").alias("transaction_bk"), F.lit("c").alias("client_id"), F.col("timestamp").alias("event_ts"), F.lit(1).alias("amount")
    )
    plan = trailing_stream(stream)._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsInPandasWithState" not in plan and "Aggregate" in plan


def test_pieces_divide_the_span(spark):
    stream = spark.readStream.format("rate").load().select(
        F.lit("x").alias("transaction_bk"), F.lit("c").alias("client_id"), F.col("timestamp").alias("event_ts"), F.lit(1).alias("amount")
    )
    with pytest.raises(ValueError):
        trailing_stream(stream, span_s=10, pieces=3)
