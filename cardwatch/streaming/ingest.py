"""Streaming ingestion: validate, stage once, load facts, refresh client counters, log."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardwatch import schema
from cardwatch.operators.dimensions import Dims
from cardwatch.operators.load import FACT_COLUMNS, load_facts, stage_insert, unseen
from cardwatch.operators.windows import session_counters
from cardwatch.sources.events import ARRIVAL, numbered
from cardwatch.sources.logs import RUN_LOG, run_log_event
from cardwatch.sources.tables import exists, read_or_empty
from cardwatch.streaming.store import FOLD, Commits, KeyIndex, Snapshots, counter_bucket
from cardwatch.streaming.validate import dead_letters, judge_events, valid_events

# Fixed value: seconds between micro-batches.
FLUSH_SECONDS = 2
DEDUP_MEMORY = "24 hours"
COUNTER_GAP_S = 3600

STAGED = T.StructType([*schema.STAGING.fields, T.StructField("arrival", ARRIVAL), T.StructField("batch_id", T.LongType())])
STATE = T.StructType(
    [
        T.StructField("client_id", T.StringType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("nb_tx_1h", T.LongType()),
        T.StructField("amount_1h", T.DoubleType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


FACT_KEYS = T.StructType(
    [
        T.StructField("transaction_bk", T.StringType()),
        T.StructField("ingestion_mode", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Warehouse:
    """Folders of the ingested tables. Every micro-batch owns one partition in each of them, which a
    replay overwrites, and its rows are visible in all tables from the moment it is committed.
    """

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def commits(self) -> Commits:
        return Commits(self.path("commits"))

    @property
    def keys(self) -> KeyIndex:
        return KeyIndex(self.path("key-index"))

    @property
    def snapshots(self) -> Snapshots:
        return Snapshots(self.path("counter-snapshots"))

    def part(self, name: str, batch_id: int) -> str:
        """Folder of a batch in a table."""
        inner = "/ingestion_mode=stream" if name == "facts" else ""
        return f"{self.path(name)}{inner}/batch_id={batch_id}"

    def batches(self, spark: SparkSession, name: str, schema_: T.StructType, ids: list[int]) -> DataFrame:
        """The rows of some batches, without listing the others."""
        paths = [p for p in (self.part(name, b) for b in ids) if exists(spark, p)]
        if not paths:
            return spark.createDataFrame([], schema_)
        return spark.read.schema(schema_).option("basePath", self.path(name)).parquet(*paths)

    def staged(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.path("staging"), STAGED).where(self.commits.listed(spark))

    def pending(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Staged rows that the given micro-batch left unresolved, its own and earlier ones."""
        listed = self.commits.before(spark, batch_id + 1) == batch_id
        return self.batches(spark, "pending", STAGED, [batch_id] if listed else [])

    def batch_facts(self, spark: SparkSession) -> DataFrame | None:
        """Keys of the facts that batch loads have stored beside those of the stream, if there are any."""
        if not exists(spark, f"{self.path('facts')}/ingestion_mode=batch"):
            return None
        stored = read_or_empty(spark, self.path("facts"), FACT_KEYS)
        return stored.where(F.col("ingestion_mode") == "batch").select("transaction_bk")

    def facts(self, spark: SparkSession) -> DataFrame:
        stored = spark.read.parquet(self.path("facts"))
        return stored.where(self.commits.listed(spark) | (F.col("ingestion_mode") == "batch"))

    def dead_letters(self, spark: SparkSession) -> DataFrame:
        dead = spark.read.schema("raw string, reason string, envelope string, batch_id bigint").parquet(self.path("dlq"))
        return dead.where(self.commits.listed(spark))

    def run_log(self, spark: SparkSession) -> DataFrame:
        """Finished batches that count, and failed attempts."""
        fields = [*RUN_LOG.fields, T.StructField("batch_id", T.LongType())]
        log = read_or_empty(spark, self.path("runs"), T.StructType(fields))
        return log.where(self.commits.listed(spark) | (F.col("status") == "ERROR"))

    def counter_states(self, spark: SparkSession, before: int | None = None, clients: DataFrame | None = None) -> DataFrame:
        """States of the clients: those of the last snapshot, and the changes since."""
        before = (1 << 62) if before is None else before
        upto = self.snapshots.last(spark, before)
        since = self.commits.ids(spark, -1 if upto is None else upto + 1, before)
        deltas = self.batches(spark, "counters", STATE, since)
        if clients is not None:
            clients = clients.select("client_id", counter_bucket("client_id").alias("bucket")).distinct()
            deltas = deltas.join(clients, "client_id", "left_semi")
        if upto is None:
            return deltas
        schema_ = T.StructType([*STATE.fields, T.StructField("bucket", T.IntegerType())])
        stored = spark.read.schema(schema_).parquet(self.snapshots.path(upto))
        if clients is not None:
            stored = stored.join(clients, ["bucket", "client_id"], "left_semi")
        return stored.select(*STATE.fieldNames()).unionByName(deltas)

    def counters(self, spark: SparkSession) -> DataFrame:
        """Latest counters of every client."""
        return latest_counters(self.counter_states(spark))

    def fold(self, spark: SparkSession, batch_id: int) -> None:
        """Merge index segments that end with a committed batch, and publish a snapshot of the counters every so often.

        Done when the next batch begins, as a batch may run again until then and must find what was before it.
        """
        self.keys.fold(spark, batch_id)
        if (batch_id + 1) % FOLD == 0:
            states = self.counter_states(spark, batch_id + 1)
            last = F.max_by(F.struct("last_ts", "nb_tx_1h", "amount_1h", "batch_id"), "batch_id").alias("s")
            self.snapshots.publish(states.groupBy("client_id").agg(last).select("client_id", "s.*"), batch_id)


def latest_counters(states: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("last_ts", "nb_tx_1h", "amount_1h"), "batch_id").alias("s")
    return states.groupBy("client_id").agg(last).select("client_id", "s.*")


def _put(df: DataFrame, path: str) -> None:
    """The rows of one batch as their own folder, which a replay replaces, also by no rows."""
    df.write.mode("overwrite").parquet(path)


def _together(spark: SparkSession, *work: Callable[[], None]) -> None:
    """Run independent writes at the same time; small batches wait for schedulers and file systems, not for cores."""
    with ThreadPoolExecutor(len(work)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(w)) for w in work]:
            done.result()


def next_counters(facts: DataFrame, before: DataFrame, gap_s: int = COUNTER_GAP_S) -> DataFrame:
    """Counters of the batch's clients after the batch, given their states before it.

    A client whose rows never paused for `gap_s` seconds continues the count it had.
    """
    rows = facts.select("transaction_bk", "client_id", "event_ts", F.col("amount").cast("decimal(12,2)").alias("amount"))
    counted = session_counters(rows, gap_s)
    now = counted.groupBy("client_id").agg(
        F.min("event_ts").alias("_first"),
        F.max("event_ts").alias("last_ts"),
        F.count("*").alias("_rows"),
        F.max_by(F.struct("n_session", "amount_session"), F.struct("event_ts", "transaction_bk")).alias("_s"),
    )
    known = latest_counters(before).select(
        "client_id",
        F.col("last_ts").alias("_seen"),
        F.col("nb_tx_1h").alias("_n"),
        F.col("amount_1h").alias("_amount"),
    )
    silent = F.unix_micros("_first") - F.unix_micros("_seen") >= F.lit(gap_s * 1_000_000)
    goes_on = F.coalesce((F.col("_s.n_session") == F.col("_rows")) & ~silent, F.lit(False))
    return now.join(known, "client_id", "left").select(
        "client_id",
        F.greatest("last_ts", "_seen").alias("last_ts"),
        (F.col("_s.n_session") + F.when(goes_on, F.col("_n")).otherwise(0)).cast("long").alias("nb_tx_1h"),
        F.round(F.col("_s.amount_session") + F.when(goes_on, F.col("_amount")).otherwise(0.0), 2).alias("amount_1h"),
    )


def ingest_batch(
    raw: DataFrame,
    batch_id: int,
    dims: Dims | Callable[[], Dims],
    house: Warehouse,
    known: DataFrame | None = None,
) -> None:
    """One micro-batch. The offsets are committed only when it returns, so a failed batch runs again.

    Of several messages with one key the first to arrive counts, by its place in the source (`arrival`); where the
    source tells none, the earliest. Keys of earlier batches are looked up in the index of keys.

    `known` holds rows that other loads have stored; their business keys count as duplicates too. By default
    these are the batch facts beside the stream's own. Rows that the batch before left unresolved are tried
    again, and `dims` may be a function, called for each batch, so that new members are seen.
    """
    spark = raw.sparkSession
    dims = dims() if callable(dims) else dims
    known = house.batch_facts(spark) if known is None else known
    before = house.commits.before(spark, batch_id)
    began = time.monotonic()
    run = {"run_id": f"stream-{batch_id}", "source": "stream", "mode": "stream"}
    # the text of a valid message is not needed any more
    judged = judge_events(numbered(raw)).withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw"))).persist()
    valid = valid_events(judged).withColumn("ingested_at", F.current_timestamp())
    once = stage_insert(valid, None, ("arrival", "event_ts", "amount", "channel")).persist()
    try:
        if before is not None:
            house.fold(spark, before)
        fresh = once
        for stored in (house.keys.known(once.select("transaction_bk"), batch_id), known):
            fresh = fresh if stored is None else unseen(fresh, stored)
        _put(fresh, house.part("staging", batch_id))
        mine = house.batches(spark, "staging", STAGED, [batch_id])
        staged = mine.count()
        waiting = house.pending(spark, -1 if before is None else before)
        loaded = load_facts(mine.unionByName(waiting), dims, mode="stream")
        facts = loaded.facts.select(*[c for c in FACT_COLUMNS if c != "ingestion_mode"])
        states = house.counter_states(spark, batch_id, mine)
        _together(
            spark,
            lambda: _put(dead_letters(judged), house.part("dlq", batch_id)),
            lambda: _put(facts, house.part("facts", batch_id)),
            lambda: _put(loaded.rejects.select(*mine.columns).drop("batch_id"), house.part("pending", batch_id)),
            lambda: _put(next_counters(mine, states), house.part("counters", batch_id)),
            lambda: house.keys.add(mine, batch_id, staged),
        )
        sizes = judged.agg(F.count("*").alias("n"), F.count("reason").alias("bad")).first()
        done = run_log_event(
            spark,
            **run,
            status="OK",
            n_rows=staged,
            n_rejected=sizes["bad"],
            n_duplicates=sizes["n"] - sizes["bad"] - staged,
            duration_ms=int((time.monotonic() - began) * 1000),
        )
        _put(done, house.part("runs", batch_id))
        house.commits.add(spark, batch_id)
    except Exception as exc:
        failed = run_log_event(spark, **run, status="ERROR", message=str(exc))
        _put(failed, house.part("runs", batch_id))
        raise
    finally:
        once.unpersist()
        judged.unpersist()


def start_ingestion(
    raw: DataFrame,
    dims: Dims | Callable[[], Dims],
    house: Warehouse,
    checkpoint: str,
    available_now: bool = False,
    known: DataFrame | None = None,
) -> StreamingQuery:
    """Run the ingestion on a raw event stream; `available_now` drains what is there and ends.

    The source limits a micro-batch (`kafka_events` to 200 messages by default).
    """
    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: ingest_batch(df, batch_id, dims, house, known)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{FLUSH_SECONDS} seconds").start()


def totals(log: DataFrame) -> DataFrame:
    """Ingested, rejected and duplicate messages over all finished batches."""
    return log.where(F.col("status") == "OK").agg(
        F.sum("n_rows").alias("ingested"),
        F.sum("n_rejected").alias("rejected"),
        F.sum("n_duplicates").alias("duplicates"),
    )


def retry_pending(spark: SparkSession, dims: Dims, house: Warehouse) -> DataFrame:
    """Facts of staged rows that could not be resolved when they arrived, for example of new clients."""
    return load_facts(house.staged(spark), dims, house.facts(spark), "stream").facts


def drop_seen(
    events: DataFrame,
    memory: str = DEDUP_MEMORY,
    ts: str = "event_ts",
    key: str = "transaction_bk",
    salts: int = 8,
) -> DataFrame:
    """Streaming de-duplication that remembers a key for the given time.

    Copies are first dropped per key and source partition, so that a key with very many copies is not one
    task's work, and then per key.
    """
    watched = events.withWatermark(ts, memory)
    if salts > 1:
        salted = watched.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        watched = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return watched.dropDuplicatesWithinWatermark([key])


def closed_sessions(
    events: DataFrame, gap_s: int = COUNTER_GAP_S, delay: str = "24 hours", ts: str = "event_ts"
) -> DataFrame:
    """Count and amount of each finished activity session per client, as a stream.

    Events are merged into sessions before the shuffle, so a busy client sends few rows per task.
    """
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        events.withWatermark(ts, delay)
        .groupBy("client_id", F.session_window(ts, f"{gap_s} seconds").alias("w"))
        .agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
        .select("client_id", F.col("w.start").alias("start_ts"), F.col("w.end").alias("end_ts"), "n", "amount")
    )


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available to a parquet folder, then stop."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
