"""Registered queries: every operator run over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardwatch import schema
from cardwatch.functions.scalar import category_index
from cardwatch.operators import (
    audit,
    dimensions,
    drift,
    evaluate,
    explain,
    learn,
    load,
    marts,
    prepare,
    profile,
    quality,
    score,
    windows,
)
from cardwatch.operators.oversample import oversample
from cardwatch.plans import inputs, models
from cardwatch.session import run_dir
from cardwatch.sources import logs, row_stream, tables
from cardwatch.sources.events import ARRIVAL
from cardwatch.streaming import ingest, labels, trailing, validate

Query = Callable[[SparkSession, str], DataFrame]

LABEL_BATCHES = 10
RATE_DIMENSIONS = ["channel", "auth_method", "segment", "unusual_country", "hour"]


def _text(ts: str) -> F.Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def load_facts(spark: SparkSession, src: str) -> DataFrame:
    facts = inputs.fact(spark, src)
    return facts.select(
        "transaction_bk",
        "client_id",
        *[F.col(c).cast("bigint").alias(c) for c in ("client_key", "time_key", "channel_key")],
        _text("event_ts").alias("event_time"),
        F.col("amount").cast("double").alias("amount"),
        "currency",
        "tx_country",
        "home_country",
        F.col("home_distance_km").cast("double").alias("home_distance_km"),
        "auth_method",
        F.coalesce(F.col("is_fraud").cast("string"), F.lit("open")).alias("label"),
        F.coalesce("fraud_type", F.lit("")).alias("fraud_type"),
        "ingestion_mode",
    )


def rejects(spark: SparkSession, src: str) -> DataFrame:
    loaded = load.load_facts(inputs.staging(spark, src), inputs.dims(spark, src))
    return loaded.rejects.select("transaction_bk", "client_id", "ingestion_mode")


def pending(spark: SparkSession, src: str) -> DataFrame:
    """What remains for the stream mode once the batch rows are loaded."""
    stored = inputs.fact(spark, src).where(F.col("ingestion_mode") == "batch")
    todo = load.pending(inputs.staging(spark, src), stored, "stream")
    return todo.groupBy("ingestion_mode").agg(F.count("*").alias("n_pending"))


def mart_kpis(spark: SparkSession, src: str) -> DataFrame:
    return marts.mart_kpis(inputs.fact(spark, src))


def mart_ingestion(spark: SparkSession, src: str) -> DataFrame:
    mart = marts.mart_ingestion(inputs.fact(spark, src))
    return mart.withColumns({c: _text(c) for c in ("first_write", "last_write")})


def mart_hourly(spark: SparkSession, src: str) -> DataFrame:
    mart = marts.mart_hourly(inputs.fact(spark, src), inputs.dims(spark, src).time)
    return mart.withColumn("hour", F.col("hour").cast("bigint"))


def mart_fraud_type(spark: SparkSession, src: str) -> DataFrame:
    return marts.mart_fraud_type(inputs.fact(spark, src))


def integrity_anti(spark: SparkSession, src: str) -> DataFrame:
    lost = quality.dangling(inputs.staging(spark, src), "client_id", inputs.dims(spark, src).client)
    return lost.groupBy("client_id").agg(F.count("*").alias("n_rows"))


def quality_suite(spark: SparkSession, src: str) -> DataFrame:
    return quality.run_checks(
        inputs.staging(spark, src),
        inputs.fact(spark, src),
        inputs.dims(spark, src),
        F.lit(inputs.AS_OF).cast("timestamp"),
        branches=25,
        channels=15,
    )


def check_log(spark: SparkSession, src: str) -> DataFrame:
    """The results of two check runs, appended to their log and read back: the latest of each check."""
    path = run_dir(spark, "check-log")
    results = quality_suite(spark, src)
    for hour in ("2024-02-01 00:00:00", "2024-02-01 01:00:00"):
        logs.log_results(results, path, F.lit(hour).cast("timestamp"))
    last = {c: F.max_by(c, "executed_at").alias(c) for c in results.columns if c != "check_name"}
    return spark.read.parquet(path).groupBy("check_name").agg(*last.values(), F.countDistinct("executed_at").alias("n_runs"))


def audit_log(spark: SparkSession, src: str) -> DataFrame:
    """The audit report, appended to its log and read back, with the totals of the run."""
    path = run_dir(spark, "audit-log")
    logs.log_results(audit_report(spark, src), path, F.lit(inputs.AS_OF).cast("timestamp"))
    return spark.read.parquet(path).drop("executed_at")


def load_log(spark: SparkSession, src: str) -> DataFrame:
    """Two batch loads of the same rows through the run log: the second one finds only what is still pending."""
    root = run_dir(spark, "load")
    for run in ("first", "second"):
        load.load_and_log(inputs.staging(spark, src), inputs.dims(spark, src), f"{root}/facts", f"{root}/log", run)
    state = logs.run_log_state(spark.read.parquet(f"{root}/log"))
    stored = spark.read.parquet(f"{root}/facts").count()
    return state.select("run_id", "mode", "status", "n_rows", F.lit(stored).cast("bigint").alias("n_stored"))


def constraint_violations(spark: SparkSession, src: str) -> DataFrame:
    """Constraints that the staged rows do break, to see every kind of violation counted."""
    rules = schema.Constraints(
        not_null=("transaction_bk", "is_fraud"),
        max_length={"auth_method": 4, "mcc_code": 4},
        domain={"ingestion_mode": ("batch",)},
        unique=(("transaction_bk",), ("client_id", "channel")),
        foreign={"client_id": "client"},
    )
    return quality.violations(
        inputs.staging(spark, src), rules, {"client": inputs.dims(spark, src).client}
    )


def late_labels(spark: SparkSession, src: str) -> DataFrame:
    """Labels for the first half of the month reach the unlabelled stream rows."""
    facts = inputs.fact(spark, src)
    labels = facts.where(F.col("event_ts") < F.lit("2024-01-15").cast("timestamp")).select(
        "transaction_bk",
        (F.col("home_distance_km") < 10).alias("is_fraud"),
        F.lit("late").alias("fraud_type"),
    )
    full = load.complete_labels(facts, labels)
    label = F.coalesce(F.col("is_fraud").cast("string"), F.lit("open")).alias("label")
    return full.groupBy(label).agg(F.count("*").alias("n"))


def label_deltas(spark: SparkSession, src: str) -> DataFrame:
    """The same labels in ten batches, each fraud also as a legitimate row of another batch, and labels of no
    transaction; merged with the fact when it is read."""
    folder = run_dir(spark, "labels")
    key = F.pmod(F.xxhash64("transaction_bk"), F.lit(LABEL_BATCHES)).cast("int")
    verdict = F.col("home_distance_km") < 10
    rows = inputs.fact(spark, src).where(F.col("event_ts") < F.lit("2024-01-15").cast("timestamp"))
    given = rows.select("transaction_bk", verdict.alias("is_fraud"), F.lit("late").alias("fraud_type"), key.alias("batch"))
    denied = given.where("is_fraud").withColumns({"is_fraud": F.lit(False), "batch": (F.col("batch") + 1) % LABEL_BATCHES})
    strange = given.withColumn("transaction_bk", F.concat(F.lit("?"), "transaction_bk"))
    given.unionByName(denied).unionByName(strange).write.partitionBy("batch").parquet(f"{folder}/in")
    store = labels.LabelStore(f"{folder}/store")
    sent = spark.read.schema(f"{labels.LABELS}, batch int").parquet(f"{folder}/in")
    for k in range(LABEL_BATCHES):
        store.add(sent.where(F.col("batch") == k), k)
    full = store.complete(inputs.fact(spark, src))
    label = F.coalesce(F.col("is_fraud").cast("string"), F.lit("open")).alias("label")
    late = F.count_if(F.coalesce(F.col("fraud_type") == "late", F.lit(False))).alias("n_late")
    return full.groupBy(label).agg(F.count("*").alias("n"), late)


def calendar(spark: SparkSession, src: str) -> DataFrame:
    span = inputs.events(spark, src).agg(F.min("ts").alias("s"), F.max("ts").alias("e"))
    hours = dimensions.time_dimension(dimensions.hours_between(span, "s", "e"), with_unknown=False)
    numbers = ("time_key", "year", "month", "day", "hour", "dow")
    return hours.select(
        _text("hour_ts").alias("hour_ts"),
        *[F.col(c).cast("bigint").alias(c) for c in numbers],
        "is_weekend",
        "is_night",
    )


def class_imbalance(spark: SparkSession, src: str) -> DataFrame:
    return profile.class_imbalance(inputs.labelled(spark, src))


def rate_by_dimension(spark: SparkSession, src: str) -> DataFrame:
    return profile.fraud_rate_by(inputs.labelled(spark, src), RATE_DIMENSIONS)


def country_pivot(spark: SparkSession, src: str) -> DataFrame:
    return profile.country_pivot(inputs.labelled(spark, src))


def peak_rates(spark: SparkSession, src: str) -> DataFrame:
    return profile.peaks(inputs.labelled(spark, src))


def describe_by_class(spark: SparkSession, src: str) -> DataFrame:
    return profile.describe_by_class(inputs.labelled(spark, src), ["amount", "home_distance_km"])


def boxplot(spark: SparkSession, src: str) -> DataFrame:
    return profile.boxplot(inputs.labelled(spark, src), "home_distance_km")


def histogram_log_amount(spark: SparkSession, src: str) -> DataFrame:
    bins = profile.log_amount_histogram(inputs.labelled(spark, src))
    return bins.withColumn("bin", F.col("bin").cast("bigint"))


def zscore_card(spark: SparkSession, src: str) -> DataFrame:
    return profile.detector_card(profile.zscore_flags(inputs.labelled(spark, src), "amount"))


def iqr_card(spark: SparkSession, src: str) -> DataFrame:
    return profile.detector_card(profile.iqr_flags(inputs.labelled(spark, src), "amount"))


def sequences(spark: SparkSession, src: str) -> DataFrame:
    found = windows.sequences(inputs.labelled(spark, src))
    return found.select(
        "transaction_bk",
        "client_id",
        "segment",
        "is_fraud",
        F.concat_ws("|", F.transform("steps", lambda s: s["amount"].cast("string"))).alias("amounts"),
        F.concat_ws("|", F.transform("steps", lambda s: s["channel"])).alias("channels"),
    )


def split_positional(spark: SparkSession, src: str) -> DataFrame:
    return windows.split_summary(windows.split_positional(inputs.labelled(spark, src)))


def split_quantile(spark: SparkSession, src: str) -> DataFrame:
    return windows.split_summary(windows.split_quantile(inputs.labelled(spark, src)))


def session_counters(spark: SparkSession, src: str) -> DataFrame:
    counted = windows.session_counters(inputs.fact(spark, src))
    return counted.select("transaction_bk", "client_id", "n_session", "amount_session")


def trailing_hour_counters(spark: SparkSession, src: str) -> DataFrame:
    rows = inputs.fact(spark, src).select("transaction_bk", "client_id", "event_ts", "amount")
    counted = windows.trailing_counters(rows)
    return counted.select("transaction_bk", "client_id", "n_trailing", "amount_trailing")


def sampled_rows(spark: SparkSession, src: str) -> DataFrame:
    return windows.sample_rows(inputs.labelled(spark, src).select("transaction_bk", "amount"), 300)


def roc_points(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.roc_points(inputs.scored(spark, src))


def pr_points(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.pr_points(inputs.scored(spark, src))


def evaluate_scores(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.evaluate(inputs.scored(spark, src))


def threshold_sweep(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.threshold_sweep(inputs.scored(spark, src))


def best_threshold(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.best_threshold(evaluate.threshold_sweep(inputs.scored(spark, src)))


def confusion(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.confusion(inputs.scored(spark, src))


def detection_by_type(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.detection_by_type(inputs.scored(spark, src), 0.9)


def complementarity(spark: SparkSession, src: str) -> DataFrame:
    scores = inputs.scored(spark, src)
    other = scores.select("transaction_bk", F.col("score_b").alias("score"))
    return evaluate.complementarity(evaluate.align_scores(scores, other), 0.95, 0.85)


def business_kpis(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.business_kpis(inputs.scored(spark, src), [0.5, 0.9, 0.98])


def top_fraud(spark: SparkSession, src: str) -> DataFrame:
    return evaluate.top_fraud(inputs.scored(spark, src)).select("transaction_bk", "score")


def validate_events(spark: SparkSession, src: str) -> DataFrame:
    judged = validate.judge_events(inputs.messages(spark, src))
    return judged.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(
        F.count("*").alias("n"), F.sum("amount").cast("double").alias("amount")
    )


def stream_ingest(spark: SparkSession, src: str) -> DataFrame:
    """Facts after the streaming job has seen all messages, duplicates and broken ones included."""
    facts = inputs.ingested(spark, src).facts(spark)
    return facts.select(
        "transaction_bk",
        *[F.col(c).cast("bigint").alias(c) for c in ("client_key", "time_key", "channel_key")],
        _text("event_ts").alias("event_time"),
        F.col("amount").cast("double").alias("amount"),
        F.coalesce(F.col("is_fraud").cast("string"), F.lit("open")).alias("label"),
        F.col("ingestion_mode").cast("string").alias("ingestion_mode"),
    )


def stream_dead_letters(spark: SparkSession, src: str) -> DataFrame:
    dead = inputs.ingested(spark, src).dead_letters(spark)
    reason = F.get_json_object("envelope", "$.erreur").alias("reason")
    return dead.groupBy(reason).agg(F.count("*").alias("n"))


def stream_totals(spark: SparkSession, src: str) -> DataFrame:
    return ingest.totals(inputs.ingested(spark, src).run_log(spark))


def stream_known(spark: SparkSession, src: str) -> DataFrame:
    """Which of all business keys the ingestion has seen, by its index of keys."""
    asked = inputs.staging(spark, src).select("transaction_bk")
    seen = inputs.ingested(spark, src).keys.known(asked, before=len(inputs.WAVES))
    seen = asked.limit(0) if seen is None else seen
    return asked.join(seen.withColumn("known", F.lit(True)), "transaction_bk", "left").select("transaction_bk", F.coalesce("known", F.lit(False)).alias("known"))


def stream_staged(spark: SparkSession, src: str) -> DataFrame:
    """Staged messages in the order of arrival: the number of each wave's first writers, and whether all have a place."""
    staged = inputs.ingested(spark, src).staged(spark)
    wave = F.regexp_extract("arrival.part", "wave_([0-9]+)", 1).cast("bigint").alias("wave")
    placed = F.bool_and(F.col("arrival.at").isNotNull() & F.col("arrival.block").isNotNull() & F.col("arrival.row").isNotNull())
    return staged.groupBy(wave).agg(F.count("*").alias("n"), placed.alias("placed"), F.sum("amount").cast("double").alias("amount"))


def run_log_state(spark: SparkSession, src: str) -> DataFrame:
    """State of every daily load: opened at its first event, closed at its last one unless it is the newest."""
    rows = inputs.staging(spark, src)
    days = rows.groupBy(F.to_date("event_ts").alias("day")).agg(
        F.min("event_ts").alias("s"), F.max("event_ts").alias("e"), F.count("*").alias("n")
    )
    last = days.agg(F.max("day")).scalar()
    opened = days.select(
        F.date_format("day", "yyyy-MM-dd").alias("run_id"),
        F.lit("daily").alias("source"),
        F.lit("batch").alias("mode"),
        F.lit("RUNNING").alias("status"),
        F.lit(None).cast("bigint").alias("n_rows"),
        F.lit(None).cast("bigint").alias("duration_ms"),
        F.lit(None).cast("string").alias("message"),
        F.col("s").alias("at"),
    )
    closed = days.where(F.col("day") < last).select(
        F.date_format("day", "yyyy-MM-dd").alias("run_id"),
        F.lit("daily").alias("source"),
        F.lit("batch").alias("mode"),
        F.when(F.col("n") % 7 == 0, "ERROR").otherwise("OK").alias("status"),
        F.col("n").alias("n_rows"),
        F.floor((F.unix_micros("e") - F.unix_micros("s")) / F.lit(1000)).alias("duration_ms"),
        F.when(F.col("n") % 7 == 0, "row count is a multiple of seven").alias("message"),
        F.col("e").alias("at"),
    )
    state = logs.run_log_state(opened.unionByName(closed))
    return state.select(
        "run_id",
        "status",
        F.coalesce("n_rows", F.lit(-1)).alias("n_rows"),
        F.coalesce("duration_ms", F.lit(-1)).alias("duration_ms"),
        F.coalesce("message", F.lit("")).alias("message"),
        _text("started_at").alias("started_at"),
        F.coalesce(_text("ended_at"), F.lit("open")).alias("ended_at"),
    )


def online_counters(spark: SparkSession, src: str) -> DataFrame:
    """Client counters as the streaming job left them."""
    return inputs.ingested(spark, src).counters(spark).select(
        "client_id", _text("last_ts").alias("last_ts"), "nb_tx_1h", "amount_1h"
    )


def enrich_online(spark: SparkSession, src: str) -> DataFrame:
    """Facts with the online counters of their client; clients without counters get none."""
    counters = inputs.ingested(spark, src).counters(spark)
    rows = inputs.labelled(spark, src).select("transaction_bk", "client_id")
    found = score.enrich_online(rows, counters)
    return found.select(
        "transaction_bk",
        F.coalesce("online.nb_tx_1h", F.lit(-1)).alias("nb_tx_1h"),
        F.coalesce("online.amount_1h", F.lit(-1.0)).alias("amount_1h"),
    )


def stream_dedup(spark: SparkSession, src: str) -> DataFrame:
    """The event stream twice over: the state lets each business key through once."""
    folder = run_dir(spark, "dedup")
    events = inputs.event_stream(spark, src)
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    ingest.drain(ingest.drop_seen(twice), f"{folder}/out", f"{folder}/checkpoint")
    kept = spark.read.parquet(f"{folder}/out")
    return kept.groupBy("client_id").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("amount"))


def stream_sessions(spark: SparkSession, src: str) -> DataFrame:
    """Activity sessions that the watermark has closed."""
    folder = run_dir(spark, "sessions")
    ingest.drain(
        ingest.closed_sessions(inputs.event_stream(spark, src)), f"{folder}/out", f"{folder}/checkpoint"
    )
    return spark.read.parquet(f"{folder}/out").select(
        "client_id", _text("start_ts").alias("start_ts"), "n", F.col("amount").cast("double").alias("amount")
    )


def stream_trailing(spark: SparkSession, src: str) -> DataFrame:
    """Counters of the last hour from the event stream, as far as the watermark has passed."""
    folder = run_dir(spark, "trailing")
    ingest.drain(trailing.trailing_stream(inputs.event_stream(spark, src)), f"{folder}/out", f"{folder}/checkpoint")
    counted = spark.read.schema("transaction_bk string, client_id string, n_trailing bigint, amount_trailing double")
    return counted.parquet(f"{folder}/out")


def stream_row_batches(spark: SparkSession, src: str) -> DataFrame:
    """All messages as a stream of text lines, in micro-batches of at most `inputs.ROWS_PER_BATCH` rows: their sizes,
    and the rows that do not continue the line before. `inputs.LANES` streams take the batches in turn."""
    folder = run_dir(spark, "rows")
    inputs.messages(spark, src).select("value").write.text(f"{folder}/inbox")

    def start(lane: int) -> StreamingQuery:
        def keep(batch: DataFrame, turn: int) -> None:
            batch_id = turn * inputs.LANES + lane
            batch.select("arrival", F.lit(batch_id).alias("batch_id")).write.mode("overwrite").parquet(f"{folder}/out/{batch_id}")

        stream = row_stream.row_events(spark, f"{folder}/inbox", inputs.ROWS_PER_BATCH, lanes=inputs.LANES, lane=lane)
        return stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint/{lane}").foreachBatch(keep).start()

    running = []
    try:
        for lane in range(inputs.LANES):
            running.append(start(lane))
        for query in running:
            query.processAllAvailable()
    finally:
        for query in running:
            query.stop()
    kept = spark.read.schema(T.StructType([T.StructField("arrival", ARRIVAL), T.StructField("batch_id", T.IntegerType())]))
    rows = kept.option("recursiveFileLookup", "true").parquet(f"{folder}/out")
    # a row per batch and file, then the gaps inside it and towards the batch before
    batch = F.col("batch_id").cast("bigint").alias("batch_id")
    runs = rows.groupBy(batch, F.col("arrival.part").alias("part")).agg(
        F.count("*").alias("n"), F.min("arrival.row").alias("lo"), F.max("arrival.row").alias("hi")
    )
    before = F.coalesce(F.lag("hi").over(Window.partitionBy("part").orderBy("batch_id")), F.lit(-1))
    gaps = F.col("hi") - F.col("lo") + 1 - F.col("n") + F.abs(F.col("lo") - before - 1)
    return runs.withColumn("gaps", gaps).groupBy("batch_id").agg(F.sum("n").alias("n"), F.sum("gaps").alias("n_gaps"))


def metric_summary(spark: SparkSession, src: str) -> DataFrame:
    """Three one-row results as one long frame of sections, keys and values."""
    rows = inputs.labelled(spark, src)
    sections = {
        "imbalance": profile.class_imbalance(rows),
        "zscore": profile.detector_card(profile.zscore_flags(rows, "amount")).select("n_signals", "tp", "fp"),
        "mart": marts.mart_kpis(inputs.fact(spark, src)).select("n_transactions", "n_frauds", "n_unlabelled"),
    }
    return logs.summary(sections).withColumn("value", F.col("value").cast("double"))


def standardised_features(spark: SparkSession, src: str) -> DataFrame:
    rows = inputs.labelled(spark, src)
    prep = prepare.fit_prep(rows, categorical=())
    return prepare.apply_prep(rows, prep).select(
        "transaction_bk", *[F.round(c, 6).alias(c) for c in prep.columns]
    )


def one_hot(spark: SparkSession, src: str) -> DataFrame:
    """Rows per encoded combination of the categorical features."""
    rows = inputs.labelled(spark, src)
    prep = prepare.fit_prep(rows, numeric=(), binary=(), categorical=prepare.CATEGORICAL)
    index = category_index("auth_method", ["puce_pin", "3ds"])
    coded = prepare.apply_prep(rows, prep).withColumn("idx", F.coalesce(index, F.lit(-1)).cast("bigint"))
    return coded.groupBy(*prep.columns, "idx").agg(F.count("*").alias("n"))


def risk_bands(spark: SparkSession, src: str) -> DataFrame:
    decided = score.decide(inputs.scored(spark, src), tuned=0.9)
    return decided.groupBy("risk_level", "fraud_at_default", "fraud_at_tuned").agg(F.count("*").alias("n"))


def validate_requests(spark: SparkSession, src: str) -> DataFrame:
    """Requests made of the facts, some of them out of their domain, with the rules they break."""
    number = F.substring("transaction_bk", 4, 9).cast("bigint")
    requests = inputs.labelled(spark, src).withColumns(
        {
            "amount": F.when(number % 11 == 0, -F.col("amount")).otherwise(F.col("amount")),
            "hour": F.when(number % 13 == 0, 24).otherwise(F.col("hour")),
            "dow": F.when(number % 17 == 0, 0).otherwise(F.col("dow")),
            "month": F.when(number % 19 == 0, F.lit(None)).otherwise(F.col("month")),
        }
    )
    judged = score.judge_requests(
        requests,
        {
            "auth_method": ("puce_pin", "3ds"),
            "channel": ("click", "error", "view", "purchase", "login"),
            "segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
        },
    )
    return judged.groupBy(F.concat_ws(",", "errors").alias("errors")).agg(F.count("*").alias("n"))


# Coefficients of the fixed score, for explanations that need no fitted model.
LINEAR = {"home_distance_km": -0.15, "amount": 0.004, "net_income": 0.0001, "hour": 0.02, "dow": -0.05, "month": 0.5}


def top_contributions_linear(spark: SparkSession, src: str) -> DataFrame:
    rows = inputs.labelled(spark, src)
    means = rows.agg(*[F.avg(c).alias(c) for c in LINEAR]).first()
    top = score.top_contributions(score.linear_contributions(LINEAR, means.asDict()))
    return rows.select("transaction_bk", F.posexplode(top).alias("place", "f")).select(
        "transaction_bk", F.col("place").cast("bigint").alias("place"), "f.feature", "f.impact"
    )


DRIFT_NUMERIC = ("amount", "home_distance_km", "net_income", "hour", "dow", "day")
DRIFT_CATEGORICAL = ("is_weekend", "is_night", "auth_method", "channel", "segment")


def _drift_sides(spark: SparkSession, src: str) -> tuple[DataFrame, DataFrame]:
    rows = windows.split_positional(inputs.labelled(spark, src))
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


def drift_numeric(spark: SparkSession, src: str) -> DataFrame:
    found = drift.numeric_drift(*_drift_sides(spark, src), DRIFT_NUMERIC)
    return found.select("feature", "method", F.round("score", 6).alias("score"), "n_values")


def drift_categorical(spark: SparkSession, src: str) -> DataFrame:
    found = drift.categorical_drift(*_drift_sides(spark, src), DRIFT_CATEGORICAL)
    return found.select("feature", "method", F.round("score", 6).alias("score"), "n_values")


def drift_verdict(spark: SparkSession, src: str) -> DataFrame:
    """The later rows as they are, and with drift injected into hour, amount and day."""
    reference, current = _drift_sides(spark, src)
    moved = drift.inject_drift(current, "day", 31)
    scenarios = (("normal", current), ("injected", moved))
    reports = [
        drift.drift_report(reference, side, DRIFT_NUMERIC, DRIFT_CATEGORICAL, name) for name, side in scenarios
    ]
    return reports[0].unionByName(reports[1])


def retention_check(spark: SparkSession, src: str) -> DataFrame:
    old = audit.expired(inputs.fact(spark, src), F.lit(inputs.AS_OF).cast("timestamp"), "20 DAYS")
    return old.groupBy("ingestion_mode").agg(F.count("*").alias("n_expired"))


def audit_report(spark: SparkSession, src: str) -> DataFrame:
    dims, facts = inputs.dims(spark, src), inputs.fact(spark, src)
    rows = inputs.scored(spark, src)
    explained = rows.withColumn(
        "top_features",
        score.top_contributions({"amount": F.col("amount"), "distance": F.col("home_distance_km")}),
    )
    tables = {
        "staging": inputs.staging(spark, src), "fact": facts, "branch": dims.branch, "client": dims.client,
        "time": dims.time, "channel": dims.channel, "run_log": explained,
    }
    return audit.audit(
        spark, tables, dims.client, facts, explained, F.lit(inputs.AS_OF).cast("timestamp"),
        key_pattern="^C[0-9]{7}[02468]$", retention="25 DAYS",
    )


def logreg_eval(spark: SparkSession, src: str) -> DataFrame:
    data = models.split(spark, src)
    return evaluate.evaluate(learn.apply_model(data.test, models.logistic(spark, src)))


def smote(spark: SparkSession, src: str) -> DataFrame:
    """Class sizes of the training rows after oversampling."""
    data = models.split(spark, src)
    return oversample(data.train, data.prep.columns).groupBy("is_fraud", "synthetic").agg(F.count("*").alias("n"))


def smote_logreg_eval(spark: SparkSession, src: str) -> DataFrame:
    data = models.split(spark, src)
    return evaluate.evaluate(learn.apply_model(data.test, models.oversampled_logistic(spark, src)))


def gbt_eval(spark: SparkSession, src: str) -> DataFrame:
    data = models.split(spark, src)
    return evaluate.evaluate(learn.apply_model(data.test, models.boosted(spark, src)))


def gbt_importance(spark: SparkSession, src: str) -> DataFrame:
    return learn.top_importances(spark, models.boosted(spark, src))


def tree_shap(spark: SparkSession, src: str) -> DataFrame:
    """Contribution of every feature over all test rows."""
    data = models.split(spark, src)
    explained = explain.tree_contributions(data.test, models.boosted(spark, src))
    return explain.contribution_summary(explained, data.prep.columns)


def logistic_explanation(spark: SparkSession, src: str) -> DataFrame:
    """Largest factors of every test decision of the fitted logistic model."""
    data = models.split(spark, src)
    explained = explain.logistic_contributions(data.test, models.logistic(spark, src), data.train)
    top = explain.top_factors(explained, data.prep.columns)
    return top.select("transaction_bk", F.round("base", 6).alias("base"), F.explode("top_features").alias("f")).select(
        "transaction_bk", "base", "f.feature", "f.impact"
    )


def pca_anomaly(spark: SparkSession, src: str) -> DataFrame:
    data = models.split(spark, src)
    model = models.reconstruction(spark, src)
    legit = learn.reconstruction_error(data.train.where(~F.col("is_fraud")), model)
    flagged = learn.anomaly_flags(learn.reconstruction_error(data.test, model), legit)
    return profile.detector_card(flagged, digits=4)


def pca_detection_by_type(spark: SparkSession, src: str) -> DataFrame:
    """Share of the frauds of each type whose reconstruction error is flagged."""
    data = models.split(spark, src)
    model = models.reconstruction(spark, src)
    legit = learn.reconstruction_error(data.train.where(~F.col("is_fraud")), model)
    flagged = learn.anomaly_flags(learn.reconstruction_error(data.test, model), legit)
    return evaluate.detection_by_type(flagged.withColumn("score", F.col("flag").cast("int")))


def sequence_classifier(spark: SparkSession, src: str) -> DataFrame:
    rows = windows.split_quantile(inputs.labelled(spark, src))
    prep = prepare.fit_prep(rows.where(F.col("split") == "train"))
    flat, columns = learn.flatten_sequences(windows.sequences(rows), prep)
    model = learn.fit_sequence_classifier(flat.where(F.col("split") == "train"), columns)
    return evaluate.evaluate(learn.apply_model(flat.where(F.col("split") == "test"), model))


def score_batch(spark: SparkSession, src: str) -> DataFrame:
    """Test rows through validation, scoring, decision, explanation and online enrichment; rejected
    requests come out too, with the fields that are out of their domain and no score."""
    data = models.split(spark, src)
    requests = data.test.withColumnsRenamed({"split": "_split"})
    accepted, rejected = score.validate_requests(requests, data.prep.categories)
    model = models.boosted(spark, src)
    scored = learn.apply_model(accepted, model)
    explained = explain.tree_contributions(scored, model, keep=("transaction_bk", "client_id", "score"))
    decided = score.decide(explain.top_factors(explained, data.prep.columns), tuned=0.8)
    enriched = score.enrich_online(decided, inputs.ingested(spark, src).counters(spark))
    answered = enriched.select(
        "transaction_bk", "score", "fraud_at_default", "fraud_at_tuned", "risk_level",
        F.col("top_features").cast("string").alias("top_features"),
        F.coalesce("online.nb_tx_1h", F.lit(-1)).alias("nb_tx_1h"),
        F.lit(f"gbt-{models.TREES}").alias("model_version"),
        F.lit("").alias("errors"),
    )
    refused = rejected.select("transaction_bk", F.concat_ws(",", "errors").alias("errors"))
    return answered.unionByName(refused, allowMissingColumns=True)


def scored_requests(spark: SparkSession, src: str) -> DataFrame:
    """Requests by the fields they break, and how many answers contradict their own score."""
    rows = score_batch(spark, src)
    p = F.col("score")
    band = F.when(p >= 0.8, F.col("fraud_at_default") & F.col("fraud_at_tuned")).otherwise(~F.col("fraud_at_tuned"))
    missing = F.col("score").isNull() | F.col("top_features").isNull() | ~p.between(0, 1)
    accepted = F.col("errors") == ""
    edge = F.abs(p - 0.8) < 1e-3  # the score is rounded after the decision
    wrong = (accepted & (missing | (~edge & ~band))) | (~accepted & p.isNotNull())
    return rows.groupBy("errors").agg(F.count("*").alias("n"), F.count_if(wrong).alias("n_wrong"))


def smote_points(spark: SparkSession, src: str) -> DataFrame:
    """Synthetic frauds, and those that leave the range of the real ones in some feature or are no number."""
    data = models.split(spark, src)
    rows = oversample(data.train, data.prep.columns)
    real = rows.where("is_fraud AND NOT synthetic")
    columns = data.prep.columns
    ends = real.agg(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    inside = F.lit(True)
    for c in columns:
        inside = inside & F.coalesce(F.col(c).between(ends[f"lo_{c}"] - 1e-9, ends[f"hi_{c}"] + 1e-9), F.lit(False))
    return rows.where("synthetic").agg(F.count("*").alias("n"), F.count_if(~inside).alias("n_outside"))


def model_properties(spark: SparkSession, src: str) -> DataFrame:
    """Properties that fitted models must have: rows looked at and rows that break them."""
    data = models.split(spark, src)
    boosted, logistic, code = models.boosted(spark, src), models.logistic(spark, src), models.reconstruction(spark, src)
    names = data.prep.columns

    def explained(name: str, parts: DataFrame, model) -> DataFrame:
        scores = learn.apply_model(data.test, model).select("transaction_bk", "score")
        total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
        gap = F.abs(1 / (1 + F.exp(-total)) - F.col("score"))
        wrong = F.count_if(F.coalesce(gap > 1e-6, F.lit(True)))
        return parts.join(scores, "transaction_bk").agg(F.lit(name).alias("property"), F.count("*").alias("n"), wrong.alias("n_wrong"))

    path = run_dir(spark, "model")
    logs.save_model(spark, logistic, 0.4, path)
    again, _ = logs.load_model(spark, path)
    both = learn.apply_model(data.test, logistic).select("transaction_bk", "score").join(
        learn.apply_model(data.test, again).select("transaction_bk", F.col("score").alias("other")), "transaction_bk"
    )
    # what three components leave over is the sum of the other eigenvalues
    errors = learn.reconstruction_error(data.train.where(~F.col("is_fraud")), code)
    held = float(sum(code.stages[-1].explainedVariance))
    spread = sum((F.var_pop(c) for c in names), F.lit(0.0))
    left = errors.agg(F.count("*").alias("n"), F.avg(F.col("error") * len(names)).alias("e"), spread.alias("v"))
    left = left.select(F.lit("reconstruction").alias("property"), "n", (F.abs(F.col("e") - F.col("v") * (1 - held)) > 1e-6 * F.col("v")).cast("bigint").alias("n_wrong"))
    gains = learn.importances(spark, boosted).agg(
        F.lit("importances").alias("property"), F.lit(0).cast("bigint").alias("n"), (F.abs(F.sum("importance") - 1) > 1e-9).cast("bigint").alias("n_wrong")
    )
    parts = [
        explained("boosted_explanations", explain.tree_contributions(data.test, boosted), boosted),
        explained("logistic_explanations", explain.logistic_contributions(data.test, logistic, data.train), logistic),
        both.agg(F.lit("stored_model").alias("property"), F.count("*").alias("n"), F.count_if(F.col("score") != F.col("other")).alias("n_wrong")),
        left,
        gains,
    ]
    return reduce(DataFrame.unionByName, parts)


def staged_once(spark: SparkSession, src: str) -> DataFrame:
    """A batch with every row twice meets a staging table that holds the first half of the month."""
    rows = inputs.staging(spark, src)
    stored = rows.where(F.col("event_ts") < F.lit("2024-01-15").cast("timestamp"))
    added = load.stage_insert(rows.unionByName(rows), stored)
    return added.groupBy("ingestion_mode").agg(
        F.count("*").alias("n"), F.sum("amount").cast("double").alias("amount")
    )


def processed_rows(spark: SparkSession, src: str) -> DataFrame:
    done = load.processed(inputs.staging(spark, src), inputs.fact(spark, src))
    return done.groupBy("ingestion_mode").agg(F.count("*").alias("n"))


def enforced_rows(spark: SparkSession, src: str) -> DataFrame:
    """Rows that pass and rows that fail a set of constraints, by the rules they break."""
    rules = schema.Constraints(
        not_null=("transaction_bk", "is_fraud"), max_length={"auth_method": 4}, domain={"tx_country": ("FR",)}
    )
    good, bad = quality.enforce(inputs.staging(spark, src), rules)
    passed = good.agg(F.count("*").alias("n")).select(F.lit("").alias("broken"), "n")
    failed = bad.groupBy(F.concat_ws(",", "broken_rules").alias("broken")).agg(F.count("*").alias("n"))
    return passed.unionByName(failed)


def column_defaults(spark: SparkSession, src: str) -> DataFrame:
    """Missing fraud types and a missing status column filled with defaults."""
    filled = load.fill_defaults(
        inputs.staging(spark, src), {"fraud_type": F.lit("none"), "status": F.lit("active")}
    )
    return filled.groupBy("fraud_type", "status").agg(F.count("*").alias("n"))


def bulk_text(spark: SparkSession, src: str) -> DataFrame:
    """Staging rows written as a bulk text file and read back with their schema."""
    path = run_dir(spark, "bulk")
    rows = inputs.staging(spark, src)
    tables.write_tsv(rows, path)
    back = tables.read_tsv(spark, path, rows.schema)
    return back.select(
        "transaction_bk",
        _text("event_ts").alias("event_time"),
        F.col("amount").cast("double").alias("amount"),
        "channel",
        F.coalesce(F.col("is_fraud").cast("string"), F.lit("open")).alias("label"),
        F.coalesce("fraud_type", F.lit("")).alias("fraud_type"),
    )


def channel_reload(spark: SparkSession, src: str) -> DataFrame:
    """Full refresh of the channel dimension, twice, with its unknown member."""
    path = run_dir(spark, "channel")
    pairs = inputs.staging(spark, src).select("channel", "mcc_code").distinct()
    keyed = dimensions.channel_dimension(pairs)
    known, unknown = keyed.where("channel_key > 0"), keyed.where("channel_key = 0")
    for _ in range(2):
        tables.reload(known, path, unknown)
    stored = spark.read.schema(keyed.schema).parquet(path)
    return stored.withColumn("channel_key", F.col("channel_key").cast("bigint"))


def dimension_growth(spark: SparkSession, src: str) -> DataFrame:
    """Channels seen early in the data keep their keys when those that come later are added."""
    rows = inputs.staging(spark, src)
    early = rows.where((F.col("channel") != "click") | (F.col("mcc_code") == "0001"))
    stored = dimensions.channel_dimension(early.select("channel", "mcc_code").distinct())
    grown = dimensions.grow_keys(stored, rows, ["channel", "mcc_code"], "channel_key")
    return grown.withColumn("channel_key", F.col("channel_key").cast("bigint"))


def random_clients(spark: SparkSession, src: str) -> DataFrame:
    return windows.random_keys(inputs.fact(spark, src), "client_id", 20)


def resampled_rows(spark: SparkSession, src: str) -> DataFrame:
    """A sample with replacement of a fifth of the labelled rows."""
    rows = inputs.labelled(spark, src).select("transaction_bk", "amount")
    return windows.sample_with_replacement(rows, 0.2)


def holdout(spark: SparkSession, src: str) -> DataFrame:
    rows = windows.holdout_split(inputs.labelled(spark, src))
    return rows.groupBy("is_validation").agg(F.count("*").alias("n"), F.count_if("is_fraud").alias("n_fraud"))


def class_weights(spark: SparkSession, src: str) -> DataFrame:
    """Legitimate rows per fraud, its square root, and the number of clients behind the rows."""
    rows = inputs.labelled(spark, src)
    ratio = F.try_divide(F.count_if(~F.col("is_fraud")).cast("double"), F.count_if("is_fraud"))
    return rows.agg(
        F.round(ratio, 6).alias("ratio"),
        F.round(F.sqrt(ratio), 6).alias("root"),
        F.countDistinct("client_id").alias("n_clients"),
    )


def production_models(spark: SparkSession, src: str) -> DataFrame:
    """Run log with one model version per channel and day; the highest version is in production."""
    day = F.to_date("event_ts")
    runs = (
        inputs.staging(spark, src)
        .groupBy(F.col("channel").alias("name"), F.dayofmonth(day).alias("version"))
        .agg(F.count_if("is_fraud").cast("double").alias("value"))
        .withColumn("path", F.concat_ws("/", "name", F.col("version").cast("string")))
    )
    return logs.production_model(runs).withColumn("version", F.col("version").cast("bigint"))


def saved_model(spark: SparkSession, src: str) -> DataFrame:
    """Evaluation of the logistic model after it was stored with its threshold and loaded again."""
    path = run_dir(spark, "model")
    logs.save_model(spark, models.logistic(spark, src), 0.4, path)
    model, threshold = logs.load_model(spark, path)
    return evaluate.evaluate(learn.apply_model(models.split(spark, src).test, model), threshold)


def error_histogram(spark: SparkSession, src: str) -> DataFrame:
    data = models.split(spark, src)
    errors = learn.reconstruction_error(data.test, models.reconstruction(spark, src))
    return profile.histogram(errors, F.log10(F.col("error") + 1e-6), "is_fraud", 60)


REGISTERED: list[Query] = [
    staged_once, processed_rows, enforced_rows, column_defaults, bulk_text, channel_reload, dimension_growth, random_clients,
    resampled_rows, holdout, class_weights, production_models, saved_model, error_histogram,
    metric_summary, standardised_features, one_hot, risk_bands, validate_requests, top_contributions_linear,
    drift_numeric, drift_categorical, drift_verdict, retention_check, audit_report,
    logreg_eval, smote, smote_logreg_eval, gbt_eval, gbt_importance, tree_shap,
    logistic_explanation, pca_anomaly,
    pca_detection_by_type, sequence_classifier, score_batch, scored_requests, smote_points, model_properties,
    validate_events, stream_ingest, stream_dead_letters, stream_totals, stream_known, stream_staged, run_log_state, online_counters,
    enrich_online, stream_dedup, stream_sessions, stream_trailing, stream_row_batches,
    load_facts, rejects, pending, mart_kpis, mart_ingestion, mart_hourly, mart_fraud_type, integrity_anti,
    quality_suite, check_log, audit_log, load_log, constraint_violations, late_labels, label_deltas, calendar, class_imbalance, rate_by_dimension,
    country_pivot, peak_rates, describe_by_class, boxplot, histogram_log_amount, zscore_card, iqr_card,
    sequences, split_positional, split_quantile, session_counters, trailing_hour_counters, sampled_rows,
    roc_points, pr_points, evaluate_scores, threshold_sweep, best_threshold, confusion, detection_by_type,
    complementarity, business_kpis, top_fraud,
]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in REGISTERED}
