"""The given tables read as a card-payment warehouse: staging rows, dimensions, facts and scores."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.scalar import business_key, hour_of, sigmoid
from cardwatch.operators.dimensions import Dims, channel_dimension, time_dimension
from cardwatch.operators.load import labelled_transactions, load_facts
from cardwatch.session import run_dir
from cardwatch.sources.events import text_events
from cardwatch.streaming.ingest import Warehouse, start_ingestion

# The calendar ends here, so the hours after it resolve to the unknown member.
CALENDAR_END = "2024-01-29 00:00:00"
AS_OF = "2024-02-01 00:00:00"

# Columns read from the given tables. Stating them saves a footer-reading job per table and query.
_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, src: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{src}/{name}.parquet")


def client_id(n) -> F.Column:
    return F.concat(F.lit("C"), F.lpad(F.col(n).cast("string"), 8, "0"))


def events(spark: SparkSession, src: str) -> DataFrame:
    return table(spark, src, "events").withColumns(
        {
            "ts": F.col("ts").cast("timestamp"),
            "k": F.get_json_object("props", "$.k").cast("int"),
        }
    )


@lru_cache(maxsize=16)  # the plan only, no data
def staging(spark: SparkSession, src: str) -> DataFrame:
    k = F.col("k")
    labelled = F.col("event_id") % 10 != 0
    fraud = (F.col("event_type") == "error") & (k < 8)
    return events(spark, src).select(
        business_key(F.col("event_id") + 1).alias("transaction_bk"),
        client_id("user_id").alias("client_id"),
        F.col("ts").alias("event_ts"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.col("event_type").alias("channel"),
        F.lpad((k % 3).cast("string"), 4, "0").alias("mcc_code"),
        F.when(k >= 95, "ES").otherwise("FR").alias("tx_country"),
        (k * F.lit(1.25)).cast("decimal(8,2)").alias("home_distance_km"),
        F.when(k < 55, "puce_pin").when(k < 90, "3ds").otherwise("none").alias("auth_method"),
        F.when(labelled, fraud).alias("is_fraud"),
        F.when(labelled & fraud, F.concat(F.lit("type_"), (k % 6).cast("string"))).alias("fraud_type"),
        F.when(labelled, "batch").otherwise("stream").alias("ingestion_mode"),
        F.col("ts").alias("ingested_at"),
    )


@lru_cache(maxsize=16)
def dims(spark: SparkSession, src: str) -> Dims:
    nation, region = table(spark, src, "nation"), table(spark, src, "region")
    branch = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).alias("branch_key"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("region"),
    )
    client = (
        table(spark, src, "customer")
        .where(F.col("c_custkey") % 50 != 49)
        .select(
            (F.col("c_custkey") + 1).alias("client_key"),
            client_id("c_custkey").alias("client_id"),
            (F.col("c_nationkey") + 1).alias("branch_key"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").cast("decimal(10,2)").alias("net_income"),
        )
    )
    seen = events(spark, src)
    hours = (
        seen.where(F.col("ts") < F.lit(CALENDAR_END).cast("timestamp"))
        .select(hour_of("ts").alias("hour_ts"))
        .distinct()
    )
    pairs = (
        staging(spark, src)
        .select("channel", "mcc_code")
        .where(~((F.col("channel") == "view") & (F.col("mcc_code") == "0002")))
        .distinct()
    )
    # Tables of the warehouse: written once, then read with known sizes, so that Catalyst decides how
    # to join them instead of deriving them from the events in every query.
    folder = run_dir(spark, "dims")
    stored = []
    for name, frame in (("time", time_dimension(hours)), ("channel", channel_dimension(pairs))):
        frame.write.parquet(f"{folder}/{name}")
        stored.append(spark.read.schema(frame.schema).parquet(f"{folder}/{name}"))
    return Dims(branch, client, *stored)


@lru_cache(maxsize=16)  # the plan only, no data
def fact(spark: SparkSession, src: str) -> DataFrame:
    return load_facts(staging(spark, src), dims(spark, src), as_of=F.col("ingested_at")).facts


@lru_cache(maxsize=16)  # the plan only, no data
def labelled(spark: SparkSession, src: str) -> DataFrame:
    return labelled_transactions(fact(spark, src), dims(spark, src))


def fixed_score() -> F.Column:
    """A logistic score with fixed coefficients, so that evaluation does not depend on a fitted model."""
    z = (
        F.lit(2.0)
        - F.lit(0.15) * F.col("home_distance_km")
        + F.lit(0.004) * F.col("amount")
        + F.when(F.col("channel") == "error", 1.2).otherwise(0.0)
    )
    return F.round(sigmoid(z), 6)


@lru_cache(maxsize=16)  # the plan only, no data
def scored(spark: SparkSession, src: str) -> DataFrame:
    """Labelled rows with the fixed score and a second one that ignores the distance."""
    other = sigmoid(
        F.when(F.col("channel") == "error", 1.5).otherwise(-1.5) + F.lit(0.002) * F.col("amount")
    )
    return labelled(spark, src).withColumns({"score": fixed_score(), "score_b": F.round(other, 6)})


# The kinds of message on the wire, by event number modulo 40; all other events are valid once.
MESSAGE_KINDS = {
    3: "twice", 7: "cut", 11: "number", 13: "list", 17: "missing", 19: "text_amount", 23: "null_client",
    29: "boolean_amount", 31: "no_time", 37: "extra",
}
# Every message arrives: the first wave has no lower and the last no upper end.
WAVES = [(None, "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", None)]


#: Most rows of a micro-batch where all messages are read as lines.
ROWS_PER_BATCH = 4000
#: Streams that share those lines, so that the fixed costs of their micro-batches pass at the same time.
LANES = 4


def messages(spark: SparkSession, src: str) -> DataFrame:
    """The events as JSON lines, some of them broken in every way the validation knows."""
    mark = F.lit("unset")
    for number, name in MESSAGE_KINDS.items():
        mark = F.when(F.col("event_id") % 40 == number, name).otherwise(mark)
    rows = staging(spark, src).select(
        "*", (F.substring("transaction_bk", 4, 9).cast("bigint") - 1).alias("event_id")
    ).withColumn("kind", mark)
    kind = F.col("kind")
    amount = F.col("amount").cast("string")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    pairs = [
        ("transaction_bk", quoted(F.col("transaction_bk"))),
        ("client_id", F.when(kind == "null_client", "null").otherwise(quoted(F.col("client_id")))),
        (
            "horodatage",
            quoted(F.when(kind == "no_time", "no time").otherwise(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss"))),
        ),
        (
            "montant",
            F.when(kind == "text_amount", quoted(amount)).when(kind == "boolean_amount", "true").otherwise(amount),
        ),
        ("canal", quoted(F.col("channel"))),
        ("mcc_code", F.when(kind != "missing", quoted(F.col("mcc_code")))),
        ("pays_transaction", quoted(F.col("tx_country"))),
        ("distance_domicile_km", F.col("home_distance_km").cast("string")),
        ("authentification", quoted(F.col("auth_method"))),
        ("note", F.when(kind == "extra", F.lit('"kept out"'))),
    ]
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{name}":'), value) for name, value in pairs])
    line = F.concat(F.lit("{"), body, F.lit("}"))
    line = (
        F.when(kind == "cut", F.substring(line, 1, 30))
        .when(kind == "number", "42")
        .when(kind == "list", "[1,2]")
        .otherwise(line)
    )
    copies = F.explode(F.sequence(F.lit(1), F.when(kind == "twice", 2).otherwise(1)))
    return rows.select("event_id", "event_ts", line.alias("value"), copies.alias("copy")).drop("copy")


@lru_cache(maxsize=4)
def ingested(spark: SparkSession, src: str) -> Warehouse:
    """The messages of three periods arrive one after the other and pass through the streaming job."""
    root = run_dir(spark, "stream")
    house = Warehouse(f"{root}/tables")
    wire = messages(spark, src)
    for i, (start, end) in enumerate(WAVES):
        late = F.col("event_ts") >= F.lit(start).cast("timestamp") if start else F.lit(True)
        period = late & (F.col("event_ts") < F.lit(end).cast("timestamp") if end else F.lit(True))
        wire.where(period).select("value").write.text(f"{root}/inbox/wave_{i}")
        query = start_ingestion(
            text_events(spark, f"{root}/inbox"), dims(spark, src), house, f"{root}/checkpoint", available_now=True
        )
        query.awaitTermination()
    return house


def event_stream(spark: SparkSession, src: str) -> DataFrame:
    """The events table read as a stream."""
    rows = spark.readStream.schema(_COLUMNS["events"]).parquet(f"{src}/events.parquet*")
    return rows.select(
        business_key(F.col("event_id") + 1).alias("transaction_bk"),
        client_id("user_id").alias("client_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
    )
