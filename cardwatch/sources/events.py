"""Transaction events on the wire: sources and the dead-letter envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: messages per micro-batch.
BATCH_MESSAGES = 200
#: Where a message stood in its source, in the order of which the first writer of a key is found.
ARRIVAL = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("part", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)


def _arrival(at: Column, part: Column, block: Column, row: Column) -> Column:
    return F.struct(at.alias("at"), part.alias("part"), block.cast("bigint").alias("block"), row.cast("bigint").alias("row"))


def kafka_events(
    spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = BATCH_MESSAGES
) -> DataFrame:
    """Raw topic messages as a stream with `value` and `arrival` (broker's time, partition, offset), from the earliest offset.

    Needs the Kafka connector on the class path. Offsets live in the query's checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    part = F.concat_ws("-", "topic", F.lpad(F.col("partition").cast("string"), 10, "0"))
    return reader.load().select("value", _arrival(F.col("timestamp"), part, F.col("offset"), F.lit(0)).alias("arrival"))


def text_events(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same from a folder that receives text files with one JSON message per line.

    Files come in the order of their time and name, blocks in that of their starts; `numbered` adds the line order.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    file = F.col("_metadata")
    arrival = _arrival(file["file_modification_time"], file["file_path"], file["file_block_start"], F.lit(None))
    return reader.text(folder).select("value", arrival.alias("arrival"))


def numbered(raw: DataFrame) -> DataFrame:
    """The rows of one micro-batch as read, with the place of each in its block where the source has none.

    A task reads a block from the front, so the numbers of its partition rise with the lines.
    """
    if "arrival" not in raw.columns:
        return raw
    row = F.coalesce(F.col("arrival.row"), F.monotonically_increasing_id())
    return raw.withColumn("arrival", F.col("arrival").withField("row", row))


def dlq_topic(topic: str | Column) -> Column:
    """Name of the dead-letter topic: what precedes the last dot, or the whole name, and .dlq."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    return F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit(".dlq"))


def envelope(raw: Column, reason: Column) -> Column:
    """Dead-letter message: the text with invalid bytes replaced, and the reason."""
    return F.to_json(F.struct(F.make_valid_utf8(raw.cast("string")).alias("raw"), reason.alias("erreur")))


def write_dlq_kafka(dead: DataFrame, servers: str, topic: str) -> None:
    (
        dead.select(F.col("envelope").alias("value"), dlq_topic(topic).alias("topic"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )
