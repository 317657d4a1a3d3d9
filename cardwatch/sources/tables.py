"""Table readers and writers: tab-separated bulk files, databases, full refresh and appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Separator and NULL mark of the bulk text format, which has no quoting.
TAB = "\t"
NULL_MARK = "\\N"


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Bulk text lines with a stated schema; a line that does not fit it fails the load."""
    parts = F.split("value", TAB, -1)
    size = len(schema.fields)
    checked = F.when(F.size(parts) == size, parts).otherwise(
        F.raise_error(F.concat(F.lit(f"not {size} fields: "), F.col("value")))
    )
    lines = spark.read.text(path).select(checked.alias("_parts"))
    cells = [F.col("_parts")[k] for k in range(size)]
    return lines.select(
        *[
            F.when(cell != NULL_MARK, cell).cast(f.dataType).alias(f.name)
            for cell, f in zip(cells, schema.fields)
        ]
    )


def write_tsv(df: DataFrame, path: str) -> None:
    """Tabs and line breaks inside text become spaces, NULL becomes the NULL mark."""
    cells = []
    for f in df.schema.fields:
        text = F.col(f.name).cast("string")
        if isinstance(f.dataType, StringType):
            text = F.regexp_replace(text, r"[\t\r\n]", " ")
        cells.append(F.coalesce(text, F.lit(NULL_MARK)))
    df.select(F.concat_ws(TAB, *cells).alias("value")).write.mode("overwrite").text(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, slices: int, **options: str
) -> DataFrame:
    """Database table read in `slices` parallel key ranges."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", key)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", slices)
        .options(**options)
        .load()
    )


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()


def reload(df: DataFrame, path: str, unknown: DataFrame | None = None) -> None:
    """Full refresh: the table is replaced, and its unknown member is written with it."""
    (df if unknown is None else df.unionByName(unknown)).write.mode("overwrite").parquet(path)


def write_facts(facts: DataFrame, path: str) -> None:
    """Facts by ingestion mode and day, the columns that later reads filter on.

    No repartition by day: every task writes its own rows, so a busy day is never one task's work.
    """
    day = facts.withColumn("event_date", F.to_date("event_ts"))
    day.write.mode("append").partitionBy("ingestion_mode", "event_date").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _path(spark: SparkSession, path: str):
    """A path and its file system, on any that Spark can reach."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at the path."""
    where, files = _path(spark, path)
    return files.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no folder."""
    where, files = _path(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, there or not there at once."""
    where, files = _path(spark, path)
    files.create(where, True).close()


def remove(spark: SparkSession, path: str) -> None:
    where, files = _path(spark, path)
    files.delete(where, True)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored table, or no rows before its first write."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
