"""What the ingestion keeps between micro-batches: which batches count, which keys are known, the latest counters.

Every micro-batch writes tables of its own; nothing of it is visible before `Commits.add` creates one empty
file, which is atomic on any file system that Spark uses. All state is found by listing names, so a batch
that broke at any place leaves nothing behind but folders that nobody reads and that its next run overwrites.

Merged folders (`KeyIndex`, `Snapshots`) are derived from committed batches only, depend on nothing but those, and are
published by name after they are whole, so doing a merge again, or not at all, changes no result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import shared_dir
from cardwatch.sources.tables import names, remove, touch

#: Batches, or merged ranges of batches, that are folded into one.
FOLD = 8
#: Keys for which one bitmap of a filter is meant, and hashes of a key in it: one foreign key in 300 passes.
FILTER_KEYS, HASHES = 2_700, 4
BITMAP_BITS = 32_768  # of bitmap_construct_agg
COUNTER_BUCKETS = 16


def _ranges(found: list[str]) -> list[tuple[int, ...]]:
    """Numbers in names like 8-15 or 8-15-3; others are not ours."""
    parts = [n.split("-") for n in found]
    return sorted(tuple(map(int, p)) for p in parts if all(x.isdigit() for x in p))


@dataclass(frozen=True)
class Commits:
    """The batches that count, as names `first-last` of empty files."""

    root: str

    def ranges(self, spark: SparkSession) -> list[tuple[int, int]]:
        """Disjoint ranges of all committed batches, in order."""
        out: list[tuple[int, int]] = []
        for first, last in _ranges(names(spark, self.root)):
            if out and first <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(last, out[-1][1]))
            else:
                out.append((first, last))
        return out

    def add(self, spark: SparkSession, batch_id: int) -> None:
        touch(spark, f"{self.root}/{batch_id}-{batch_id}")
        files = names(spark, self.root)
        if len(files) > 8 * FOLD:
            whole = self.ranges(spark)
            for first, last in whole:
                touch(spark, f"{self.root}/{first}-{last}")
            kept = {f"{first}-{last}" for first, last in whole}
            for name in set(files) - kept:
                remove(spark, f"{self.root}/{name}")

    def before(self, spark: SparkSession, batch_id: int) -> int | None:
        """The last committed batch before the given one."""
        found = [min(last, batch_id - 1) for first, last in self.ranges(spark) if first < batch_id]
        return max(found, default=None)

    def ids(self, spark: SparkSession, least: int, before: int) -> list[int]:
        return [b for first, last in self.ranges(spark) for b in range(max(first, least), min(last + 1, before))]

    def listed(self, spark: SparkSession, column: str = "batch_id", before: int | None = None) -> Column:
        """Whether a row's batch counts; prunes partitions."""
        top = (1 << 62) if before is None else before - 1
        ways = [F.col(column).between(first, min(last, top)) for first, last in self.ranges(spark) if first <= top]
        return reduce(lambda a, b: a | b, ways, F.lit(False))


@dataclass(frozen=True)
class KeyIndex:
    """Keys of committed batches in segments, each with a blocked Bloom filter beside it.

    A segment is a batch, or FOLD segments of equal span merged, so there are about FOLD times the logarithm of the
    number of batches. Its name has the batches and the number of bitmaps of the filter. A key belongs to one bitmap
    of each segment; only segments whose filter may hold one of the asked keys are opened.
    """

    root: str

    def live(self, spark: SparkSession, before: int) -> list[tuple[int, int, int]]:
        """(first, last, bitmaps) of the segments of batches before the given one, the widest of each batch."""
        found = [s for s in _ranges(names(spark, f"{self.root}/published")) if s[1] < before]
        return [s for s in found if not any(o[:2] != s[:2] and o[0] <= s[0] and s[1] <= o[1] for o in found)]

    def _path(self, kind: str, segment: tuple[int, int, int]) -> str:
        return f"{self.root}/{kind}/segment={'-'.join(map(str, segment))}"

    def _read(self, spark: SparkSession, kind: str, segments: list[tuple[int, int, int]], schema: str) -> DataFrame:
        reader = spark.read.schema(f"{schema}, segment string").option("basePath", f"{self.root}/{kind}")
        return reader.parquet(*[self._path(kind, s) for s in segments])

    def _write(self, keys: DataFrame, first: int, last: int, rows: int) -> None:
        spark = keys.sparkSession
        segment = (first, last, max(1, -(-rows // FILTER_KEYS)))
        for old in _ranges(names(spark, f"{self.root}/published")):
            if old[:2] == (first, last):  # an earlier run of the same batch
                remove(spark, f"{self.root}/published/{'-'.join(map(str, old))}")
        files = max(1, -(-rows // 1_000_000))
        bucket = F.pmod("h", F.lit(segment[2])).alias("bucket")
        dealt = keys.select("transaction_bk", F.xxhash64("transaction_bk").alias("h")).select("transaction_bk", "h", bucket)
        dealt.repartition(files, "bucket").sortWithinPartitions("bucket").write.mode("overwrite").parquet(self._path("keys", segment))
        stored = spark.read.schema("transaction_bk string, h bigint, bucket bigint").parquet(self._path("keys", segment))
        bits = stored.select("bucket", F.explode(F.array(*[place(F.col("h"), k) for k in range(HASHES)])).alias("place"))
        bitmaps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
        # as words, for a lookup reads one of them in place where it would copy a whole binary value for each key
        word = lambda i: F.conv(F.hex(F.substring("bits", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
        words = bitmaps.select("bucket", F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BITS // 64 - 1)), word).alias("words"))
        words.coalesce(files).write.mode("overwrite").parquet(self._path("filter-words", segment))
        touch(spark, f"{self.root}/published/{'-'.join(map(str, segment))}")

    def add(self, keys: DataFrame, batch_id: int, rows: int) -> None:
        """The keys of a batch, before it is committed; they count for later batches only."""
        self._write(keys, batch_id, batch_id, rows)

    def fold(self, spark: SparkSession, batch_id: int) -> None:
        """Merge the segments that end with this committed batch, if a range is full."""
        span = FOLD
        while (batch_id + 1) % span == 0:
            first = batch_id + 1 - span
            parts = [s for s in self.live(spark, batch_id + 1) if s[0] >= first]
            if len(parts) > 1:
                keys = self._read(spark, "keys", parts, "transaction_bk string").select("transaction_bk")
                self._write(keys, first, batch_id, keys.count())
                # not the folders: a reader that listed them may still be at work
                for s in parts:
                    remove(spark, f"{self.root}/published/{'-'.join(map(str, s))}")
            span *= FOLD

    def suspects(self, keys: DataFrame, before: int) -> DataFrame | None:
        """transaction_bk, segment and bucket of keys that a segment may hold; None where there is none yet."""
        spark = keys.sparkSession
        segments = self.live(spark, before)
        if not segments:
            return None
        filters = self._read(spark, "filter-words", segments, "bucket bigint, words array<bigint>")
        asked = F.explode(F.array(*[F.struct(F.lit("-".join(map(str, s))).alias("segment"), F.lit(s[2]).alias("n")) for s in segments])).alias("s")
        rows = keys.select("transaction_bk", F.xxhash64("transaction_bk").alias("h"), asked)
        rows = rows.select("transaction_bk", "h", "s.segment", F.pmod("h", "s.n").alias("bucket"))
        hit = reduce(lambda a, b: a & b, [is_set(F.col("words"), place(F.col("h"), k)) for k in range(HASHES)])
        return rows.join(filters, ["segment", "bucket"]).where(hit).select("transaction_bk", "segment", "bucket")

    def known(self, keys: DataFrame, before: int) -> DataFrame | None:
        """Those of the keys that batches before the given one have; opens only the segments in question."""
        spark = keys.sparkSession
        found = self.suspects(keys, before)
        if found is None:
            return None
        # stored, as it is read twice: for the names of the segments, and for the keys
        shared_dir(spark)
        found = found.checkpoint()
        opened = [r["segment"] for r in found.select("segment").distinct().collect()]  # a few names
        if not opened:
            return None
        segments = [tuple(map(int, s.split("-"))) for s in opened]
        stored = self._read(spark, "keys", segments, "transaction_bk string, bucket bigint")
        return stored.join(found, ["segment", "bucket", "transaction_bk"], "left_semi").select("transaction_bk")


def place(h: Column, k: int) -> Column:
    """The k-th bit of a hash in its bitmap."""
    return F.pmod(F.shiftright(h, 15 * k // 2 + 3).bitwiseXOR(F.xxhash64(h, F.lit(k))), F.lit(BITMAP_BITS))


def is_set(words: Column, at: Column) -> Column:
    """A bit of a bitmap that is stored as words; the first of its eight bytes is the highest of a word."""
    inside = F.lit(56) - at.bitwiseAND(F.lit(56)) + at.bitwiseAND(F.lit(7))
    return F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), inside.cast("int")) == 1


@dataclass(frozen=True)
class Snapshots:
    """Latest counters as a snapshot after every FOLD batches, and the batches' own changes (`deltas`) since.

    A reader takes the last published snapshot before its batch and at most FOLD deltas or so; a snapshot that failed
    only makes the next one later. Snapshots are partitioned by client bucket, so a batch opens those of its clients.
    """

    root: str

    def last(self, spark: SparkSession, before: int) -> int | None:
        found = [s[0] for s in _ranges(names(spark, f"{self.root}/published")) if s[0] < before]
        return max(found, default=None)

    def path(self, upto: int) -> str:
        return f"{self.root}/upto={upto}"

    def publish(self, latest: DataFrame, upto: int, keep: int = 3) -> None:
        spark = latest.sparkSession
        bucket = counter_bucket("client_id")
        latest.withColumn("bucket", bucket).repartition(COUNTER_BUCKETS, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.path(upto))
        touch(spark, f"{self.root}/published/{upto}")
        for old in _ranges(names(spark, f"{self.root}/published"))[:-keep]:
            remove(spark, f"{self.root}/published/{old[0]}")
            remove(spark, self.path(old[0]))


def counter_bucket(client: str) -> Column:
    return F.pmod(F.xxhash64(client), F.lit(COUNTER_BUCKETS)).cast("int")
