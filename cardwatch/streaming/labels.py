"""Labels that come after their transactions, or before them, kept beside the fact and merged when it is read.

Every batch of labels writes a folder of its own and counts once it is committed, so the fact is never rewritten and a
batch touches nothing but its own labels. `FOLD` folders of one level become one of the next, so that a reader opens a
number of folders that grows with the logarithm of the batches and a label is written anew once a level. A label
whose transaction is not known yet waits in the store and applies as soon as the fact has the row.

Of several labels for one transaction a fraud outranks a legitimate one, whatever their order, so a batch that runs
again or labels that come twice change nothing. Labels without a key or a verdict are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwatch.operators.load import complete_labels
from cardwatch.sources.tables import names, remove, touch
from cardwatch.streaming.store import FOLD, Commits, _ranges

LABELS = "transaction_bk string, is_fraud boolean, fraud_type string"
Segment = tuple[int, int, int]  # first batch, last batch, level


def _best(labels: DataFrame) -> DataFrame:
    """One label for each transaction."""
    best = F.max(F.struct("is_fraud", "fraud_type")).alias("l")
    known = labels.where(F.col("transaction_bk").isNotNull() & F.col("is_fraud").isNotNull())
    return known.groupBy("transaction_bk").agg(best).select("transaction_bk", "l.is_fraud", "l.fraud_type")


@dataclass(frozen=True)
class LabelStore:
    root: str

    @property
    def commits(self) -> Commits:
        return Commits(f"{self.root}/commits")

    def path(self, segment: Segment) -> str:
        first, last, level = segment
        return f"{self.root}/labels/{first}-{last}-{level}"

    def live(self, spark: SparkSession) -> list[Segment]:
        """The folders to read, in order: merged ones before the batches that they hold."""
        out: list[Segment] = []
        merged = _ranges(names(spark, f"{self.root}/published"))
        for first, last, level in sorted(merged, key=lambda s: -s[2]):
            if not any(a <= first and last <= b for a, b, _ in out):
                out.append((first, last, level))
        ids = self.commits.ids(spark, 0, 1 << 62)
        held = {b for first, last, _ in out for b in range(first, last + 1)}
        return sorted(out + [(b, b, 0) for b in ids if b not in held])

    def add(self, labels: DataFrame, batch_id: int) -> None:
        """Store a batch of labels; it counts when this returns, and may run again until the next one begins."""
        spark = labels.sparkSession
        self.fold(spark, batch_id)
        _best(labels).write.mode("overwrite").parquet(self.path((batch_id, batch_id, 0)))
        self.commits.add(spark, batch_id)

    def fold(self, spark: SparkSession, before: int) -> None:
        """Merge the last `FOLD` folders of a level into one, as often as there are so many.

        Only batches before the given one take part. What a merge replaces is removed at the next merge of its level, so
        that readers that began before can end.
        """
        while True:
            last = [s for s in self.live(spark) if s[1] < before][-FOLD:]
            if len(last) < FOLD or len({level for *_, level in last}) > 1:
                return
            whole = (last[0][0], last[-1][1], last[0][2] + 1)
            _best(self._read(spark, last)).write.mode("overwrite").parquet(self.path(whole))
            touch(spark, f"{self.root}/published/{'-'.join(map(str, whole))}")
            kept = set(self.live(spark))
            for old in _ranges(names(spark, f"{self.root}/labels")):
                if old not in kept and old[2] == whole[2] - 1 and old[1] < whole[0]:
                    remove(spark, f"{self.root}/published/{'-'.join(map(str, old))}")
                    remove(spark, self.path(old))

    def _read(self, spark: SparkSession, segments: list[Segment]) -> DataFrame:
        if not segments:
            return spark.createDataFrame([], LABELS)
        return spark.read.schema(LABELS).parquet(*[self.path(s) for s in segments])

    def labels(self, spark: SparkSession) -> DataFrame:
        """All labels, in as many rows for a transaction as there are folders that hold it."""
        return self._read(spark, self.live(spark))

    def complete(self, fact: DataFrame) -> DataFrame:
        """The fact with its labels; one that the fact has itself stays."""
        return complete_labels(fact, self.labels(fact.sparkSession))


def start_labels(stream: DataFrame, store: LabelStore, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keep the labels of a stream (transaction_bk, is_fraud, fraud_type)."""
    writer = stream.writeStream.foreachBatch(store.add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
