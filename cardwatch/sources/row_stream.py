"""A stream of text lines whose micro-batches are bounded by rows: Spark's own file source counts files only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from cardwatch.session import with_package
from cardwatch.sources.events import BATCH_MESSAGES

FORMAT = "text_rows"
CHUNK = 1 << 16
_START = {"time": -1, "name": "", "byte": 0, "row": 0, "n": 0}


class Piece(InputPartition):
    """Complete lines of one file: bytes from `start` to `end`, the first of them line number `row`."""

    def __init__(self, time: int, name: str, start: int, end: int, row: int):
        self.time, self.name, self.start, self.end, self.row = time, name, start, end, row


class TextRows(DataSource):
    """Options: `path`; `rows`, the most lines of a micro-batch; `settle`, seconds that a file rests before it is read;
    `lanes` and `lane`, to read one block of `rows` lines in so many."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value binary, time bigint, name string, row bigint"

    def streamReader(self, schema) -> TextRowReader:
        rows, settle = int(self.options.get("rows", BATCH_MESSAGES)), float(self.options.get("settle", 0))
        return TextRowReader(self.options["path"], rows, settle, int(self.options.get("lanes", 1)), int(self.options.get("lane", 0)))


class TextRowReader(DataSourceStreamReader):
    """Lines in the order of the files' times (microseconds) and names.

    An offset is the place after the last line: file, byte, row, and the lines before it in all files. The planner lists
    the folder and reads only the lines of the next batch to find their end; the tasks read the bytes between two places
    again. A last line without a line end waits for it, so a file may grow; a file whose time changes while it is read would count as
    new, and one that comes with a time before the place is not seen: files are moved in whole, and `settle` gives
    those that come at about the same time the time to be listed in order.

    The lines of all files are blocks of `rows` lines, and a reader takes the blocks of its lane (block number modulo
    `lanes`), so that several streams share the lines and none is read twice. A micro-batch never spans two blocks then;
    the planner also reads the lines of the other lanes, to count them. A checkpoint keeps its lanes.
    """

    def __init__(self, path: str, rows: int, settle: float, lanes: int = 1, lane: int = 0):
        if rows < 1:
            raise ValueError("a micro-batch needs one row at least")
        if not 0 <= lane < lanes:
            raise ValueError("lanes are numbered from 0")
        self.path, self.rows, self.settle, self.lanes, self.lane = path, rows, settle, lanes, lane
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return dict(_START)

    def latestOffset(self) -> dict:
        # what was planned last is the place to go on from, also after a restart: the engine plans or commits it again
        return self._walk(self.at or _START)[1]

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        self.at = end
        return self._walk(start, end)[0]

    def commit(self, end: dict) -> None:
        self.at = self.at or end

    def _files(self, start: dict) -> tuple[fs.FileSystem, list[tuple[int, str, int]]]:
        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        found = []
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            hidden = info.base_name.startswith(("_", "."))
            if info.type == fs.FileType.File and not hidden:
                found.append((info.mtime_ns // 1000, info.path, info.size))
        return store, sorted(f for f in found if f[:2] >= (start["time"], start["name"]))

    def _walk(self, start: dict, end: dict | None = None) -> tuple[list[Piece], dict]:
        """The pieces from `start` on, up to `end` or as many rows as a batch has, and the place behind them."""
        store, files = self._files(start)
        pieces, at, (skip, left) = [], start, self._due(start.get("n", 0))
        n_at = start.get("n", 0) + skip
        if end is None and self.settle:
            import time

            files = [f for f in files if f[0] <= (time.time() - self.settle) * 1e6]
        for stamp, name, size in files:
            here = (stamp, name) == (start["time"], start["name"])
            byte, row = (start["byte"], start["row"]) if here else (0, 0)
            if end is not None and (stamp, name) > (end["time"], end["name"]):
                break
            if skip:
                byte, n = _lines(store, name, byte, size, skip)
                row, skip = row + n, skip - n
                if skip:
                    continue
            if end is None:
                upto, n = _lines(store, name, byte, size, left)
            elif (stamp, name) < (end["time"], end["name"]):
                upto, n = _lines(store, name, byte, size, self.rows)
            else:
                upto, n = end["byte"], end["row"] - row
            if n:
                pieces.append(Piece(stamp, name, byte, upto, row))
                n_at, left = n_at + n, left - n
                at = {"time": stamp, "name": name, "byte": upto, "row": row + n, "n": n_at}
            if end is None and not left:
                break
        return pieces, at

    def _due(self, n: int) -> tuple[int, int]:
        """How many lines of other lanes follow the first n lines, and how many of this lane then."""
        if self.lanes == 1:
            return 0, self.rows
        block, inside = divmod(n, self.rows)
        blocks = (self.lane - block) % self.lanes
        return (blocks * self.rows - inside, self.rows) if blocks else (0, self.rows - inside)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else fs.LocalFileSystem()
        with store.open_input_file(partition.name) as f:
            f.seek(partition.start)
            data = f.read(partition.end - partition.start)
        lines = [x.removesuffix(b"\r") for x in data.split(b"\n")[:-1]]
        n = len(lines)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(lines, pa.binary()),
                pa.array([partition.time] * n, pa.int64()),
                pa.array([partition.name] * n, pa.string()),
                pa.array(range(partition.row, partition.row + n), pa.int64()),
            ],
            ["value", "time", "name", "row"],
        )


def _lines(store: fs.FileSystem, name: str, start: int, size: int, most: int) -> tuple[int, int]:
    """The byte behind the last of at most so many complete lines from `start` on, and how many they are."""
    end, n, at = start, 0, start
    with store.open_input_file(name) as f:
        f.seek(start)
        while n < most and at < size:
            data = f.read(min(CHUNK, size - at))
            if not data:
                break
            found = -1
            while n < most and (found := data.find(b"\n", found + 1)) >= 0:
                n, end = n + 1, at + found + 1
            at += len(data)
    return end, n


def row_events(
    spark: SparkSession, folder: str, rows: int = BATCH_MESSAGES, settle: float = 0, lanes: int = 1, lane: int = 0
) -> DataFrame:
    """`value` and `arrival` of the lines of text files in a folder, at most so many in a micro-batch.

    Lines come in the order of their files' time and name, and of the lines in them; the place in the query's
    checkpoint is a line, so a restart goes on with the next one. A micro-batch has a fixed cost whatever its rows; where
    that is too slow, `lanes` streams, each with its `lane` and checkpoint, take the blocks of `rows` lines in turn.
    """
    with_package(spark)
    spark.dataSource.register(TextRows)
    raw = spark.readStream.format(FORMAT).option("rows", rows).option("settle", settle).option("lanes", lanes).option("lane", lane).load(folder)
    arrival = F.struct(
        F.timestamp_micros("time").alias("at"), F.col("name").alias("part"), F.lit(0).cast("bigint").alias("block"), F.col("row").alias("row")
    )
    return raw.select("value", arrival.alias("arrival"))
