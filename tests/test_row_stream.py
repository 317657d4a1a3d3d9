"""Micro-batches bounded by rows: batch sizes, order, restart in the middle of a file, unfinished lines."""

import os

import pytest

from cardwatch.session import run_dir
from cardwatch.sources.row_stream import TextRowReader, row_events


def run(spark, folder, root, rows):
    """Drain the folder; the lines of each micro-batch in the order of their arrival."""
    got = {}

    def keep(df, batch_id):
        got[batch_id] = [(r["value"].decode(), r["arrival"]["row"]) for r in df.orderBy("arrival").collect()]

    query = row_events(spark, folder, rows).writeStream.option("checkpointLocation", f"{root}/cp").foreachBatch(keep).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return {k: v for k, v in got.items() if v}


@pytest.fixture
def inbox(tmp_path):
    def put(name, data, time):
        path = tmp_path / name
        path.write_bytes(data)
        os.utime(path, (time, time))

    return tmp_path, put


def test_batches_of_rows_and_restart(spark, inbox):
    folder, put = inbox
    root = run_dir(spark, "rows")
    # the first file by time is the last by name, and a batch ends inside each of them
    put("b.txt", b"".join(b"first %d\n" % i for i in range(650)), 1_000_000)
    put("a.txt", b"".join(b"second %d\r\n" % i for i in range(350)), 1_000_001)
    got = run(spark, str(folder), root, 200)
    assert [len(v) for _, v in sorted(got.items())] == [200] * 5
    lines = [x for _, v in sorted(got.items()) for x in v]
    assert lines == [(f"first {i}", i) for i in range(650)] + [(f"second {i}", i) for i in range(350)]
    # an unfinished line waits for its end; the stream goes on with the line after the last one read
    put("c.txt", b"third 0\n\nthird 2", 1_000_002)
    assert list(run(spark, str(folder), root, 200).values()) == [[("third 0", 0), ("", 1)]]
    put("c.txt", b"third 0\n\nthird 2\nthird 3\n", 1_000_002)
    assert list(run(spark, str(folder), root, 200).values()) == [[("third 2", 2), ("third 3", 3)]]
    assert run(spark, str(folder), root, 200) == {}


def test_places_are_stable(inbox):
    folder, put = inbox
    reader = TextRowReader(str(folder), 3, 0)
    start = reader.initialOffset()
    assert reader.latestOffset() == start and reader.partitions(start, start) == []
    for i in range(3):
        put(f"{i}.txt", b"x\ny\n", 2_000_000 + i)
    put("_hidden", b"no\n", 2_000_000)
    end = reader.latestOffset()
    assert reader.latestOffset() == end  # asking twice doesn't skip a row
    pieces = [(os.path.basename(p.name), p.start, p.end, p.row) for p in reader.partitions(start, end)]
    assert pieces == [("0.txt", 0, 4, 0), ("1.txt", 0, 2, 0)]
    # another reader, as after a restart, plans the same pieces for the same places, also when more files came
    put("9.txt", b"z\n", 3_000_000)
    again = TextRowReader(str(folder), 3, 0)
    assert [(os.path.basename(p.name), p.start, p.end, p.row) for p in again.partitions(start, end)] == pieces
    last = again.latestOffset()
    assert [(os.path.basename(p.name), p.start, p.row) for p in again.partitions(end, last)] == [("1.txt", 2, 1), ("2.txt", 0, 0)]
    with pytest.raises(ValueError):
        TextRowReader(str(folder), 0, 0)


def test_lanes_share_the_lines(inbox):
    folder, put = inbox
    put("a.txt", b"".join(b"%d\n" % i for i in range(5)), 2_000_000)
    put("b.txt", b"".join(b"%d\n" % i for i in range(5, 20)), 2_000_001)

    def drain(reader, at):
        got = []
        while (end := reader.latestOffset()) != at:
            pieces = reader.partitions(at, end)
            again = TextRowReader(str(folder), 3, 0, reader.lanes, reader.lane).partitions(at, end)
            assert [vars(p) for p in again] == [vars(p) for p in pieces]
            got.append([int(x) for p in pieces for b in reader.read(p) for x in b.column(0).to_pylist()])
            at = end
        return got, at

    readers = [TextRowReader(str(folder), 3, 0, 4, lane) for lane in range(4)]
    ends = [drain(r, r.initialOffset()) for r in readers]
    # the blocks in turn, one of them from two files, and the last one not full yet
    assert [got for got, _ in ends] == [[[0, 1, 2], [12, 13, 14]], [[3, 4, 5], [15, 16, 17]], [[6, 7, 8], [18, 19]], [[9, 10, 11]]]
    # lines that come later go to the block that was not full, and then on
    put("c.txt", b"".join(b"%d\n" % i for i in range(20, 24)), 2_000_002)
    assert [drain(r, at)[0] for r, (_, at) in zip(readers, ends)] == [[], [], [[20]], [[21, 22, 23]]]
    with pytest.raises(ValueError):
        TextRowReader(str(folder), 3, 0, 4, 4)
