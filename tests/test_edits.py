from datetime import datetime
from pathlib import Path

import pytest

from termweave.streaming.edits import (
    EditSpec,
    flags,
    read_edit_stream,
    stamp_template,
    start_tracking,
    track_edits,
    tracked_so_far,
)
from tests.fixtures import frame

SPEC = EditSpec(maintainers=("boss",), sheets_without_user=("Plain",))


def edit(row, old, new, user="ann", seq=1, sheet="Main", minute=0):
    return {
        "sheet": sheet, "row": row, "column": "x", "old_value": old, "new_value": new,
        "user": user, "ts": datetime(2024, 1, 1, 0, minute), "seq": seq,
    }


LOG = [
    edit(2, None, "a", "ann"),
    edit(2, "a", "b", "bob", seq=2),  # same time, later in the log
    edit(2, "b", "b", "cat", minute=5),  # same value
    edit(3, "a", None, "ann"),  # cleared
    edit(4, None, None),
    edit(4, "", ""),
    edit(5, "a", "b", "boss"),
    edit(6, "a", "b", sheet="READ"),
    edit(1, "a", "b"),  # header row
    edit(7, "a", "b", sheet="Plain"),
    edit(8, "a", "b", "ann", seq=9, minute=1),
    edit(8, "b", "c", "boss", seq=10, minute=2),
    edit(9, "a", "b", None),
]
EXPECTED = {
    ("Main", 2, "1", "bob"),
    ("Main", 3, "1", "ann"),
    ("Main", 1, "1", None),
    ("Plain", 7, "1", None),
    ("Main", 8, "1", "ann"),
    ("Main", 9, "1", None),
}


def found(df):
    rows = [tuple(r) for r in flags(df).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("partitions", [1, 4])
def test_batch(spark, partitions):
    assert found(track_edits(frame(spark, "edit_log", LOG).repartition(partitions), SPEC)) == EXPECTED


def test_stream_equals_batch_in_any_order_of_arrival(spark, tmp_path):
    log, work = str(tmp_path / "log"), str(tmp_path / "work")
    for part in (LOG[7:], LOG[:3], LOG[3:7]):
        frame(spark, "edit_log", part).coalesce(1).write.mode("append").parquet(log)
    for _ in range(2):  # the second run finds nothing new
        query = start_tracking(read_edit_stream(spark, log, max_files=1), work, SPEC, available_now=True)
        query.awaitTermination()
    assert found(tracked_so_far(spark, work)) == EXPECTED
    frame(spark, "edit_log", [edit(2, "b", "z", "dan", seq=3)]).write.mode("append").parquet(log)
    start_tracking(read_edit_stream(spark, log), work, SPEC, available_now=True).awaitTermination()
    assert found(tracked_so_far(spark, work)) == EXPECTED - {("Main", 2, "1", "bob")} | {
        ("Main", 2, "1", "dan")
    }


def test_stamp_template(spark):
    template = spark.createDataFrame([(2, "x", None), (4, "y", 7)], "row int, v string, EditTracker int")
    stamped = stamp_template(template, track_edits(frame(spark, "edit_log", LOG), SPEC), "Main")
    assert {tuple(r) for r in stamped.collect()} == {(2, "x", 1, "bob"), (4, "y", 7, None)}


def test_no_rows_before_the_first_batch(spark, tmp_path):
    assert found(tracked_so_far(spark, str(tmp_path))) == set()


def test_history_is_compacted(spark, tmp_path):
    log, work = str(tmp_path / "log"), str(tmp_path / "work")
    for k in range(7):
        frame(spark, "edit_log", [edit(2 + k % 3, None, f"v{k}", f"user{k}", seq=k)]).write.mode("append").parquet(log)
    read = read_edit_stream(spark, log, max_files=1)
    start_tracking(read, work, SPEC, available_now=True, compact_after=3).awaitTermination()
    left = sorted(p.name.partition("=")[0] for p in Path(work, "states").iterdir() if "=" in p.name)
    assert left.count("snapshot") <= 2 and left.count("batch") < 6  # those of two cycles
    users = {r.row: r.User for r in tracked_so_far(spark, work).collect()}
    whole = {r.row: r.User for r in track_edits(spark.read.parquet(log), SPEC).collect()}
    assert users == whole and len(users) == 3


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    from termweave.streaming.edits import _write_batch

    write = _write_batch(str(tmp_path), 3)
    batches = [track_edits(frame(spark, "edit_log", [edit(2, None, "a", f"u{k}", seq=k)]), SPEC) for k in range(3)]
    for k in (0, 0, 1, 1, 2, 2):  # the last one comes again after it was merged
        write(batches[k], k)
    assert found(tracked_so_far(spark, str(tmp_path))) == {("Main", 2, "1", "u2")}


def batches_of(spark, n):
    edits = [[edit(2 + k % 2, None, "a", f"u{k}", seq=k)] for k in range(n)]
    return [track_edits(frame(spark, "edit_log", rows), SPEC) for rows in edits]


def test_a_reader_keeps_its_version_while_batches_are_merged(spark, tmp_path):
    from termweave.streaming.edits import _write_batch

    write, work = _write_batch(str(tmp_path), 3), str(tmp_path)
    batches = batches_of(spark, 12)
    for k in range(2):
        write(batches[k], k)
    early = tracked_so_far(spark, work)  # its files are listed, not read
    write(batches[2], 2)  # merges all three
    late = tracked_so_far(spark, work)
    for k in range(3, 5):
        write(batches[k], k)
    assert found(early) == {("Main", 2, "1", "u0"), ("Main", 3, "1", "u1")}
    assert found(late) == {("Main", 2, "1", "u2"), ("Main", 3, "1", "u1")}
    for k in range(5, 12):
        write(batches[k], k)
    assert found(tracked_so_far(spark, work)) == {("Main", 2, "1", "u10"), ("Main", 3, "1", "u11")}
    left = [p.name for p in Path(work, "states").iterdir() if p.name.startswith(("batch=", "snapshot="))]
    assert "batch=0" not in left and "snapshot=2" not in left and len(left) <= 2 + 5


def test_what_no_version_names_is_not_read(spark, tmp_path):
    from termweave.streaming.edits import _write_batch

    write, work = _write_batch(str(tmp_path), 3), str(tmp_path)
    batches = batches_of(spark, 3)
    write(batches[0], 0)
    # an executor or the driver was lost before the version of batch 1 was in place
    batches[2].write.parquet(f"{work}/states/batch=1")
    assert found(tracked_so_far(spark, work)) == {("Main", 2, "1", "u0")}
    write(batches[1], 1)
    assert found(tracked_so_far(spark, work)) == {("Main", 2, "1", "u0"), ("Main", 3, "1", "u1")}
