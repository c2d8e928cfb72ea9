import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_set
from tests.test_tables import flat
from twinview import files, sinks, sources, streaming
from twinview.functions import HOUR_MS
from twinview.schema import MASTER
from twinview.sources import merges

WRITER = "0123456789abcdef"
ROW = ("Google", "page_view", "", "Page - 1", "V1", "P")


def append(spark, path, name, *buckets, topic="clicks", partition=0, until="1"):
    rows = [(*ROW, "0", until, topic, partition, bucket) for bucket in buckets]
    sinks.append_master(spark.createDataFrame(rows, MASTER), path, name)


def day(spark, path, batches=12):
    """Small writes of one stream to two closed buckets, an open one and a null one."""
    for n in range(batches):
        append(spark, path, f"{WRITER}-{n}", 0, 0, HOUR_MS, 9 * HOUR_MS, None, until=str(n + 1))


def live_folders(spark, path):
    """Folders that count, as (bucket, write), by the files that are read."""
    rows = merges.live(spark.read.schema(sources.master.STORED).parquet(path), path)
    return {tuple(r) for r in rows.select("timestamp_hour", "batch").distinct().collect()}


def test_closed_buckets_become_one_folder(spark, tmp_path):
    path = str(tmp_path / "master")
    day(spark, path)
    before = as_set(sources.read_master(spark, path))
    under_way = sources.read_master(spark, path)
    assert sinks.compact_master(spark, path, before_ms=5 * HOUR_MS) == 1
    assert as_set(sources.read_master(spark, path)) == before
    assert as_set(sources.read_master(spark, path, since_ms=0)) == [r for r in before if r[-1] is not None]
    newest = f"{WRITER}-11"
    closed = {(b, n) for b, n in live_folders(spark, path) if b is not None and b < 5 * HOUR_MS}
    assert closed == {(b, n) for b in (0, HOUR_MS) for n in ("merged-1", newest)}
    # one file for each bucket, however many micro-batches there were
    for bucket in (0, HOUR_MS):
        assert len(files.glob(spark, f"{path}/topic=clicks/kafkaPartition=0/timestamp_hour={bucket}/batch=merged-1/*.parquet")) == 1
    assert as_set(under_way) == before  # planned before the switch, read after it
    assert sinks.vacuum_master(spark, path, keep_ms=10**12) == 0
    assert sinks.vacuum_master(spark, path, keep_ms=0) == 22
    assert as_set(sources.read_master(spark, path)) == before
    assert not files.glob(spark, f"{path}/*/*/timestamp_hour=0/batch={WRITER}-3")
    assert sinks.compact_master(spark, path, before_ms=5 * HOUR_MS) is None  # but for the stream's newest all is one
    assert as_set(sources.read_master(spark, path)) == before


def test_nothing_to_merge(spark, tmp_path):
    path = str(tmp_path / "master")
    assert sinks.compact_master(spark, path, before_ms=HOUR_MS) is None
    append(spark, path, "one", 0)
    assert sinks.compact_master(spark, path, before_ms=HOUR_MS, since_ms=HOUR_MS) is None
    assert sinks.compact_master(spark, path, before_ms=0) is None
    assert sinks.compact_master(spark, path, before_ms=HOUR_MS) == 1
    assert sinks.compact_master(spark, path, before_ms=HOUR_MS) is None
    append(spark, path, "two", 0)
    assert sinks.compact_master(spark, path, before_ms=HOUR_MS) == 2


def test_a_write_done_again_changes_nothing(spark, tmp_path):
    """A stream's newest micro-batch and a job, before and after the old folders are deleted."""
    path = str(tmp_path / "master")
    day(spark, path, 4)
    append(spark, path, "job", 0, HOUR_MS)
    expected = as_set(sources.read_master(spark, path))
    for keep_ms in (10**12, 0):
        sinks.compact_master(spark, path, before_ms=5 * HOUR_MS)
        sinks.vacuum_master(spark, path, keep_ms=keep_ms)
        append(spark, path, f"{WRITER}-3", 0, 0, HOUR_MS, 9 * HOUR_MS, None, until="4")
        append(spark, path, "job", 0, HOUR_MS)
        assert as_set(sources.read_master(spark, path)) == expected


def test_late_clicks_are_read_and_merged_the_next_time(spark, tmp_path):
    path = str(tmp_path / "master")
    day(spark, path, 4)
    sinks.compact_master(spark, path, before_ms=5 * HOUR_MS)
    for n in (4, 5):
        append(spark, path, f"{WRITER}-{n}", 0)
    expected = as_set(sources.read_master(spark, path))
    assert len(expected) == 4 * 5 + 2
    assert sinks.compact_master(spark, path, before_ms=5 * HOUR_MS) == 2
    assert {n for b, n in live_folders(spark, path) if b == 0} == {"merged-2", f"{WRITER}-5"}
    assert as_set(sources.read_master(spark, path)) == expected


def test_a_merge_that_is_lost_never_counts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "master")
    day(spark, path, 4)
    expected = as_set(sources.read_master(spark, path))

    def lost(*args):
        raise OSError("the driver is gone")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(merges, "write_ends", lost)
        sinks.compact_master(spark, path, before_ms=5 * HOUR_MS)
    assert files.glob(spark, f"{path}/*/*/*/batch=merged-1")
    assert as_set(sources.read_master(spark, path)) == expected
    with pytest.raises(RuntimeError, match="under way"):
        sinks.compact_master(spark, path, before_ms=5 * HOUR_MS)
    assert sinks.compact_master(spark, path, before_ms=5 * HOUR_MS, stale_ms=0) == 2
    assert as_set(sources.read_master(spark, path)) == expected
    sinks.vacuum_master(spark, path, keep_ms=0)
    assert not files.glob(spark, f"{path}/*/*/*/batch=merged-1")
    assert as_set(sources.read_master(spark, path)) == expected


def test_odd_names_of_topics(spark, tmp_path):
    path = str(tmp_path / "master")
    for n in range(3):
        for topic in ("a b:c/d%", None):
            append(spark, path, f"{WRITER}-{n}", 0, topic=topic, partition=None if n else 3)
    expected = as_set(sources.read_master(spark, path))
    sinks.compact_master(spark, path, before_ms=HOUR_MS)
    sinks.vacuum_master(spark, path, keep_ms=0)
    assert as_set(sources.read_master(spark, path)) == expected


def test_offsets_are_noted_and_no_closed_write_is_scanned(spark, tmp_path):
    path, landing = str(tmp_path / "master"), str(tmp_path / "landing")
    rows = flat(spark, 40)
    rows.repartition(4).write.parquet(landing)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    streaming.append_master_stream(stream, path, trigger={"availableNow": True}).awaitTermination()
    assert as_set(sources.latest_offsets_of(spark, path)) == as_set(sources.latest_offsets(sources.read_master(spark, path)))
    sinks.append_master(flat(spark, 6, start=100), path, "job")  # without a note
    expected = as_set(sources.latest_offsets(sources.read_master(spark, path)))
    assert as_set(sources.latest_offsets_of(spark, path)) == expected and expected[0][-1] == 103
    sinks.compact_master(spark, path, before_ms=10**15)
    sinks.vacuum_master(spark, path, keep_ms=0)
    sinks.append_master(flat(spark, 2, start=200), path, "another job")
    expected = as_set(sources.latest_offsets(sources.read_master(spark, path)))
    for file in (tmp_path / "master").rglob("*.parquet"):  # a scan of any write but the last would fail
        if "another job" not in str(file):
            file.write_text("no parquet")
    spark.catalog.refreshByPath(path)
    assert as_set(sources.latest_offsets_of(spark, path)) == expected and expected[0][-1] == 201
    assert as_set(sources.latest_offsets_of(spark, str(tmp_path / "nothing"))) == []


def test_marker_files(spark, tmp_path):
    path = str(tmp_path / "marks" / "a")
    assert files.create(spark, path) and not files.create(spark, path)
    assert files.exists(spark, path) and files.age_ms(spark, path, time.time_ns() // 1_000_000) < 60_000
    files.delete(spark, [path])
    assert not files.exists(spark, path)
