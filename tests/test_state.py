import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_set
from twinview import streaming
from twinview.schema import ACTIVITY_BY_PRODUCT
from twinview.streaming import state, windows

NOW = {"availableNow": True}
OFTEN = {"processingTime": "1 second"}
ROWS = "product string, timestamp_hour long, action string, visitor string, at long"


@pytest.fixture
def log(spark):
    found = streaming.watch_progress(spark)
    yield found
    spark.streams.removeListener(found)


@pytest.fixture
def landed(spark, tmp_path):
    """Parts of clicks as a stream with a micro-batch for each."""
    def land(*parts):
        path = str(tmp_path / "landing")
        for rows in parts:
            spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(path)
            time.sleep(0.02)
        return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(path)

    return land


def random_parts(seed, times, hot=0.4):
    rng = random.Random(seed)
    return [[(("hot" if rng.random() < hot else rng.choice([None, "A", "B", f"rare {at}"])), rng.choice([0, 0, 1, None]),
              rng.choice(["purchase", "add_to_cart", "page_view", "other", None]), rng.choice([None, *"vwxyz", f"{at}"]), at)
             for _ in range(60)] for at in times]


def live_rows(parts, ttl, now):
    """Each live key's clicks since it last started over."""
    runs = {}
    for rows in parts:
        for key in {r[:2] for r in rows}:
            at, mine = rows[0][4], [r for r in rows if r[:2] == key]
            last, known = runs.get(key, (None, []))
            runs[key] = (at, (known if last is not None and at - last <= ttl else []) + mine)
    return {key: rows for key, (last, rows) in runs.items() if now - last <= ttl}


def counted(rows):
    return tuple(sum(r[2] == action for r in rows) for action in ("purchase", "add_to_cart", "page_view"))


@pytest.mark.parametrize("kind", ["activity", "exact"])
def test_state_is_that_of_the_current_run(spark, landed, log, tmp_path, kind):
    ttl, times = 10**6, [0, 10**6, 1_500_000, 4_000_000, 4_100_000]
    parts, checkpoint = random_parts(1, times), str(tmp_path / "checkpoint")
    query = streaming.start_state_view(landed(*parts), checkpoint, kind, ttl, F.col("at"), OFTEN)
    streaming.stop_after(query, log, seconds=120)
    for now in (times[-1], times[-1] + ttl, times[-1] + ttl + 1):
        found = {tuple(r)[:2]: tuple(r)[2:] for r in streaming.state_view(spark, checkpoint, kind, ttl, now).collect()}
        expected = live_rows(parts, ttl, now)
        if kind == "activity":
            assert found == {k: counted(rows) for k, rows in expected.items()}
        else:
            assert found == {k: (len({r[3] for r in rows} - {None}),) for k, rows in expected.items()}


def test_many_visitors_over_growing_pages(spark, landed, log, tmp_path):
    """Known and new visitors of a large key, beside small ones; the third part is small, the last starts over."""
    ttl, times, rng = 10**6, [0, 10, 20, 30, 4_000_000], random.Random(9)
    sizes = [3000, 9000, 30, 5000, 2000]
    parts = [[("hot" if rng.random() < 0.95 else rng.choice(["A", None]), 0, "page_view", rng.choice([None, *[f"v{rng.randrange(20_000)}"] * 50]), at)
              for _ in range(size)] for at, size in zip(times, sizes)]
    stream, checkpoint = landed(*parts), str(tmp_path / "checkpoint")
    query = streaming.start_state_view(stream, checkpoint, "exact", ttl, F.col("at"), OFTEN)
    streaming.stop_after(query, log, seconds=120)
    expected = live_rows(parts, ttl, times[-1])
    found = {tuple(r)[:2]: r.unique_visitors for r in streaming.state_view(spark, checkpoint, "exact", ttl, times[-1]).collect()}
    assert found == {k: len({r[3] for r in rows} - {None}) for k, rows in expected.items()}
    changed = {r.batch_id: r.state_rows for r in log.reports(query)}
    most = live_rows(parts[:4], ttl, times[3])["hot", 0]
    assert len({r[3] for r in most}) > 6000
    assert changed[3] < 1500  # not a row for each visitor


def test_a_task_combines_all_its_visitors(spark):
    """What is shuffled for a key is some rows a task, not some for each Arrow batch; long lists are cut."""
    clicks = spark.range(0, 60_000, numPartitions=2).selectExpr(
        "if(id % 3 = 0, null, concat('P', id % 3)) AS product", "id % 50 AS timestamp_hour", "if(id % 7 = 0, null, concat('v', id % 9000)) AS visitor",
        "id % 5 AS now_ms")
    rows = state._combined_visitors(clicks)
    assert rows.count() == 2 * 150 * state.SHARDS
    found = rows.select("product", "timestamp_hour", F.explode("visitors").alias("visitor")).distinct()
    assert as_set(found) == as_set(clicks.where("visitor IS NOT NULL").select(*found.columns).distinct())
    few = state._combined_visitors(clicks.withColumn("timestamp_hour", F.lit(0).cast("long")).withColumn("product", F.lit("P")))
    assert few.agg(F.max(F.size("visitors"))).first()[0] == state.LISTED
    counts = state._combined_counts(clicks.withColumn("now_ms", F.lit(0).cast("long")).withColumn("action", F.lit("purchase")))
    assert counts.count() == 2 * 150 and counts.agg(F.sum("purchase_count")).first()[0] == 60_000


def test_a_key_without_visitors(spark, landed, log, tmp_path):
    parts = [[("A", 0, "x", None, 0)], [("B", 0, "x", "v", 1)]]
    streaming.stop_after(streaming.start_state_view(landed(*parts), str(tmp_path / "c"), "exact", 10**6, F.col("at"), OFTEN), log, seconds=float("inf"))
    assert as_set(streaming.state_view(spark, str(tmp_path / "c"), "exact", 10**6, 1)) == [("A", 0, 0), ("B", 0, 1)]


@pytest.mark.parametrize("kind", ["activity", "exact"])
def test_the_store_drops_state_by_itself(spark, landed, log, tmp_path, kind):
    checkpoint = str(tmp_path / "checkpoint")
    query = streaming.start_state_view(landed(*random_parts(2, [0])), checkpoint, kind, 3_000, trigger=OFTEN)
    assert log.wait(query, lambda r: r.state_rows > 0, 60) is not None
    emptied = log.wait(query, lambda r: r.batch_id > 0 and r.state_rows == 0, 60)
    query.stop()
    assert emptied is not None and emptied.rows == 0


def test_unknown_kind(spark, landed):
    with pytest.raises(ValueError, match="kind"):
        streaming.keyed_state(landed([("A", 0, "x", "v", 0)]), "other")


def test_aggregate_state_without_a_changelog(spark, landed, tmp_path):
    parts, path = random_parts(3, [0, 1]), str(tmp_path / "view")
    view = streaming.activity_view_stream(landed(*parts))
    streaming.upsert_view(view, path, trigger=NOW).awaitTermination()
    state = streaming.aggregate_state(spark, f"{path}/_checkpoint", ACTIVITY_BY_PRODUCT.names[2:])
    assert state.columns == ACTIVITY_BY_PRODUCT.names
    assert as_set(state) == as_set(streaming.latest_view(spark, path, view.schema))


def window_of(parts, now, length):
    rows = [r for part in parts for r in part if now - length < r[4] <= now]
    return {(*key, *counted([r for r in rows if r[:2] == key])) for key in {r[:2] for r in rows}}


def test_window_after_each_micro_batch(spark, landed, tmp_path):
    """Times at the bound, gaps longer than the window, panes without rows of a key; windows kept."""
    times = [0, 4, 8, 12, 13, 40, 44, 100, 101]
    parts, path, clock = random_parts(4, times), str(tmp_path / "window"), iter(times)
    streaming.start_window_view(landed(*parts), path, 12, lambda: next(clock), trigger=NOW, keep=3).awaitTermination()
    found = {}
    for at, *row in map(tuple, streaming.window_history(spark, path).collect()):
        found.setdefault(at, set()).add(tuple(row))
    assert found == {t: window_of(parts, t, 12) for t in times[-3:]}
    for now in (101, 111, 112, 113):
        assert {tuple(r) for r in streaming.window_view(spark, path, 12, now).collect()} == window_of(parts, now, 12)
    assert windows._stored(spark, path, "panes") == [6, 7, 8] or windows._stored(spark, path, "panes")[0] >= 5


def test_window_of_a_micro_batch_done_again(spark, landed, tmp_path, monkeypatch):
    parts, path, times = random_parts(5, [0, 4, 8, 12]), str(tmp_path / "window"), [0, 4, 8, 12]
    stream, clock, write, fails = landed(*parts), itertools.count(), windows.write_changes, [True]

    def failing(rows, folder, batch_id):
        write(rows, folder, batch_id)
        if batch_id == 2 and folder.endswith("window") and fails.pop():
            raise OSError("lost after the write")

    monkeypatch.setattr(windows, "write_changes", failing)
    with pytest.raises(Exception, match="lost after the write"):
        streaming.start_window_view(stream, path, 9, lambda: times[next(clock)], trigger=NOW).awaitTermination()
    fails.append(False)
    again = itertools.count(2)
    streaming.start_window_view(stream, path, 9, lambda: times[next(again)], trigger=NOW).awaitTermination()
    assert {tuple(r) for r in streaming.window_view(spark, path, 9, 12).collect()} == window_of(parts, 12, 9)


def test_window_without_data(spark, tmp_path):
    assert streaming.window_view(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(ValueError, match="keep"):
        streaming.start_window_view(None, "x", keep=1)


def test_late_clicks_are_left_out_of_closed_buckets(spark, landed, tmp_path):
    rows = [[("A", 10, "purchase"), (None, 10, "purchase"), ("A", None, "purchase")],
            [("A", 10, "purchase"), ("A", 50_010, "page_view")],
            [("A", 10, "purchase"), ("A", 60_010, "page_view")],
            [("A", 10, "purchase"), ("A", 50_010, "purchase")]]
    path = str(tmp_path / "closed")
    parts = [[(*r, "v", 0) for r in part] for part in rows]
    closed = streaming.closed_activity_view(landed(*parts), "10 seconds")
    streaming.append_view(closed, path, trigger=NOW).awaitTermination()
    found = streaming.read_changes(spark, path, ACTIVITY_BY_PRODUCT).drop("batch_id")
    # closed once 50010 has come: micro-batch 2 is the first to know, 3 the first to drop
    assert as_set(found) == [(None, 10, 1, 0, 0), ("A", 10, 3, 0, 0), ("A", 50_010, 1, 0, 1)]


def test_stop_after_a_batch_and_resume(spark, landed, log, tmp_path):
    parts, path = random_parts(6, [0, 1, 2]), str(tmp_path / "view")
    view = streaming.activity_view_stream(landed(*parts))
    report = streaming.stop_after(streaming.upsert_view(view, path, trigger=OFTEN), log, batch_id=0)
    assert (report.batch_id, report.rows) == (0, 60) and report.state_rows > 0 and report.millis > 0
    query = streaming.upsert_view(view, path, trigger=OFTEN)
    assert streaming.stop_after(query, log, rows=120).batch_id == 2
    table = streaming.progress_table(spark, log, query)
    assert as_set(table, "batch_id", "rows") == [(1, 60), (2, 60)]
    rows = [r for part in parts for r in part]
    assert {tuple(r) for r in streaming.latest_view(spark, path, view.schema).collect()} == {
        (*key, *counted([r for r in rows if r[:2] == key])) for key in {r[:2] for r in rows}}


def test_an_error_of_the_query_is_raised(spark, landed, log, tmp_path):
    failing = landed(*random_parts(7, [0])).withColumn("x", F.raise_error(F.lit("broken")).cast("long"))
    query = failing.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start()
    with pytest.raises(Exception, match="broken"):
        streaming.stop_after(query, log, batch_id=5, seconds=60)


def test_published_view_is_compacted(spark, landed, tmp_path, monkeypatch):
    monkeypatch.setattr(streaming.queries, "COMPACT_EVERY", 2)
    parts, path = random_parts(8, range(7)), str(tmp_path / "published")
    view = streaming.activity_view_stream(landed(*parts))
    streaming.publish_view(view, "compactedActivity", path, keys=["product", "timestamp_hour"], trigger=NOW).awaitTermination()
    rows = [r for part in parts for r in part]
    assert {tuple(r) for r in spark.table("compactedActivity").collect()} == {
        (*key, *counted([r for r in rows if r[:2] == key])) for key in {r[:2] for r in rows}}
    assert len(list((tmp_path / "published" / "changes").iterdir())) <= 4
