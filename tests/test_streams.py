import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_set, click
from twinview import operators as ops
from twinview import sinks, sources, streaming
from twinview.functions import DAY_MS, HOUR_MS, MINUTE_MS
from twinview.plans import start_pipeline
from twinview.plans.speed import ACTIVITY_VIEW, VISITORS_VIEW
from twinview.schema import ACTIVITY_BY_PRODUCT, VIEW_KEYS
from twinview.streaming import live_view
from twinview.streaming.changelog import read_changes
from twinview.streaming.expiry import DELTAS, SEEN, append_batch

NOW = {"availableNow": True}
LIMIT = 120


def stream(spark, folder, **options):
    lines = sources.read_click_stream(spark, path=folder, max_files_per_trigger=1)
    return ops.parse_activity(lines, **options)


def batch(spark, folder):
    return ops.parse_activity(sources.read_click_lines(spark, folder))


def finish(query):
    assert streaming.await_for(query, LIMIT)


@pytest.fixture
def landed(land):
    """Four files with repeat visitors in and across them, late and future buckets, other actions."""
    for n in range(4):
        folder = land(
            *(click(h * HOUR_MS + n, a, v % (3 + n), f"P{v % 2}")
              for h in (0, 1, 50 - n) for a in ("purchase", "page_view", "error") for v in range(7)),
            "broken line",
        )
    return folder


@pytest.mark.parametrize("compacted", [False, True])
def test_running_counts_equal_the_batch_view(spark, landed, tmp_path, compacted):
    path = str(tmp_path / "view")
    view = streaming.activity_view_stream(stream(spark, landed))
    finish(streaming.upsert_view(view, path, trigger=NOW))
    if compacted:
        assert streaming.compact_view(spark, path, view.schema) == 3
    expected = ops.activity_by_product(batch(spark, landed))
    assert as_set(streaming.latest_view(spark, path, view.schema)) == as_set(expected)


@pytest.mark.parametrize("build", [streaming.visitor_view_stream, streaming.exact_visitors_stream])
def test_running_visitors_equal_the_batch_view(spark, landed, tmp_path, build):
    path, view = str(tmp_path / "view"), build(stream(spark, landed))
    finish(streaming.upsert_view(view, path, trigger=NOW))
    expected = ops.visitors_by_product(batch(spark, landed))
    assert as_set(streaming.latest_view(spark, path, view.schema)) == as_set(expected)


def test_literal_count_counts_clicks(spark, landed, tmp_path):
    path, view = str(tmp_path / "view"), streaming.exact_visitors_stream(stream(spark, landed), distinct=False)
    finish(streaming.upsert_view(view, path, trigger=NOW))
    expected = batch(spark, landed).groupBy(*VIEW_KEYS).count()
    assert as_set(streaming.latest_view(spark, path, view.schema)) == as_set(expected)


def test_state_store_settings_do_not_stay_in_the_session(spark):
    from twinview.session import STATE_SETTINGS, state_settings

    key = next(iter(STATE_SETTINGS))
    spark.conf.set(key, "mine")
    with state_settings(spark):
        assert spark.conf.get(key) == "mine"
    spark.conf.unset(key)


def test_restart_goes_on_where_it_stopped(spark, land, tmp_path):
    path = str(tmp_path / "view")
    folder = land(click(0, "purchase", 1, "P"), click(0, "page_view", 2, "P"))
    for expected in ((1, 0, 1), (2, 0, 1)):
        view = streaming.activity_view_stream(stream(spark, folder))
        finish(streaming.upsert_view(view, path, trigger=NOW))
        assert as_set(streaming.latest_view(spark, path, view.schema)) == [("P", 0, *expected)]
        land(click(0, "purchase", 3, "P"))


def test_a_table_is_not_continued_with_another_checkpoint(spark, land, tmp_path):
    folder, path = land(click()), str(tmp_path / "view")
    finish(streaming.start_expiring_view(stream(spark, folder), path, "exact", trigger=NOW))
    with pytest.raises(ValueError, match="not its checkpoint"):
        streaming.start_expiring_view(
            stream(spark, folder), path, "exact", checkpoint=str(tmp_path / "other"), trigger=NOW)


def forget_last_commit(checkpoint):
    """As if the job was lost after the last batch wrote its rows, before it was committed."""
    last = max(glob.glob(f"{checkpoint}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    crc = f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc"
    if os.path.exists(crc):
        os.remove(crc)


KINDS = ["activity", "visitors", "clicks", "exact"]


def in_batch(kind, clicks):
    return {
        "activity": ops.activity_by_product, "visitors": ops.visitors_by_product,
        "exact": ops.visitors_by_product, "clicks": lambda df: df.groupBy(*VIEW_KEYS).count(),
    }[kind](clicks)


@pytest.mark.parametrize("kind", KINDS)
def test_replayed_batch_changes_nothing(spark, landed, tmp_path, kind):
    path, expected = str(tmp_path / "view"), as_set(in_batch(kind, batch(spark, landed)))
    for _ in range(2):
        finish(streaming.start_expiring_view(stream(spark, landed), path, kind, clock=lambda: 5, trigger=NOW))
        assert as_set(live_view(spark, path, kind, now_ms=5)) == expected
        forget_last_commit(f"{path}/_checkpoint")


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("compacted", [False, True])
def test_idle_keys_expire_and_start_over(spark, land, tmp_path, kind, compacted):
    """Times 0, 60, 160 and 400 with a limit of 100: B is idle from 0 to 160, A from 160 on."""
    path, times = str(tmp_path / "view"), iter([0, 60, 160, 400])

    def step(*lines):
        finish(streaming.start_expiring_view(
            stream(spark, land(*lines)), path, kind, clock=lambda: next(times), trigger=NOW))
        if compacted:
            streaming.compact_expiring_view(spark, path, kind, ttl_ms=100)

    def alive(now_ms):
        rows = live_view(spark, path, kind, ttl_ms=100, now_ms=now_ms).collect()
        return {r.product: r.page_view_count if kind == "activity" else r.unique_visitors for r in rows}

    repeat = 3 if kind in ("activity", "clicks") else 2
    step(click(0, visitor=1, product="A"), click(0, visitor=1, product="B"))
    assert alive(0) == {"A": 1, "B": 1} and alive(100) == {"A": 1, "B": 1} and alive(101) == {}
    step(click(0, visitor=2, product="A"))
    assert alive(60) == {"A": 2, "B": 1} and alive(101) == {"A": 2}
    step(click(0, visitor=1, product="A"), click(0, visitor=1, product="B"))
    assert alive(160) == {"A": repeat, "B": 1}
    step(click(0, visitor=9, product="B"))
    assert alive(400) == {"B": 1}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("kind", ["activity", "exact"])
def test_expiry_equals_brute_force(spark, tmp_path, kind, seed):
    """Batches of random clicks at random times, some keys null, some idle for longer than the limit."""
    rng, now, ttl, state, path = random.Random(seed), 0, 50, {}, str(tmp_path / "view")
    schema = "timestamp_hour long, action string, visitor string, product string"
    for n in range(9):
        now += rng.choice([5, 20, 50, 51])
        clicks = [
            (rng.randrange(2) * HOUR_MS, "page_view", f"V{rng.randrange(6)}", rng.choice([None, *"ABCDEFGHIJK"]))
            for _ in range(rng.choice([3, 15, 40]))
        ]
        state = {k: old for k, old in state.items() if now - old[0] <= ttl}
        for hour, _, visitor, product in clicks:
            state[product, hour] = (now, [*state.get((product, hour), (0, []))[1], visitor])
        append_batch(spark.createDataFrame(clicks, schema), path, n, kind, now)
        if n in (3, 4, 7):
            streaming.compact_expiring_view(spark, path, kind, ttl)
    value = "page_view_count" if kind == "activity" else "unique_visitors"
    for later in (0, 30, 60):
        view = live_view(spark, path, kind, ttl, now + later).select(F.coalesce("product", F.lit("")), "timestamp_hour", value)
        assert as_set(view) == sorted(
            (key[0] or "", key[1], len(seen) if kind == "activity" else len(set(seen)))
            for key, (last, seen) in state.items() if now + later - last <= ttl
        )


@pytest.mark.parametrize("kind", KINDS)
def test_null_keys_are_one_key_in_all_views(spark, tmp_path, kind):
    path, rows = str(tmp_path / "view"), [(0, "page_view", "V1", None), (None, "page_view", "V2", "A"), (0, "page_view", None, "A")]
    clicks = spark.createDataFrame(rows, "timestamp_hour long, action string, visitor string, product string")
    for n in range(3):
        append_batch(clicks, path, n, kind, n)
    thrice = clicks.unionAll(clicks).unionAll(clicks)
    expected = in_batch(kind, thrice).toPandas().fillna(-1).sort_values(list(VIEW_KEYS), key=lambda c: c.astype(str))
    for _ in range(2):
        found = live_view(spark, path, kind, now_ms=2).toPandas().fillna(-1).sort_values(list(VIEW_KEYS), key=lambda c: c.astype(str))
        assert found.values.tolist() == expected.values.tolist()
        streaming.compact_expiring_view(spark, path, kind)


def test_compaction_beside_a_micro_batch_loses_no_visitor(spark, tmp_path):
    """The visitors of batch 1 are written, its keys not yet, when the view is compacted."""
    path, schema = str(tmp_path / "view"), "timestamp_hour long, action string, visitor string, product string"
    append_batch(spark.createDataFrame([(0, "x", "V1", "A")], schema), path, 0, "exact", 0)
    append_batch(spark.createDataFrame([(0, "x", "V2", "A"), (0, "x", "V3", "B")], schema), path, 1, "exact", 1)
    os.rename(f"{path}/view/changes/batch_id=1", f"{path}/later")
    streaming.compact_expiring_view(spark, path, "exact")
    assert as_set(live_view(spark, path, "exact", now_ms=1)) == [("A", 0, 2)]
    os.rename(f"{path}/later", f"{path}/view/changes/batch_id=1")
    streaming.compact_expiring_view(spark, path, "exact")
    assert as_set(live_view(spark, path, "exact", now_ms=1)) == [("A", 0, 2), ("B", 0, 1)]


def test_a_micro_batch_reads_no_state(spark, landed, tmp_path, monkeypatch):
    """Beyond the first micro-batch, what is written is planned without a scan of the table."""
    plans, path = [], str(tmp_path / "view")
    import twinview.streaming.expiry as expiry

    def write(changes, *args):
        plans.append(changes._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(expiry, "write_changes", write)
    for kind in KINDS:
        for n in range(2):
            append_batch(batch(spark, landed), path, n, kind, n)
    assert len(plans) == 10 and not any(path in p or "parquet" in p for p in plans)


def test_hot_key_and_hot_visitor_are_counted_whole(spark, land, tmp_path):
    """One key has almost all clicks and one visitor most of these, over several batches."""
    for n in range(3):
        folder = land(*(click(0, visitor=0 if i % 2 else n * 100 + i, product="HOT") for i in range(800)),
                      click(0, visitor=5, product="COLD"))
    expected = as_set(ops.visitors_by_product(batch(spark, folder)))
    view = streaming.exact_visitors_stream(stream(spark, folder))
    finish(streaming.upsert_view(view, str(tmp_path / "a"), trigger=NOW))
    assert as_set(streaming.latest_view(spark, str(tmp_path / "a"), view.schema)) == expected
    path = str(tmp_path / "b")
    finish(streaming.start_expiring_view(stream(spark, folder), path, "exact", trigger=NOW))
    assert as_set(live_view(spark, path, "exact", ttl_ms=None)) == expected
    streaming.compact_expiring_view(spark, path, "exact")
    assert as_set(live_view(spark, path, "exact")) == expected
    seen = read_changes(spark, f"{path}/seen", SEEN)
    assert seen.count() == seen.select(*VIEW_KEYS, "visitor").distinct().count()


def test_compaction_keeps_the_view_and_rewrites_changed_days_only(spark, tmp_path):
    path, schema = str(tmp_path / "view"), ACTIVITY_BY_PRODUCT

    def write(n, *rows):
        streaming.write_changes(spark.createDataFrame(rows, schema), path, n)

    write(0, ("A", 0, 1, 0, 0), ("B", DAY_MS, 1, 0, 0), (None, None, 7, 0, 0))
    assert streaming.compact_view(spark, path, schema) == 0
    assert streaming.compact_view(spark, path, schema) is None
    write(1, ("A", 0, 2, 0, 0))
    write(2, ("C", 0, 3, 0, 0))
    expected = {("A", 0, 2), ("B", DAY_MS, 1), ("C", 0, 3), (None, None, 7)}

    def view():
        return {tuple(r)[:3] for r in streaming.latest_view(spark, path, schema).collect()}

    assert view() == expected
    assert streaming.compact_view(spark, path, schema) == 2
    assert view() == expected
    streaming.drop_compacted(spark, path, schema)
    assert view() == expected
    files = read_changes(spark, path, schema).inputFiles()
    assert sorted(f.split("/base/")[1].rsplit("/", 1)[0] for f in files) == [
        "day=0/upto=2", "day=1/upto=0", "day=__HIVE_DEFAULT_PARTITION__/upto=0"]


def test_files_of_a_micro_batch_follow_its_size(spark, tmp_path):
    rows = spark.range(2000, numPartitions=64).select(
        F.col("id").cast("string").alias("product"), *(F.col("id").alias(c) for c in ACTIVITY_BY_PRODUCT.names[1:]))
    streaming.write_changes(rows.repartition(64, "product"), str(tmp_path / "v"), 0)
    assert len(glob.glob(f"{tmp_path}/v/changes/batch_id=0/*.parquet")) == 1


def test_sql_on_each_batch(spark, land, tmp_path):
    land(click(0, product="A"))
    folder = land(click(0, product="B"), click(1, product="B"))

    def per_product(rows):
        ops.register(rows, "activity_of_batch")
        return rows.sparkSession.sql("SELECT product, count(*) AS n FROM activity_of_batch GROUP BY product")

    finish(streaming.publish_view(
        stream(spark, folder), "batch_counts", str(tmp_path / "p"), per_product, trigger=NOW))
    assert as_set(spark.table("batch_counts")) == [("B", 2)]


def test_batches_without_a_good_line(spark, land, tmp_path):
    land("broken")
    land(click(0, product="A"))
    folder = land("broken", "broken too")
    view = streaming.activity_view_stream(stream(spark, folder))
    finish(streaming.upsert_view(view, str(tmp_path / "a"), trigger=NOW))
    assert as_set(streaming.latest_view(spark, str(tmp_path / "a"), view.schema)) == [("A", 0, 0, 0, 1)]
    for kind in KINDS:
        path = str(tmp_path / kind)
        finish(streaming.start_expiring_view(stream(spark, folder), path, kind, trigger=NOW))
        assert live_view(spark, path, kind).count() == 1
        streaming.compact_expiring_view(spark, path, kind)
        assert live_view(spark, path, kind).count() == 1
    finish(streaming.publish_view(
        stream(spark, folder), "empty_batch", str(tmp_path / "p"), ops.activity_by_product, trigger=NOW))
    assert spark.table("empty_batch").count() == 0


def test_half_written_batches_are_not_read(spark, tmp_path):
    path, schema = str(tmp_path / "view"), DELTAS["clicks"]
    streaming.write_changes(spark.createDataFrame([("A", 0, 1, 0, 0)], schema), path, 0)
    streaming.write_changes(spark.createDataFrame([("A", 0, 2, 0, 0)], schema), path, 1)
    os.remove(f"{path}/changes/batch_id=1/_SUCCESS")
    assert as_set(streaming.latest_view(spark, path, schema)) == [("A", 0, 1, 0, 0)]
    assert streaming.latest_view(spark, str(tmp_path / "nothing"), schema).count() == 0


def test_published_table_is_the_newest_batch(spark, land, tmp_path):
    folder = land(click(0, product="A"))
    folder = land(click(0, product="B"), click(1, "purchase", product="B"))

    finish(streaming.publish_view(
        stream(spark, folder, bucket_ms=MINUTE_MS), "newest_activity", str(tmp_path / "p"),
        transform=ops.activity_by_product, trigger=NOW, cache=True))
    assert as_set(spark.table("newest_activity")) == [("B", 0, 1, 0, 1)]
    assert as_set(ops.labelled_buckets(spark.table("newest_activity"), zone="UTC")) == [("01-01 00:00:00", 1, 0, 1)]


def test_published_table_of_all_live_keys(spark, landed, tmp_path):
    view = streaming.visitor_view_stream(stream(spark, landed))
    finish(streaming.publish_view(
        view, "all_visitors", str(tmp_path / "p"), keys=VIEW_KEYS, trigger=NOW))
    assert as_set(spark.sql("SELECT * FROM all_visitors")) == as_set(ops.visitors_by_product(batch(spark, landed)))


@pytest.mark.parametrize("replayed", [False, True])
def test_pipeline_feeds_master_and_both_views(spark, landed, tmp_path, replayed):
    master, views = str(tmp_path / "master"), str(tmp_path / "views")

    def run():
        lines = sources.read_click_stream(spark, path=landed, max_files_per_trigger=1)
        query = start_pipeline(ops.with_file_props(lines, "clicks"), master, views, trigger=NOW)
        finish(query)
        return sum(p["numInputRows"] for p in query.recentProgress)

    assert run() == sources.read_click_lines(spark, landed).count()  # once for the three writers
    if replayed:
        forget_last_commit(f"{views}/_checkpoint")
        run()
    clicks = batch(spark, landed)
    columns = ["timestamp_hour", "action", "visitor", "product"]
    stored = sources.read_master(spark, master)
    assert as_set(stored, *columns) == as_set(clicks, *columns)
    assert as_set(sources.read_master(spark, master, since_ms=HOUR_MS), *columns) == as_set(
        ops.recent(clicks, 0, as_of=3600), *columns)
    assert sources.starting_offsets_json(stored) is None
    assert as_set(live_view(spark, f"{views}/{ACTIVITY_VIEW}")) == as_set(ops.activity_by_product(clicks))
    assert as_set(live_view(spark, f"{views}/{VISITORS_VIEW}", "visitors")) == as_set(ops.visitors_by_product(clicks))


def test_batch_and_stream_append_to_one_master(spark, landed, tmp_path):
    master, clicks = str(tmp_path / "master"), batch(spark, landed)
    flat = ops.flatten_props(clicks.withColumn("inputProps", F.create_map(F.lit("topic"), F.lit("t"), F.lit("kafkaPartition"), F.lit("3"))))
    n = clicks.count()
    sinks.append_master(flat, master)
    lines = ops.with_file_props(sources.read_click_stream(spark, path=landed, max_files_per_trigger=1), "clicks")
    streamed = ops.flatten_props(ops.parse_activity(lines))
    finish(streaming.append_master_stream(streamed, master, trigger=NOW))
    assert sources.read_master(spark, master).count() == 2 * n
    forget_last_commit(f"{master}_checkpoint")
    finish(streaming.append_master_stream(streamed, master, trigger=NOW))
    for _ in range(2):
        sinks.append_master(flat, master, "again")
    assert sources.read_master(spark, master).count() == 3 * n
    some = sources.read_master(spark, master, since_ms=HOUR_MS)
    assert all(int(f.split("timestamp_hour=")[1].split("/")[0]) >= HOUR_MS for f in some.inputFiles())


def test_query_stops_when_idle(spark, landed, tmp_path):
    view = streaming.activity_view_stream(stream(spark, landed))
    query = streaming.upsert_view(view, str(tmp_path / "v"), trigger={"processingTime": "100 milliseconds"})
    assert not streaming.await_for(query, 0.1)
    query.processAllAvailable()
    assert streaming.stop_when_idle(query, LIMIT)
    assert not query.isActive
    assert as_set(streaming.latest_view(spark, str(tmp_path / "v"), view.schema)) == as_set(
        ops.activity_by_product(batch(spark, landed)))
