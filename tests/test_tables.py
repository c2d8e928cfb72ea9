import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import as_set, click
from twinview import operators as ops
from twinview import sinks, sources
from twinview.functions import HOUR_MS
from twinview.plans import run_batch_views
from twinview.schema import ACTIVITY_BY_PRODUCT, MASTER, VISITORS_BY_PRODUCT

VIEW = "product string, timestamp_hour long, purchase_count long, add_to_cart_count long, page_view_count long"


def kafka_like(spark, count, start=0):
    rows = [
        (click(i * HOUR_MS // 4, visitor=i % 7, product=f"P{i % 3}"), "clicks", i % 2, start + i // 2)
        for i in range(count)
    ]
    return spark.createDataFrame(rows, "value string, topic string, partition int, offset long")


def flat(spark, count, start=0):
    return ops.flatten_props(ops.parse_activity(ops.with_record_props(kafka_like(spark, count, start))))


@pytest.fixture
def master(spark, tmp_path):
    path = str(tmp_path / "master")
    sinks.append_master(flat(spark, 40), path)
    return path


def test_master_layout_and_append(spark, master):
    stored = sources.read_master(spark, master)
    assert stored.schema == MASTER and stored.count() == 40
    sinks.append_master(flat(spark, 4, start=100), master)
    assert sources.read_master(spark, master).count() == 44


def test_missing_and_empty_master(spark, tmp_path):
    path = str(tmp_path / "none")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sources.read_master(spark, path)
    for since in (None, 0):
        empty = sources.read_master(spark, path, missing_ok=True, since_ms=since)
        assert empty.schema == MASTER and empty.count() == 0
    (tmp_path / "none").mkdir()
    assert sources.read_master(spark, path).count() == 0
    assert sources.starting_offsets_json(sources.read_master(spark, path)) is None


def test_other_read_errors_are_not_hidden(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="not a Parquet file"):
        sources.read_master(spark, str(tmp_path / "bad"), missing_ok=True).count()


def test_recent_buckets_only_are_listed(spark, master):
    whole = sources.read_master(spark, master)
    for since in (0, 5 * HOUR_MS, 99 * HOUR_MS):
        some = sources.read_master(spark, master, since_ms=since)
        expected = whole.where(F.col("timestamp_hour") >= since)
        assert as_set(some) == as_set(expected)
    some = sources.read_master(spark, master, since_ms=5 * HOUR_MS)
    assert all(int(f.split("timestamp_hour=")[1].split("/")[0]) >= 5 * HOUR_MS for f in some.inputFiles())


def test_recency_is_a_partition_filter_and_few_columns_are_read(spark, master):
    recent = ops.activity_by_product(ops.recent(sources.read_master(spark, master), 6, as_of=30 * 3600))
    text = recent._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.split("\n") if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(timestamp_hour" in scan
    assert "ReadSchema: struct<action:string,product:string>" in scan


def test_offsets_compare_as_numbers_and_resume_at_the_next(spark, tmp_path):
    path = str(tmp_path / "master")
    sinks.append_master(flat(spark, 20, start=95), path)  # offsets 95 to 104: '99' > '105' as text
    stored = sources.read_master(spark, path)
    assert as_set(sources.latest_offsets(stored)) == [("clicks", 0, 105), ("clicks", 1, 105)]
    assert json.loads(sources.starting_offsets_json(stored)) == {"clicks": {"0": 105, "1": 105}}
    assert json.loads(sources.starting_offsets_json(stored, {"clicks": 3, "new": 1})) == {
        "clicks": {"0": 105, "1": 105, "2": -2}, "new": {"0": -2}}


def test_kafka_options():
    assert sources.kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest"}
    options = sources.kafka_options("h:1", "t", '{"t":{"0":5}}', 64, 1000)
    assert options["startingOffsets"] == '{"t":{"0":5}}'
    assert options["minPartitions"] == "64" and options["maxOffsetsPerTrigger"] == "1000"


def test_other_kafka_options_are_passed_on():
    options = sources.kafka_options("h:1", "t", options={"kafka.group.id": "g", "failOnDataLoss": "false"})
    assert options["kafka.group.id"] == "g" and options["subscribe"] == "t"
    sink = sinks.lines.kafka_sink_options("h:1", "t", {"kafka.client.id": "c", "kafka.acks": "1"})
    assert sink == {"kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "1", "kafka.client.id": "c"}


def test_a_file_sinks_log_is_refused(spark, tmp_path):
    (tmp_path / "m" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="log of a file sink"):
        sinks.append_master(flat(spark, 1), str(tmp_path / "m"))


def test_a_null_bucket_is_never_recent(spark, master):
    null_bucket = flat(spark, 2).withColumn("timestamp_hour", F.lit(None).cast("long"))
    sinks.append_master(null_bucket, master)
    assert sources.read_master(spark, master).count() == 42
    assert sources.read_master(spark, master, since_ms=0).count() == 40
    nothing = sources.read_master(spark, master, since_ms=10**15)
    assert nothing.count() == 0 and not nothing.inputFiles()


def test_recency_may_end(spark, master):
    stored = sources.read_master(spark, master)
    until = ops.recent(stored, 6, as_of=8 * 3600, until=5 * 3600)
    assert {r[0] // HOUR_MS for r in until.select("timestamp_hour").collect()} == {2, 3, 4}


def test_unknown_formats_are_refused(spark):
    with pytest.raises(ValueError):
        sources.read_click_stream(spark, fmt="carrier pigeon")
    with pytest.raises(ValueError):
        sinks.write_lines(spark.range(1).withColumn("value", F.lit("x")), fmt="carrier pigeon")


def test_product_and_referrer_files(spark, tmp_path):
    (tmp_path / "products").write_text('Acme,Soap\nAcme,"Soap, blue"\nAcme,Soap\nBär,Öl ""x""\n')
    (tmp_path / "referrers").write_text("Google\nInternal")
    products = sources.read_products(spark, str(tmp_path / "products"))
    assert [tuple(r) for r in products.collect()] == [
        ("Acme,Soap", "Acme", "Soap"), ('Acme,"Soap, blue"', "Acme", "Soap, blue"),
        ("Acme,Soap", "Acme", "Soap"), ('Bär,Öl ""x""', "Bär", 'Öl ""x""'),
    ]
    referrers = sources.read_referrers(spark, str(tmp_path / "referrers"))
    assert [r.referrer for r in referrers.collect()] == ["Google", "Internal"]


def test_lines_written_are_read_back(spark, tmp_path):
    path = str(tmp_path / "lines")
    sinks.write_lines(kafka_like(spark, 5), path=path)
    sinks.write_lines(kafka_like(spark, 5), path=path)
    assert sources.read_click_lines(spark, path).count() == 10


def test_saved_view_replaces_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "view")
    first = [("a", 0, 1, 1, 1), ("b", 0, 1, 1, 1), ("a", HOUR_MS, 1, 1, 1)]
    sinks.save_batch_view(spark.createDataFrame(first, VIEW), path, "strict")
    with pytest.raises(AnalysisException):
        sinks.save_batch_view(spark.createDataFrame(first, VIEW), path, "strict")
    sinks.save_batch_view(spark.createDataFrame([("a", 0, 5, 5, 5)], VIEW), path)
    assert as_set(sources.read_view(spark, path, ACTIVITY_BY_PRODUCT)) == [
        ("a", 0, 5, 5, 5), ("a", HOUR_MS, 1, 1, 1)]
    hot = sources.query_path(spark, path, "page_view_count > 2")
    assert "PushedFilters: [IsNotNull(page_view_count), GreaterThan(page_view_count,2)]" in (
        hot._jdf.queryExecution().executedPlan().toString())
    assert hot.count() == 1 and sources.query_path(spark, path).count() == 2


def test_batch_job_can_run_again(spark, master, tmp_path):
    out, stored = str(tmp_path / "out"), sources.read_master(spark, master)
    recent = ops.recent(stored, 6, as_of=10 * 3600)
    for _ in range(2):
        activity, visitors = run_batch_views(spark, master, out, 6, as_of=10 * 3600)
        assert as_set(sources.read_view(spark, activity, ACTIVITY_BY_PRODUCT)) == as_set(
            ops.activity_by_product(recent))
        assert as_set(sources.read_view(spark, visitors, VISITORS_BY_PRODUCT)) == as_set(
            ops.visitors_by_product(recent))
    with pytest.raises(AnalysisException):
        run_batch_views(spark, master, out, 6, as_of=10 * 3600, mode="strict")
