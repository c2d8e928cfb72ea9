import random

import pytest
from pyspark.errors import PySparkException

from tests.conftest import as_set, click
from twinview import operators as ops
from twinview.functions import HOUR_MS, MINUTE_MS, bucket, bucket_label
from twinview.schema import ACTIVITY, LINE_FIELDS


def lines_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def products(spark, *values, **options):
    return [r.product for r in ops.parse_activity(lines_of(spark, *values), **options).collect()]


def test_fields_and_layout(spark):
    line = click(2 * HOUR_MS + 5, "purchase", 9, 'Acme,"Soap, blue"', "Internal", "Page - 3", 4)
    parsed = ops.parse_activity(lines_of(spark, line))
    assert parsed.dtypes == [(f.name, f.dataType.simpleString()) for f in ACTIVITY]
    assert parsed.first().asDict() == {
        "timestamp_hour": 2 * HOUR_MS, "referrer": "Internal", "action": "purchase",
        "prevPage": "Page - 3", "visitor": "Visitor - 9", "page": "Page - 4",
        "product": 'Acme,"Soap, blue"', "inputProps": {},
    }


def test_wrong_field_counts_are_dropped(spark):
    good = click()
    assert products(
        spark, good, good + "\t" + good, "\t".join(good.split("\t")[:-1]), "", "\t\t\t\t\t\t", None,
    ) == ["Acme,Soap"]


def test_empty_product_is_dropped_and_empty_inner_fields_are_kept(spark):
    assert products(spark, click(product="")) == []
    assert products(spark, "1\t\t\t\t\t\tSoap") == ["Soap"]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r", "\t", "\t\n", ""])
def test_line_ends_and_trailing_tabs_do_not_count(spark, end):
    assert products(spark, click() + end) == ["Acme,Soap"]


@pytest.mark.parametrize("ts", ["x1", "", "1.5", " 1", "9" * 30, "1e3"])
def test_bad_timestamps(spark, ts):
    assert products(spark, click(ts), click(7)) == ["Acme,Soap"]
    with pytest.raises(PySparkException, match="not an epoch-ms timestamp"):
        products(spark, click(ts), on_bad_ts="fail")


def test_rejects_are_the_complement(spark):
    values = [click(), click("x"), click(product=""), "a\tb", None]
    rejects = ops.malformed_lines(lines_of(spark, *values))
    assert {(r.value, r.reason) for r in rejects.collect()} == {
        (values[1], "bad_timestamp"), (values[2], "field_count"), (values[3], "field_count"),
        (None, "field_count"),
    }


def test_encode_is_the_inverse_on_random_records(spark):
    rng, alphabet = random.Random(5), 'aé"\',; 漢-\\%'

    def text(least):
        return "".join(rng.choices(alphabet, k=rng.randint(least, 9)))

    records = [
        (rng.randint(0, 10**13), *(text(0) for _ in range(5)), text(1) + "z") for _ in range(500)
    ]
    df = spark.createDataFrame(records, "ts_ms long, " + ", ".join(f"{c} string" for c in LINE_FIELDS[1:]))
    parsed = ops.parse_activity(ops.encode_activity(df), bucket_ms=1)
    assert as_set(parsed, "timestamp_hour", *LINE_FIELDS[1:]) == sorted(records)


def test_buckets_truncate_toward_zero(spark):
    df = spark.createDataFrame([(-1,), (0,), (59_999,), (60_000,), (-60_001,)], "ms long")
    assert [r[0] for r in df.select(bucket("ms", MINUTE_MS)).collect()] == [0, 0, 0, 60_000, -60_000]


def test_labels_in_session_or_given_zone(spark):
    df = spark.createDataFrame([(1_551_437_112_669,)], "ms long")
    row = df.select(
        bucket_label("ms"), bucket_label("ms", "HH:mm:00", "UTC"),
        bucket_label("ms", zone="Europe/Warsaw"),
    ).first()
    assert tuple(row) == ("03-01 10:45:00", "10:45:00", "03-01 11:45:00")


def test_line_is_split_once(spark):
    plan = ops.parse_activity(lines_of(spark, click()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_file_and_record_props(spark, land):
    folder = land(click(), click(1))
    props = ops.parse_activity(ops.with_file_props(spark.read.text(folder), "clicks"))
    first = props.select("inputProps").first()[0]
    assert first["topic"] == "clicks" and first["kafkaPartition"] == "0"
    assert first["fromOffset"] is None and first["untilOffset"] is None  # nothing to resume at


@pytest.mark.parametrize("known", [False, True])
def test_offset_ranges_found_or_given(spark, known):
    rows = [(click(i), "t", i % 2, 10 + i) for i in range(40)]
    lines = spark.createDataFrame(rows, "value string, topic string, partition int, offset long")
    ranges = spark.createDataFrame(
        [("t", 0, 10, 49), ("t", 1, 11, 50)], "topic string, partition int, fromOffset long, untilOffset long")
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    result = ops.with_source_props(lines, ranges if known else None, salts=4)
    assert len(jobs.getJobIdsForGroup(None)) == before  # nothing runs while it is planned
    flat = ops.flatten_props(ops.parse_activity(result))
    assert flat.count() == 40
    assert as_set(flat.select("kafkaPartition", "fromOffset", "untilOffset").distinct()) == [
        ("0", "10", "49"), ("1", "11", "50"),
    ]
    assert set(result.drop("inputProps").columns) == {"topic", "partition", "value", "offset"}


def test_timestamp_is_judged_once(spark):
    plan = ops.parse_activity(lines_of(spark, click()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RLIKE") == 1
