"""The registered queries: every operator on the whole ``events`` table, with SQL to check it.

The clicks are made from ``events`` row by row (``events_to_activity``). Streaming queries first
land them as text lines, as a click producer would, and follow that folder in a few micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinview import operators as ops
from twinview import sinks, sources, streaming
from twinview.functions import DAY_MS, HOUR_MS, MINUTE_MS, tab_line
from twinview.operators.views import estimate_visitors
from twinview.plans import run_batch_views, start_pipeline
from twinview.plans.speed import ACTIVITY_VIEW, VISITORS_VIEW
from twinview.schema import ACTIVITY, ACTIVITY_BY_PRODUCT, VISITORS_BY_PRODUCT
from twinview.session import new_table_dir
from twinview.streaming.expiry import TTL_MS
from twinview.streaming.windows import WINDOW_MS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOPIC = "clicks"
KAFKA_PARTITIONS = 2
AS_OF = 1_706_616_000  # 2024-01-30 12:00:00 UTC
THREE_PRODUCTS = ("Product - 7", "Product - 42", "Product - 99")
NOW = {"availableNow": True}
MICRO_BATCHES = 3
FILES = 8  # of a micro-batch
RECORD = [f.name for f in ACTIVITY if f.name != "inputProps"]


def _query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = CLICKS_SQL + oracle
        return function

    return add


# Clicks in SQL, as events_to_activity makes them.
CLICKS_SQL = f"""
WITH clicks AS (
  SELECT event_id, ts_ms, referrer, action, visitor, page, product, event_type, ts,
         ts_ms // {HOUR_MS} * {HOUR_MS} AS timestamp_hour,
         ts_ms // {MINUTE_MS} * {MINUTE_MS} AS timestamp_minute,
         ts_ms // {DAY_MS} * {DAY_MS} AS timestamp_day,
         CASE WHEN referrer = 'Internal' THEN 'Page - ' || ((event_id + 1) % {sources.events.PAGES})
              ELSE '' END AS "prevPage",
         event_id % {KAFKA_PARTITIONS} AS kafka_partition
  FROM (
    SELECT event_id, event_type, ts, epoch_us(ts) // 1000 AS ts_ms,
           list_extract({list(sources.events.REFERRERS)}, (event_id % 8 + 1)::INT) AS referrer,
           CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'add_to_cart'
                           WHEN 'view' THEN 'page_view' ELSE event_type END AS action,
           'Visitor - ' || user_id AS visitor,
           'Page - ' || (event_id % {sources.events.PAGES}) AS page,
           'Product - ' || regexp_extract(props, '"k": *([0-9]+)', 1) AS product
    FROM events
  )
)
"""

COUNTS_SQL = """
  count(*) FILTER (action = 'purchase') AS purchase_count,
  count(*) FILTER (action = 'add_to_cart') AS add_to_cart_count,
  count(*) FILTER (action = 'page_view') AS page_view_count"""


def _view_sql(bucket: str = "timestamp_hour") -> str:
    return f"SELECT product, {bucket} AS timestamp_hour,{COUNTS_SQL} FROM clicks GROUP BY ALL"


def _visitors_sql(keys: str = "product, timestamp_hour", where: str = "true") -> str:
    return (
        f"SELECT {keys}, count(DISTINCT visitor) AS unique_visitors FROM clicks"
        f" WHERE {where} GROUP BY ALL"
    )


RECORD_SQL = (
    'SELECT timestamp_hour, referrer, action, "prevPage", visitor, page, product FROM clicks'
)


def _activity(spark: SparkSession, sf_dir: str, bucket_ms: int = HOUR_MS) -> DataFrame:
    return sources.events_to_activity(sources.read_events(spark, sf_dir), bucket_ms)


# Records and lines


@_query(RECORD_SQL)
def activity_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(spark, sf_dir).select(*RECORD)


LINE_SQL = r"""concat_ws(chr(9), ts_ms, referrer, action, "prevPage", visitor, page, product)"""


@_query(f"SELECT {LINE_SQL} AS value FROM clicks")
def encoded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.encode_activity(_activity(spark, sf_dir))


def _dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each click's line with a line end, and for most kinds of events a damaged copy of it."""
    clicks = _activity(spark, sf_dir)
    whole = tab_line(*(F.col(c) for c in ("ts_ms", *RECORD[1:])))
    without_product = tab_line(*(F.col(c) for c in ("ts_ms", *RECORD[1:-1])), F.lit(""))
    copy = (
        F.when(F.col("action") == "error", F.concat(whole, F.lit("\t"), whole))  # glued lines
        .when(F.col("action") == "signup", without_product)
        .when(F.col("action") == "purchase", F.concat(F.lit("x"), whole))
    )
    lines = F.array(F.concat(whole, F.lit("\r\n")), copy)
    return clicks.select(F.explode(lines).alias("value")).where(F.col("value").isNotNull())


@_query(RECORD_SQL)
def parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.parse_activity(_dirty_lines(spark, sf_dir)).select(*RECORD)


@_query(f"""
SELECT value, reason FROM (
  SELECT CASE action
           WHEN 'error' THEN {LINE_SQL} || chr(9) || {LINE_SQL}
           WHEN 'signup' THEN
             concat_ws(chr(9), ts_ms, referrer, action, "prevPage", visitor, page, '')
           WHEN 'purchase' THEN 'x' || {LINE_SQL} END AS value,
         CASE WHEN action = 'purchase' THEN 'bad_timestamp' ELSE 'field_count' END AS reason
  FROM clicks)
WHERE value IS NOT NULL""")
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.malformed_lines(_dirty_lines(spark, sf_dir))


@_query(r"""
SELECT p_brand || ',"' || p_name || ', ' || p_type || '"' AS product, p_brand AS brand,
       p_name || ', ' || p_type AS name
FROM part""")
def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_dir(spark, "products")
    line = F.concat("p_brand", F.lit(',"'), "p_name", F.lit(", "), "p_type", F.lit('"'))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    sinks.write_lines(parts.select(line.alias("value")), path=path)
    return sources.read_products(spark, path)


@_query("""
SELECT event_id, upper(referrer) AS referrer_upper, length(product)::INT AS name_length,
       octet_length(encode(visitor))::INT AS visitor_bytes
FROM clicks""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(spark, sf_dir).select(
        "event_id",
        F.upper("referrer").alias("referrer_upper"),
        F.length("product").alias("name_length"),
        F.octet_length(F.encode("visitor", "UTF-8")).alias("visitor_bytes"),
    )


# Batch views


@_query(_view_sql())
def activity_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.activity_by_product(_activity(spark, sf_dir))


@_query(_view_sql("timestamp_minute"))
def activity_by_product_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.activity_by_product(_activity(spark, sf_dir, MINUTE_MS))


@_query(_visitors_sql())
def visitors_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.visitors_by_product(_activity(spark, sf_dir))


@_query(_visitors_sql("product"))
def visitors_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops.register(_activity(spark, sf_dir), "activity")
    return spark.sql(
        "SELECT product, count(DISTINCT visitor) AS unique_visitors FROM activity GROUP BY ALL")


@_query(_visitors_sql("product"))
def visitors_of_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.visitors_by_product(_activity(spark, sf_dir), keys=["product"])


@_query(f"""
SELECT product, timestamp_hour,{COUNTS_SQL}, count(DISTINCT visitor) AS unique_visitors
FROM clicks GROUP BY ALL""")
def product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.product_summary(_activity(spark, sf_dir))


@_query(_visitors_sql())
def approx_visitors_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.approx_visitors_by_product(_activity(spark, sf_dir))


def _close_sql(*estimates: str) -> str:
    close = "".join(f", true AS {name}_is_close" for name in estimates)
    return f"SELECT product, count(DISTINCT visitor) AS unique_visitors{close} FROM clicks GROUP BY product"


def _is_close(estimate: str) -> Column:
    """Within 5 % of the exact number, three standard errors of 2^12 registers."""
    exact = F.col("unique_visitors")
    return (F.abs(F.col(estimate) - exact) <= F.greatest(F.lit(1), exact * 0.05)).alias(f"{estimate}_is_close")


def _beside_exact(spark: SparkSession, sf_dir: str, view: DataFrame) -> DataFrame:
    """Estimates per product next to the exact numbers."""
    exact = ops.visitors_by_product(_activity(spark, sf_dir), ["product"])
    joined = exact.join(view.select("product", F.col("unique_visitors").alias("sketch")), "product", "full")
    return joined.select("product", "unique_visitors", _is_close("sketch"))


@_query(_close_sql("sketch"))
def merged_sketch_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = ops.visitor_sketches(_activity(spark, sf_dir))
    return _beside_exact(spark, sf_dir, estimate_visitors(ops.merge_sketches(hourly, ["product"])))


@_query(_close_sql("sketch"))
def approx_count_distinct_oneshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _beside_exact(spark, sf_dir, ops.approx_visitors_oneshot(_activity(spark, sf_dir), keys=["product"]))


@_query(_close_sql("sketched", "oneshot"))
def approx_visitors_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both estimates and the exact number out of one pass."""
    summary = ops.visitors_summary(_activity(spark, sf_dir), ["product"])
    return summary.select("product", "unique_visitors", _is_close("sketched"), _is_close("oneshot"))


@_query(f"""
SELECT *, CASE WHEN purchase_count = 0 THEN 0
               ELSE page_view_count // purchase_count END AS under_exposed
FROM (SELECT product, timestamp_day AS timestamp_hour,{COUNTS_SQL} FROM clicks GROUP BY ALL)""")
def under_exposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.under_exposed(ops.activity_by_product(_activity(spark, sf_dir, DAY_MS)))


@_query(f"{RECORD_SQL} WHERE timestamp_hour >= {(AS_OF - 6 * 3600) * 1000}")
def recent_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.recent(_activity(spark, sf_dir), hours=6, as_of=AS_OF).select(*RECORD)


@_query(f"""{RECORD_SQL}
WHERE timestamp_hour >= {(AS_OF - 48 * 3600) * 1000} AND timestamp_hour < {AS_OF * 1000}""")
def recent_activity_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.recent(_activity(spark, sf_dir), hours=48, as_of=AS_OF, until=AS_OF).select(*RECORD)


A_CENTURY = 24 * 36_525  # hours


@_query(f"{RECORD_SQL} WHERE timestamp_hour >= (epoch(now())::BIGINT - {A_CENTURY * 3600}) * 1000")
def recent_activity_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured from the time the query runs at."""
    return ops.recent(_activity(spark, sf_dir), hours=A_CENTURY).select(*RECORD)


# Reports


@_query(_visitors_sql("product"))
def cached_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a cached SQL table; what the result needs of it is stored before the cache goes."""
    name, path = "cached_activity", new_table_dir(spark, "cached")
    ops.register(_activity(spark, sf_dir).select("product", "visitor"), name, cache=True)
    try:
        found = spark.sql(f"SELECT product, count(DISTINCT visitor) AS unique_visitors FROM {name} GROUP BY ALL")
        found.write.parquet(path)
    finally:
        spark.catalog.uncacheTable(name)
    return spark.read.schema(found.schema).parquet(path)


@_query(f"SELECT * FROM ({_view_sql('timestamp_day')}) WHERE page_view_count > 2")
def hot_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_dir(spark, "view")
    sinks.save_batch_view(ops.activity_by_product(_activity(spark, sf_dir, DAY_MS)), path)
    return sources.query_path(spark, path, "page_view_count > 2").select(*ACTIVITY_BY_PRODUCT.names)


@_query(f"""
SELECT * FROM ({_view_sql('timestamp_day')}) WHERE page_view_count > 2
ORDER BY timestamp_hour, product LIMIT 20""")
def hot_products_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = ops.activity_by_product(_activity(spark, sf_dir, DAY_MS))
    hot = view.where(F.col("page_view_count") > 2)
    return ops.preview(hot, order_by=["timestamp_hour", "product"])


@_query("""
SELECT length(product)::INT AS len, count(*) FILTER (action = 'page_view') AS page_views
FROM clicks GROUP BY ALL""")
def views_by_name_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.views_by_name_length(ops.activity_by_product(_activity(spark, sf_dir)))


@_query(f"""
SELECT strftime(make_timestamp(timestamp_hour * 1000), '%m-%d %H:%M:00') AS timestamphour,
       purchase_count, add_to_cart_count, page_view_count
FROM ({_view_sql('timestamp_minute')})""")
def labelled_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = ops.activity_by_product(_activity(spark, sf_dir, MINUTE_MS))
    return ops.labelled_buckets(view, zone="UTC")


def _compare_sql(where: str) -> str:
    label = "strftime(make_timestamp(timestamp_hour * 1000), '%H:%M:00') AS timestamphour"
    visitors = _visitors_sql(where=where)
    return f"""
SELECT {label}, product, unique_visitors AS unique_visitors_hll, 0::BIGINT AS unique_visitors_precise
FROM ({visitors})
UNION ALL
SELECT {label}, product, 0::BIGINT, unique_visitors FROM ({visitors})"""


@_query(_compare_sql("true"))
def compare_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.compare_visitors(ops.visitors_summary(_activity(spark, sf_dir)), zone="UTC")


@_query(_compare_sql(f"product IN {THREE_PRODUCTS}"))
def compare_visitors_of_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.compare_visitors(ops.visitors_summary(_activity(spark, sf_dir)), THREE_PRODUCTS, zone="UTC")


# Master dataset


def _kafka_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click lines with the columns of the Kafka source: the event id is the offset."""
    clicks = _activity(spark, sf_dir)
    line = tab_line(*(F.col(c) for c in ("ts_ms", *RECORD[1:])))
    return clicks.select(
        line.alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % KAFKA_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def _write_master(spark: SparkSession, sf_dir: str, bucket_ms: int) -> str:
    path = new_table_dir(spark, "master")
    lines = ops.with_record_props(_kafka_lines(spark, sf_dir))
    sinks.append_master(ops.flatten_props(ops.parse_activity(lines, bucket_ms)), path)
    return path


def _flat_sql(bucket: str) -> str:
    return f"""
SELECT {bucket} AS timestamp_hour, referrer, action, "prevPage", page, visitor, product,
       '{TOPIC}' AS topic"""



@_query(f"""
{_flat_sql("timestamp_hour")}, kafka_partition::VARCHAR AS "kafkaPartition",
  (min(event_id) OVER (PARTITION BY kafka_partition))::VARCHAR AS "fromOffset",
  (max(event_id) OVER (PARTITION BY kafka_partition) + 1)::VARCHAR AS "untilOffset"
FROM clicks""")
def source_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ops.with_source_props(_kafka_lines(spark, sf_dir))
    return ops.flatten_props(ops.parse_activity(lines))


@_query(f"""
{_flat_sql("timestamp_day")}, kafka_partition::INT AS "kafkaPartition", event_id::VARCHAR AS "fromOffset",
  (event_id + 1)::VARCHAR AS "untilOffset"
FROM clicks""")
def master_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_master(spark, _write_master(spark, sf_dir, DAY_MS))


@_query(f"""
SELECT '{TOPIC}' AS topic, kafka_partition::INT AS "kafkaPartition",
       max(event_id) + 1 AS "untilOffset"
FROM clicks GROUP BY ALL""")
def latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = sources.read_master(spark, _write_master(spark, sf_dir, DAY_MS))
    return sources.latest_offsets(master)


@_query(f"""
{_flat_sql("timestamp_day")}, kafka_partition::INT AS "kafkaPartition", event_id::VARCHAR AS "fromOffset",
  (event_id + 1)::VARCHAR AS "untilOffset"
FROM clicks""")
def master_of_both_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events appended in batch, twice under one name, even ones streamed to the same path."""
    path = new_table_dir(spark, "master")
    lines = ops.with_record_props(_kafka_lines(spark, sf_dir))
    odd, even = (lines.where(F.col("offset") % 2 == n) for n in (1, 0))
    for _ in range(2):
        sinks.append_master(ops.flatten_props(ops.parse_activity(odd, DAY_MS)), path, "odd")
    streamed = ops.flatten_props(ops.parse_activity(_as_stream(spark, even), DAY_MS))
    streaming.append_master_stream(streamed, path, trigger=NOW).awaitTermination()
    return sources.read_master(spark, path)


MASTER_SQL = f"""
{_flat_sql("timestamp_day")}, kafka_partition::INT AS "kafkaPartition", event_id::VARCHAR AS "fromOffset",
  (event_id + 1)::VARCHAR AS "untilOffset"
FROM clicks"""


def _merged_master(spark: SparkSession, sf_dir: str) -> str:
    """As ``master_of_both_sides``, but merged twice: between the stream's first and second run, after
    which the batch job runs again, and in the end, after which what was merged is deleted."""
    path, landing, checkpoint = (new_table_dir(spark, name) for name in ("master", "landing", "checkpoint"))
    lines = ops.with_record_props(_kafka_lines(spark, sf_dir))
    odd, even = (lines.where(F.col("offset") % 2 == n) for n in (1, 0))

    def append_odd() -> None:
        sinks.append_master(ops.flatten_props(ops.parse_activity(odd, DAY_MS)), path, "odd")

    def stream_part(part: int) -> None:
        even.where(F.col("offset") % 4 == 2 * part).repartition(MICRO_BATCHES * FILES).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(even.schema).option("maxFilesPerTrigger", FILES).parquet(landing)
        flat = ops.flatten_props(ops.parse_activity(stream, DAY_MS))
        streaming.append_master_stream(flat, path, checkpoint, trigger=NOW).awaitTermination()

    append_odd()
    stream_part(0)
    sinks.compact_master(spark, path, before_ms=AS_OF * 1000)
    append_odd()
    stream_part(1)
    sinks.compact_master(spark, path, before_ms=AS_OF * 1000)
    sinks.vacuum_master(spark, path, keep_ms=0)
    return path


@_query(MASTER_SQL)
def master_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_master(spark, _merged_master(spark, sf_dir))


@_query(f"""
SELECT '{TOPIC}' AS topic, kafka_partition::INT AS "kafkaPartition", max(event_id) + 1 AS "untilOffset"
FROM clicks GROUP BY ALL""")
def latest_offsets_noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the notes of streams and merges, and a scan of the few folders without one."""
    return sources.latest_offsets_of(spark, _merged_master(spark, sf_dir))


@_query(MASTER_SQL)
def master_or_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset that isn't there yet reads as no rows."""
    nothing = sources.read_master(spark, new_table_dir(spark, "absent"), missing_ok=True)
    return nothing.unionByName(sources.read_master(spark, _write_master(spark, sf_dir, DAY_MS), missing_ok=True))


BATCH_JOB_SQL = f"""
SELECT product, timestamp_day AS timestamp_hour, {{columns}} FROM clicks
WHERE timestamp_day >= {(AS_OF - 72 * 3600) * 1000} GROUP BY ALL"""


def _batch_job(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    master = _write_master(spark, sf_dir, DAY_MS)
    return run_batch_views(spark, master, new_table_dir(spark, "batch"), hours=72, as_of=AS_OF)


@_query(BATCH_JOB_SQL.format(columns=COUNTS_SQL))
def batch_job_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _batch_job(spark, sf_dir)
    return sources.read_view(spark, path, ACTIVITY_BY_PRODUCT)


@_query(BATCH_JOB_SQL.format(columns="count(DISTINCT visitor) AS unique_visitors"))
def batch_job_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, path = _batch_job(spark, sf_dir)
    return sources.read_view(spark, path, VISITORS_BY_PRODUCT)


@_query(BATCH_JOB_SQL.format(columns=COUNTS_SQL))
def batch_job_on_streamed_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = new_table_dir(spark, "master")
    lines = _as_stream(spark, ops.with_record_props(_kafka_lines(spark, sf_dir)))
    flat = ops.flatten_props(ops.parse_activity(lines, DAY_MS))
    streaming.append_master_stream(flat, master, trigger=NOW).awaitTermination()
    path, _ = run_batch_views(spark, master, new_table_dir(spark, "batch"), hours=72, as_of=AS_OF)
    return sources.read_view(spark, path, ACTIVITY_BY_PRODUCT)


# Streams


@_query(f"""
SELECT product, ts_ms // {DAY_MS} * {DAY_MS} AS window_start, max(event_id) AS event_id,
       arg_max(ts_ms, event_id) AS ts_ms, arg_max(action, event_id) AS action,
       arg_max(visitor, event_id) AS visitor
FROM clicks GROUP BY ALL""")
def last_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _activity(spark, sf_dir).select("product", "event_id", "ts_ms", "action", "visitor")
    return ops.last_per_window(changes, ["product"], "ts_ms", "event_id", DAY_MS)


def _as_stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows landed as Parquet, followed as a stream in MICRO_BATCHES micro-batches."""
    path = new_table_dir(spark, "landing")
    rows.repartition(MICRO_BATCHES * FILES).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def _landed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clicks landed as text lines, followed as a stream in MICRO_BATCHES micro-batches."""
    path = new_table_dir(spark, "landing")
    lines = ops.encode_activity(_activity(spark, sf_dir)).repartition(MICRO_BATCHES * FILES)
    sinks.write_lines(lines, path=path)
    return sources.read_click_stream(spark, path=path, max_files_per_trigger=FILES)


def _activity_stream(spark: SparkSession, sf_dir: str, bucket_ms: int = HOUR_MS) -> DataFrame:
    return ops.parse_activity(_landed_stream(spark, sf_dir), bucket_ms)


def _upserted(spark: SparkSession, view: DataFrame, keys: list[str]) -> DataFrame:
    path = new_table_dir(spark, "stream-view")
    streaming.upsert_view(view, path, trigger=NOW).awaitTermination()
    streaming.compact_view(spark, path, view.schema, keys)
    return streaming.latest_view(spark, path, view.schema, keys)


BOTH = ["product", "timestamp_hour"]


@_query(_view_sql())
def stream_activity_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = streaming.activity_view_stream(_activity_stream(spark, sf_dir))
    return _upserted(spark, view, BOTH)


@_query(_view_sql())
def stream_bucketed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_activity_view``, from a base in buckets and the micro-batches after it."""
    path, landing = new_table_dir(spark, "stream-view"), new_table_dir(spark, "landing")
    clicks = _activity(spark, sf_dir)
    for part in range(3):
        sinks.write_lines(ops.encode_activity(clicks.where(F.col("event_id") % 3 == part)), path=landing)
        view = streaming.activity_view_stream(ops.parse_activity(sources.read_click_stream(spark, path=landing)))
        streaming.upsert_view(view, path, trigger=NOW).awaitTermination()
        if part < 2:
            streaming.compact_bucketed_view(spark, path, view.schema, BOTH, buckets=FILES)
    return streaming.latest_bucketed_view(spark, path, view.schema, BOTH)


@_query(_close_sql("sketch"))
def stream_visitor_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = streaming.visitor_view_stream(_activity_stream(spark, sf_dir), ["product"])
    return _beside_exact(spark, sf_dir, _upserted(spark, view, ["product"]))


@_query(_visitors_sql("product"))
def stream_exact_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = streaming.exact_visitors_stream(_activity_stream(spark, sf_dir), keys=["product"])
    return _upserted(spark, view, ["product"])


@_query("SELECT product, timestamp_hour, count(*) AS unique_visitors FROM clicks GROUP BY ALL")
def stream_click_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = streaming.exact_visitors_stream(_activity_stream(spark, sf_dir), distinct=False)
    return _upserted(spark, view, BOTH)


# Expiring views: the clicks come in four parts, by event id, at four times. A key idle for longer
# than the limit before a part starts over with it; a key idle for longer at the end is gone.
PARTS = 4


def _part_times(ttl_ms: int) -> list[int]:
    """At the limit after the part before, within it, beyond it."""
    return [0, ttl_ms, ttl_ms + ttl_ms // 2, 3 * ttl_ms]


def _live_at(ttl_ms: int) -> int:
    return _part_times(ttl_ms)[-1] + ttl_ms // 2


def _expiring_sql(columns: str, ttl_ms: int) -> str:
    """``columns`` of the clicks in each key's run that is alive in the end."""
    return f"""
SELECT product, timestamp_day AS timestamp_hour, {columns}
FROM (SELECT *, max(started) OVER (PARTITION BY product, timestamp_day) AS last_start,
             max(part_ms) OVER (PARTITION BY product, timestamp_day) AS last_seen
      FROM (SELECT *, max(CASE WHEN part_ms - before > {ttl_ms} OR before IS NULL THEN part_ms END)
                        OVER (PARTITION BY product, timestamp_day ORDER BY part_ms) AS started
            FROM (SELECT c.*, lag(part_ms) OVER (PARTITION BY product, timestamp_day ORDER BY part_ms, event_id) AS before
                  FROM (SELECT *, list_extract({_part_times(ttl_ms)}, (event_id % {PARTS} + 1)::INT) AS part_ms FROM clicks) c)))
WHERE part_ms >= last_start AND last_seen >= {_live_at(ttl_ms) - ttl_ms}
GROUP BY product, timestamp_day"""


def _expiring(spark: SparkSession, sf_dir: str, kind: str, ttl_ms: int = TTL_MS) -> DataFrame:
    path, checkpoint = (new_table_dir(spark, f"expiring-{kind}") for _ in range(2))
    landing, clicks = new_table_dir(spark, "landing"), _activity(spark, sf_dir)
    for part, now_ms in enumerate(_part_times(ttl_ms)):
        sinks.write_lines(ops.encode_activity(clicks.where(F.col("event_id") % PARTS == part)), path=landing)
        lines = ops.parse_activity(sources.read_click_stream(spark, path=landing), DAY_MS)
        streaming.start_expiring_view(lines, path, kind, lambda now_ms=now_ms: now_ms, checkpoint, NOW).awaitTermination()
        if part == 1:
            streaming.compact_expiring_view(spark, path, kind, ttl_ms)
    return streaming.live_view(spark, path, kind, ttl_ms, _live_at(ttl_ms))


VISITORS_COLUMN = "count(DISTINCT visitor) AS unique_visitors"


@_query(_expiring_sql(COUNTS_SQL, TTL_MS))
def stream_latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expiring(spark, sf_dir, "activity")


@_query(_expiring_sql(VISITORS_COLUMN, TTL_MS))
def stream_expiring_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expiring(spark, sf_dir, "visitors")


@_query(_expiring_sql(VISITORS_COLUMN, TTL_MS))
def stream_expiring_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expiring(spark, sf_dir, "exact")


CLICKS_TTL_MS = 34_000  # (fixed value)


@_query(_expiring_sql("count(*) AS unique_visitors", CLICKS_TTL_MS))
def stream_expiring_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expiring(spark, sf_dir, "clicks", CLICKS_TTL_MS)


@_query(_view_sql())
def stream_published_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = streaming.activity_view_stream(_activity_stream(spark, sf_dir))
    path = new_table_dir(spark, "published")
    query = streaming.publish_view(view, "activityByProduct", path, keys=BOTH, trigger=NOW)
    query.awaitTermination()
    return spark.table("activityByProduct")


@_query("SELECT product, timestamp_minute AS timestamp_hour," + COUNTS_SQL + " FROM clicks WHERE event_id % 2 = 1 GROUP BY ALL")
def stream_published_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events in one micro-batch, then odd ones: the table is the aggregate of the newest."""
    landing, path = new_table_dir(spark, "landing"), new_table_dir(spark, "published")
    clicks = _activity(spark, sf_dir)
    for part in range(2):
        sinks.write_lines(ops.encode_activity(clicks.where(F.col("event_id") % 2 == part)), path=landing)
        rows = ops.parse_activity(sources.read_click_stream(spark, path=landing), MINUTE_MS)
        streaming.publish_view(
            rows, "newestActivity", path, transform=ops.activity_by_product, trigger=NOW).awaitTermination()
    return spark.table("newestActivity")


def _pipeline(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    lines = ops.with_file_props(_landed_stream(spark, sf_dir), TOPIC)
    master, views = new_table_dir(spark, "master"), new_table_dir(spark, "views")
    start_pipeline(lines, master, views, DAY_MS, clock=lambda: AS_OF, trigger=NOW).awaitTermination()
    return master, views


@_query(f"""
{_flat_sql("timestamp_day")}, 0::INT AS "kafkaPartition", NULL::VARCHAR AS "fromOffset", NULL::VARCHAR AS "untilOffset"
FROM clicks""")
def stream_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    master, _ = _pipeline(spark, sf_dir)
    return sources.read_master(spark, master)


@_query(_view_sql("timestamp_day"))
def stream_pipeline_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, views = _pipeline(spark, sf_dir)
    return streaming.live_view(spark, f"{views}/{ACTIVITY_VIEW}", "activity", now_ms=AS_OF)


@_query(_visitors_sql("product, timestamp_day AS timestamp_hour"))
def stream_pipeline_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, views = _pipeline(spark, sf_dir)
    return streaming.live_view(spark, f"{views}/{VISITORS_VIEW}", "visitors", now_ms=AS_OF)


# Streams in parts: micro-batch n holds part n of the clicks.


def _in_parts(spark: SparkSession, rows: DataFrame, part: Column, parts: int) -> DataFrame:
    path, numbered = new_table_dir(spark, "landing"), rows.withColumn("part", part.cast("long"))
    for n in range(parts):
        numbered.where(F.col("part") == n).repartition(FILES).write.mode("append").parquet(path)
    return spark.readStream.schema(numbered.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def _until_idle(spark: SparkSession, start: Callable[[], StreamingQuery], batch_id: int | None = None) -> None:
    """Run a query until it has nothing to read, or has committed a micro-batch, however long it takes."""
    log = streaming.watch_progress(spark)
    try:
        streaming.stop_after(start(), log, batch_id, seconds=float("inf"))
    finally:
        spark.streams.removeListener(log)


EVERY_SECOND = {"processingTime": "1 second"}


def _state(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Keyed state with the limit and the clock of the expiring views, read from the state store."""
    checkpoint = new_table_dir(spark, f"state-{kind}")
    clicks = _in_parts(spark, _activity(spark, sf_dir, DAY_MS), F.col("event_id") % PARTS, PARTS)
    now = F.element_at(F.array(*map(F.lit, _part_times(TTL_MS))), (F.col("part") + 1).cast("int"))
    _until_idle(spark, lambda: streaming.start_state_view(clicks, checkpoint, kind, TTL_MS, now, EVERY_SECOND))
    return streaming.state_view(spark, checkpoint, kind, TTL_MS, _live_at(TTL_MS))


@_query(_expiring_sql(COUNTS_SQL, TTL_MS))
def stream_state_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(spark, sf_dir, "activity")


@_query(_expiring_sql(VISITORS_COLUMN, TTL_MS))
def stream_state_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(spark, sf_dir, "exact")


@_query(_view_sql())
def stream_state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys of a running aggregation, from its state store."""
    view, path = streaming.activity_view_stream(_activity_stream(spark, sf_dir)), new_table_dir(spark, "stream-view")
    streaming.upsert_view(view, path, trigger=NOW).awaitTermination()
    return streaming.aggregate_state(spark, f"{path}/_checkpoint", ACTIVITY_BY_PRODUCT.names[2:])


@_query(_view_sql("timestamp_day"))
def stream_stopped_and_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped after its first micro-batch, and gone on with to the end."""
    view = streaming.activity_view_stream(_activity_stream(spark, sf_dir, DAY_MS))
    path = new_table_dir(spark, "stream-view")
    for batch_id in (0, MICRO_BATCHES - 1):
        _until_idle(spark, lambda: streaming.upsert_view(view, path, trigger=EVERY_SECOND), batch_id)
    return streaming.latest_view(spark, path, view.schema, BOTH)


# A window of seven panes, four seconds each (fixed values), over nine micro-batches.
PANES, SLIDE_MS = 9, 4_000


@_query(f"""
SELECT pane * {SLIDE_MS} AS at_ms, product, timestamp_day AS timestamp_hour,{COUNTS_SQL}
FROM clicks JOIN generate_series(0, {PANES - 1}) panes(pane)
  ON event_id % {PANES} <= pane AND event_id % {PANES} > pane - {WINDOW_MS // SLIDE_MS}
GROUP BY ALL""")
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sliding window after each micro-batch."""
    path, times = new_table_dir(spark, "window"), iter(range(0, PANES * SLIDE_MS, SLIDE_MS))
    clicks = _in_parts(spark, _activity(spark, sf_dir, DAY_MS), F.col("event_id") % PANES, PANES)
    streaming.start_window_view(clicks, path, WINDOW_MS, lambda: next(times), trigger=NOW, keep=PANES).awaitTermination()
    return streaming.window_history(spark, path)


@_query(f"""
{_flat_sql("timestamp_day")}, kafka_partition::INT AS "kafkaPartition",
  (min(event_id) OVER part)::VARCHAR AS "fromOffset", (max(event_id) OVER part + 1)::VARCHAR AS "untilOffset"
FROM clicks WINDOW part AS (PARTITION BY kafka_partition, event_id // 2 % {MICRO_BATCHES})""")
def stream_master_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line with the offsets that its micro-batch holds of its Kafka partition."""
    part = F.floor(F.col("offset") / 2) % MICRO_BATCHES
    lines = _in_parts(spark, _kafka_lines(spark, sf_dir), part, MICRO_BATCHES).drop("part")
    master, views = new_table_dir(spark, "master"), new_table_dir(spark, "views")
    start_pipeline(lines, master, views, DAY_MS, clock=lambda: AS_OF, trigger=NOW).awaitTermination()
    return sources.read_master(spark, master)


# Clicks in parts of ten days; one of forty comes a part later, some of these too late.
FIRST_MS, PART_MS, LATE_PARTS, DELAY_DAYS = 1_704_067_200_000, 10 * DAY_MS, 4, 3


@_query(f""",
parted AS (
  SELECT *, least((ts_ms - {FIRST_MS}) // {PART_MS}, 2) + (event_id % 40 = 7)::INT AS part FROM clicks),
marks AS (
  SELECT part, coalesce(max(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING), 0) - {DELAY_DAYS * DAY_MS} AS mark
  FROM (SELECT part, max(timestamp_hour) AS newest FROM parted GROUP BY part))
SELECT product, timestamp_hour,{COUNTS_SQL}
FROM parted JOIN marks USING (part)
WHERE timestamp_hour > mark AND timestamp_hour <= (SELECT max(timestamp_hour) FROM parted) - {DELAY_DAYS * DAY_MS}
GROUP BY ALL""")
def stream_closed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets that no click reaches any more; clicks that come after that are left out."""
    clicks, path = _activity(spark, sf_dir), new_table_dir(spark, "closed")
    part = F.least(F.floor((F.col("ts_ms") - FIRST_MS) / PART_MS), F.lit(2)) + (F.col("event_id") % 40 == 7).cast("int")
    closed = streaming.closed_activity_view(_in_parts(spark, clicks, part, LATE_PARTS), f"{DELAY_DAYS} days")
    streaming.append_view(closed, path, trigger=NOW).awaitTermination()
    return streaming.read_changes(spark, path, ACTIVITY_BY_PRODUCT).select(*ACTIVITY_BY_PRODUCT.names)
