import collections
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_set
from twinview import operators as ops
from twinview.functions import HOUR_MS
from twinview.operators.views import estimate_visitors


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 clicks; one product has a third of them, one visitor a third of its clicks."""
    rng = random.Random(3)
    rows = []
    for _ in range(20_000):
        hot = rng.random() < 1 / 3
        visitor = 0 if hot and rng.random() < 1 / 3 else rng.randint(1, 3_000)
        rows.append((
            0 if hot else rng.randint(1, 40), rng.randrange(3) * HOUR_MS,
            rng.choice(["purchase", "add_to_cart", "page_view", "page_view", "error"]), visitor,
        ))
    df = spark.createDataFrame(rows, "product int, timestamp_hour long, action string, visitor int")
    text = df.withColumn("product", F.col("product").cast("string")).withColumn(
        "visitor", F.col("visitor").cast("string"))
    return rows, text.repartition(8).cache()


def test_counts_and_visitors_equal_brute_force(skewed):
    rows, df = skewed
    counts, visitors = collections.defaultdict(collections.Counter), collections.defaultdict(set)
    for product, hour, action, visitor in rows:
        counts[str(product), hour][action] += 1
        visitors[str(product), hour].add(visitor)
    assert as_set(ops.product_summary(df)) == sorted(
        (*key, c["purchase"], c["add_to_cart"], c["page_view"], len(visitors[key]))
        for key, c in counts.items()
    )
    assert as_set(ops.activity_by_product(df)) == as_set(ops.product_summary(df).drop("unique_visitors"))
    assert as_set(ops.visitors_by_product(df)) == sorted((*k, len(v)) for k, v in visitors.items())


def test_key_of_uncounted_actions_stays(spark):
    df = spark.createDataFrame([("a", 0, "error")], "product string, timestamp_hour long, action string")
    assert as_set(ops.activity_by_product(df)) == [("a", 0, 0, 0, 0)]


def test_sketches_are_close_and_mergeable(skewed):
    _, df = skewed
    exact = {r[0]: r[1] for r in ops.visitors_by_product(df, ["product"]).collect()}
    whole = ops.approx_visitors_by_product(df, ["product"])
    merged = estimate_visitors(ops.merge_sketches(ops.visitor_sketches(df), ["product"]))
    once = ops.approx_visitors_oneshot(df, ["product"])
    for result in (whole, merged, once):
        estimates = {r.product: r.unique_visitors for r in result.collect()}
        assert estimates.keys() == exact.keys()
        assert all(abs(estimates[p] - n) <= max(1, 0.05 * n) for p, n in exact.items())


def test_recent_is_inclusive_and_open_ended(spark):
    now_s = 100 * 3600
    hours = [0, 93, 94, 95, 100, 5000]
    df = spark.createDataFrame([(h * HOUR_MS,) for h in hours], "timestamp_hour long")
    kept = [r[0] // HOUR_MS for r in ops.recent(df, 6, as_of=now_s).collect()]
    assert kept == [94, 95, 100, 5000]
    assert [r[0] // HOUR_MS for r in ops.recent(df, 6, as_of=now_s + 1).collect()] == [95, 100, 5000]
    assert ops.recent(df).count() == 0


def test_under_exposed_guards_zero(spark):
    df = spark.createDataFrame(
        [("a", 0, 7), ("b", 2, 7), ("c", 3, 2)], "product string, purchase_count long, page_view_count long")
    assert [r.under_exposed for r in ops.under_exposed(df).orderBy("product").collect()] == [0, 3, 0]


def test_last_per_window(spark):
    rows = [("a", 0, 1, 10), ("a", 27_999, 2, 20), ("a", 28_000, 3, 30), ("b", 5, 4, 40)]
    df = spark.createDataFrame(rows, "product string, at long, n long, v long")
    last = ops.last_per_window(df, ["product"], "at", "n")
    assert as_set(last, "product", "window_start", "v") == [("a", 0, 20), ("a", 28_000, 30), ("b", 0, 40)]


def test_reports(spark):
    view = spark.createDataFrame(
        [("aa", 0, 1, 2, 3), ("bb", 0, 0, 0, 4), ("c", 60_000, 0, 0, 1)],
        "product string, timestamp_hour long, purchase_count long, add_to_cart_count long, page_view_count long")
    assert as_set(ops.views_by_name_length(view)) == [(1, 1), (2, 7)]
    assert as_set(ops.labelled_buckets(view, zone="UTC"))[0] == ("01-01 00:00:00", 0, 0, 4)
    assert ops.preview(view, 2).count() == 2
    assert [r.product for r in ops.preview(view, 2, ["product"]).collect()] == ["aa", "bb"]
    visitors = view.select("product", "timestamp_hour", *(F.lit(5).cast("long").alias(c) for c in ("unique_visitors", "sketched")))
    both = ops.compare_visitors(visitors, ["aa"], zone="UTC")
    assert as_set(both) == [("00:00:00", "aa", 0, 5), ("00:00:00", "aa", 5, 0)]
    assert ops.compare_visitors(visitors).count() == 6


def test_registered_table(spark):
    ops.register(spark.range(3), "some_numbers", cache=True)
    assert spark.catalog.isCached("some_numbers")
    ops.register(spark.range(5), "some_numbers")
    assert spark.sql("SELECT count(*) FROM some_numbers").first()[0] == 5


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("InMemoryTableScan")[0]


def test_views_aggregate_before_they_shuffle(skewed):
    _, df = skewed
    for view in (ops.activity_by_product(df), ops.visitors_by_product(df), ops.visitor_sketches(df)):
        below_shuffles = plan(view).split("Exchange ")[-1]
        assert "HashAggregate" in below_shuffles
    # Exact visitors: the first shuffle also spreads by visitor.
    visitors = plan(ops.visitors_by_product(df))
    assert "visitor" in visitors[visitors.rindex("hashpartitioning"):].split("\n")[0]


def test_shared_pass_over_the_clicks(skewed):
    _, df = skewed
    assert plan(ops.product_summary(df)).count("Exchange hashpartitioning(product") == 2
