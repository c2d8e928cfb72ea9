import random

import pytest

from tests.conftest import as_set
from twinview import streaming
from twinview.schema import ACTIVITY_BY_PRODUCT

KEYS = ["product", "timestamp_hour"]


def changed(rng, n):
    keys = {(rng.choice([None, *"ABCDEFGH"]), rng.choice([None, 0, 1])) for _ in range(12)}
    return [(*key, n, rng.randrange(9), 0) for key in keys]


def nodes_above_base(plan):
    """Operators between the root and the scan of the base, from the indented plan."""
    above = []
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [a for a in above if a[0] < depth] + [(depth, line)]
        if "spark_catalog.default.base_" in line:
            return [text for _, text in above]
    raise AssertionError(plan)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_base_in_buckets_equals_the_log(spark, tmp_path, broadcast):
    path, rng = str(tmp_path / "view"), random.Random(1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert streaming.compact_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS) is None
        assert as_set(streaming.latest_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS)) == []
        for n in range(7):
            streaming.write_changes(spark.createDataFrame(changed(rng, n), ACTIVITY_BY_PRODUCT), path, n)
            view = streaming.latest_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS)
            assert as_set(view) == as_set(streaming.latest_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS))
            if n > 2:
                above = nodes_above_base(view._jdf.queryExecution().explainString(view.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")))
                assert any("Join" in a for a in above) and not any("Exchange" in a for a in above)
                assert ("Bucketed: true" in above[-1]) == (broadcast == "-1")
            if n in (2, 3, 5):
                buckets = {2: 4, 3: None, 5: 3}[n]
                assert streaming.compact_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS, buckets) == n
                assert streaming.compact_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS) is None
                again = streaming.latest_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS)
                assert as_set(again) == as_set(streaming.latest_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS))
        assert sorted(p.name for p in (tmp_path / "view" / "bucketed").iterdir()) == ["upto=3", "upto=5"]
        # one file of the base before and one of changed rows a bucket at most
        assert len(list((tmp_path / "view" / "bucketed" / "upto=3").glob("*.parquet"))) <= 8
        expected = as_set(streaming.latest_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS))
        streaming.drop_bucketed(spark, path)
        assert sorted(p.name for p in (tmp_path / "view" / "changes").iterdir()) == [f"batch_id={n}" for n in (4, 5, 6)]
        assert as_set(streaming.latest_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in (2, 3, 5):
            spark.sql(f"DROP TABLE IF EXISTS {streaming.bucketed._name(path, n)}")


def test_a_base_of_another_session_is_found(spark, tmp_path):
    path = str(tmp_path / "view")
    streaming.write_changes(spark.createDataFrame([("A", 0, 1, 2, 3), (None, None, 4, 5, 6)], ACTIVITY_BY_PRODUCT), path, 0)
    streaming.compact_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS, 2)
    spark.sql(f"DROP TABLE {streaming.bucketed._name(path, 0)}")  # as if it had been made elsewhere
    assert as_set(streaming.latest_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS)) == [(None, None, 4, 5, 6), ("A", 0, 1, 2, 3)]
    assert streaming.compact_bucketed_view(spark, path, ACTIVITY_BY_PRODUCT, KEYS) is None
