import numpy as np
import pytest

from tests.llm.conftest import SF_DIR
from twinview.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, queries, k=10):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, point in usable:
        if q in queries:
            near = sorted((float(np.sqrt(((p - point) ** 2).sum())), i) for i, p in usable if i != q and len(p) == len(point))
            out[q] = near[:k]
    return out


def search(spark, rows, queries, shards, tmp_path, k=10, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    path = str(tmp_path / "index")
    hnsw.build_index(df, shards).write.parquet(path)
    found = hnsw.search(spark.read.schema(hnsw.INDEX).parquet(path), df.where(df.vec_id.isin(*queries)), shards, k, **how).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("shards, part_queries", [(1, 100), (4, 3)])
def test_small_tables_are_searched_exactly(spark, tmp_path, shards, part_queries):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(80)]
    rows += [(100 + i, [1.0] * 8) for i in range(40)]  # one vector of a third of all rows
    rows += [(200, None), (201, [0.0] * 8), (202, [1.0, float("nan")] + [0.0] * 6), (203, [float("inf")] + [1.0] * 7),
             (204, [1.0, None] + [0.0] * 6), (205, []), (None, [2.0] * 8), (206, [1.0, 2.0]), (207, [1.0, 2.5]), (7, rows[7][1])]
    queries = [0, 7, 100, 139, 200, 201, 202, 204, 206]
    assert search(spark, rows, queries, shards, tmp_path, part_queries=part_queries) == exact(rows, queries)


def test_fewer_candidates_than_asked(spark, tmp_path):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 3.0])]
    assert search(spark, rows, [1, 2], 3, tmp_path) == {1: [(1.0, 2)], 2: [(1.0, 1)]}
    assert search(spark, rows[:1], [1], 2, tmp_path / "one") == {}


def test_no_vectors(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    assert hnsw.search(hnsw.build_index(df, 2), df, 2).count() == 0


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    expected = exact(rows, {i for i, _ in rows if i % 100 == 0})
    found = {}
    for r in hnsw.op10_hnsw_shards(spark, SF_DIR).collect():
        found.setdefault(r.query_id, set()).add((r.score, r.vec_id))
    hits = sum(len(found[q] & set(near)) for q, near in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values())) and all(len(found[q]) == len(near) for q, near in expected.items())


def test_recall_over_twelve_shards(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 32))
    points = (centres[rng.integers(20, size=6000)] + 0.5 * rng.normal(size=(6000, 32))).astype(np.float32)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    queries = list(range(0, 6000, 100))
    found = search(spark, rows, queries, 12, tmp_path, part_queries=25)
    expected = exact(rows, set(queries))
    hits = sum(len({i for _, i in found[q]} & {i for _, i in near}) for q, near in expected.items())
    assert hits >= 0.95 * 10 * len(queries)


def test_shards_grow_with_the_root_of_the_table():
    assert [hnsw.shards_of(n, 64 * n) for n in (0, 1, 4096, 409_600)] == [1, 1, 2, 20]
    assert hnsw.shards_of(10**9, 64 * 10**9) == -(-8 * 64 * 10**9 // hnsw.SHARD_BYTES)
