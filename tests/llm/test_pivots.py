import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from twinview.llm import pivots

SCHEMA = "vec_id long, label string, embedding array<float>"


def by_all_pairs(rows, cosine=0.93):
    """(vec_id, n_links, component_id, kept) of (vec_id, label, vector), row by row."""
    usable = [i for i, (_, label, v) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unit = {i: np.array(rows[i][2], np.float32).astype(float) for i in usable}
    for at, i in enumerate(usable):
        for j in usable[at + 1 :]:
            x, y = unit[i], unit[j]
            if rows[i][1] == rows[j][1] and len(x) == len(y) and x @ y >= cosine * np.sqrt((x @ x) * (y @ y)):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[root(i)] = min(least.get(root(i), row[0]), row[0])
    return sorted(((r[0], links[i], least.get(root(i)), r[0] == least.get(root(i))) for i, r in enumerate(rows)), key=str)


def found(df, **options):
    return sorted((tuple(r) for r in pivots.near_vectors(df, **options).collect()), key=str)


def planted(seed=0, dims=12):
    """Noise, chains, tight and loose clusters, copies and scaled copies, in two labels."""
    draw, vectors = np.random.default_rng(seed), []
    vectors += list(draw.standard_normal((60, dims)))
    for spread, size in ((0.02, 40), (0.12, 40), (0.2, 30)):
        vectors += list(draw.standard_normal(dims) + spread * draw.standard_normal((size, dims)))
    start, way = draw.standard_normal((2, dims))
    vectors += [np.cos(a) * start + np.sin(a) * way for a in np.linspace(0, 2.5, 15)]
    vectors += [vectors[3]] * 20 + [vectors[3] * 1000, vectors[70] * 1e-20]
    order = draw.permutation(len(vectors))
    return [(int(i), "ab"[int(i) % 3 == 0], np.float32(v).tolist()) for i, v in zip(order, vectors)]


@pytest.mark.parametrize("cell", [4096, 10])
def test_as_by_all_pairs(spark, cell):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(df, cell=cell) == by_all_pairs(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, "a", [1.0, 0.0]), (2, "a", [1.0, 0.0]), (2, "a", [1.0, 0.0]), (3, "b", [1.0, 0.0]), (4, None, [1.0, 0.0]),
            (5, "a", None), (6, "a", []), (7, "a", [0.0, 0.0]), (8, "a", [nan, 1.0]), (9, "a", [inf, 1.0]), (10, "a", [None, 1.0]),
            (11, "a", [1.0, 0.0, 0.0]), (None, "a", [1.0, 0.1]), (None, "c", [1.0, 0.0]), (1, "a", [0.0, 1.0]), (12, "a", [0.0, -0.0]),
            (13, "a", [-1.0, -0.0]), (14, "a", [1e-38, 0.0]), (15, "", [1.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("cell", "node", "copies", "digest", "component", "n_links", "kept", "vec", "home"):
        df = df.withColumn(name, F.lit("own"))
    # the null label-c row's component has no id at all, so it is kept
    expected = [(i, n, c, (i is None and c is None) or k) for i, n, c, k in by_all_pairs(rows)]
    assert found(df) == sorted(expected, key=str)


def test_no_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, None, [1.0]), (2, "a", None)], SCHEMA)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_parts_skipped_and_counted_are_as_compared(monkeypatch):
    """In one block: sorted by distance to a pivot, whatever the size of its parts."""
    monkeypatch.setattr(pivots, "PART", 5)
    draw = np.random.default_rng(3)
    x = np.concatenate([np.ones(6) + s * draw.standard_normal((30, 6)) for s in (0.01, 0.1, 0.4, 2)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = {"node": np.arange(len(x)), "copies": draw.integers(1, 4, len(x)), "dist": pivots._distances(x, x[0]), "x": x}
    node, links, _ = pivots._join(side, side, float(np.sqrt(2 - 2 * 0.93)), 0.93)
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    assert np.array_equal(np.bincount(node, links, len(x)), near @ side["copies"])


def test_threshold_in_double_precision():
    """Pairs that single precision can't tell from the bound are decided in double precision."""
    angles = np.arccos(0.93) + np.array([-1e-9, 1e-9, -1e-12, 1e-12, 0.1, -0.1])
    y = np.stack([np.cos(angles), np.sin(angles)], 1)
    assert pivots.linked(np.array([[1.0, 0.0]]), y, 0.93).tolist() == [[True, False, True, False, False, True]]


def test_another_cosine(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.label, list(r.embedding)) for r in df.collect()]
    assert found(df, cosine=0.3, cell=20) == by_all_pairs(rows, 0.3)
