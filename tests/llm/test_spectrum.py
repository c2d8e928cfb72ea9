import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from twinview.llm import spectrum

SPECTRA = {
    "apart": lambda draw, n: draw.standard_normal(n) * 10, "whole": lambda draw, n: np.round(draw.standard_normal(n) * 2),
    "equal": lambda draw, n: np.ones(n), "none": lambda draw, n: np.zeros(n),
    "close": lambda draw, n: np.where(np.arange(n) % 2, 5 + 1e-11 * draw.random(n), draw.random(n)),
}


@pytest.mark.parametrize("kind", SPECTRA)
@pytest.mark.parametrize("n", [1, 2, 3, 9, 33])
def test_eigenpairs(kind, n):
    draw = np.random.default_rng(n)
    q, _ = np.linalg.qr(draw.standard_normal((n, n)))
    matrix = q @ np.diag(SPECTRA[kind](draw, n)) @ q.T
    matrix = (matrix + matrix.T) / 2
    exact = np.linalg.eigvalsh(matrix)[::-1]
    for shift in draw.standard_normal(5):
        assert spectrum.negative_pivots(matrix - shift * np.eye(n)) == (exact < shift).sum()
    values, vectors = spectrum.leading_eigenpairs(matrix)
    assert np.allclose(values, exact[:8], atol=1e-10 * max(1, abs(exact).max()))
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-9)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-8)


def test_inertia_with_zero_diagonal():
    matrix = np.array([[0, 1, 0, 0], [1, 0, 0, 0], [0, 0, 0, 2], [0, 0, 2, 0.0]])
    assert spectrum.negative_pivots(matrix) == 2
    assert spectrum.eigenvalues_above(matrix, 1.5) == 1


def expected(vectors):
    """Whole-number rows, sums, eigenvalues and vectors by NumPy."""
    x = np.floor(1024 * vectors.astype(np.float64)) + 100_000
    values, found = np.linalg.eigh(np.cov(x.T, bias=True))
    return x.astype(int), values[::-1], found.T[::-1]


def test_whitened_embeddings(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    given = {r.vec_id: np.array(r.embedding, np.float32) for r in df.collect()}
    ids = list(given)
    x, values, vectors = expected(np.stack([given[i] for i in ids]))
    n, sums = len(x), x.sum(0)
    deviation = dict(zip(ids, ((n * x - sums) ** 2).sum(1)))
    white = (x - sums / n) @ vectors.T / np.sqrt(values)
    out = spectrum.whiten(df.withColumn("n", F.lit("own")).withColumn("label2", F.lit("own")).repartition(5))
    assert out.columns == ["vec_id", "label", "label2", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = out.collect()
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, c) for i in ids for c in range(1, 9))
    got = {(r.vec_id, r.component): r.whitened for r in rows}
    for c in range(8):
        mine = np.array([got[i, c + 1] for i in ids])
        assert np.allclose(mine * np.sign(mine @ white[:, c]), white[:, c], atol=1e-8)
    assert all(r.n == n and r.deviation == deviation[r.vec_id] for r in rows)
    assert all(abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12 for r in rows)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-8
    again = spectrum.whiten(df.repartition(2))
    assert {(r.vec_id, r.component): r.whitened for r in again.collect()} == got


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), float(i * i % 7), -1.5]) for i in range(6)]
    bad = [(10, None), (11, []), (12, [1.0, None, 2.0]), (13, [nan, 0.0, 0.0]), (14, [0.0, -inf, 0.0]), (15, [1.0, 2.0]), (None, [2.0, 2.0, -1.5])]
    rows = [*good, good[1], *bad]
    out = spectrum.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((str(r.vec_id), r.component) for r in out) == sorted((str(i), c) for i in [0, 1, 1, 2, 3, 4, 5, None] for c in (1, 2, 3))
    assert {r.n for r in out} == {8}
    # the third dimension never changes: no variance, nothing whitened, and no part of the error
    assert all((r.whitened is None) == (r.component == 3) for r in out)
    assert max(r.identity_error for r in out) < 1e-8


def test_equal_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    out = spectrum.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in out] == [(None, 0.0, 0, 0.0)] * 4
    assert spectrum.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert spectrum.whiten(spark.createDataFrame([], schema)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries(spark):
    """Sums and deviations beyond a long stay exact, or are null."""
    rows = [(1, [2.0**40, 1.0]), (2, [0.0, 0.0]), (3, [1e300, 2.0])]
    schema = "vec_id long, embedding array<double>"
    two = spectrum.whiten(spark.createDataFrame(rows[:2], schema)).collect()
    assert {r.deviation for r in two} == {None} and two[0].identity_error < 1e-6
    three = spectrum.whiten(spark.createDataFrame(rows, schema)).collect()
    assert len(three) == 6 and np.isfinite([r.whitened for r in three if r.component == 1]).all()
    x, sums = np.array([[5, 2**31], [7, 3]], object), np.array([12, 2**31 + 3], object)
    assert spectrum._deviations(x.astype(np.int64), sums, 2).to_pylist() == [int(v) for v in ((2 * x - sums) ** 2).sum(1)]
