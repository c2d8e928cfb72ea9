import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import SF_DIR, rows_of
from twinview.llm import near
from twinview.llm.components import components

COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def copies(seed, families=12, most=14):
    """Texts and copies of them with words changed, dropped and put in."""
    rng, out = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(rng.randrange(1, most)):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            out.append(" ".join(words[rng.randrange(2):]))
    rng.shuffle(out)
    return [(i * 3 - 7, t) for i, t in enumerate(out)]


@pytest.mark.parametrize(("seed", "width", "block"), [(1, 2, near.BLOCK_SHINGLES), (2, 2, 300), (3, 5, 200)])
def test_components_equal_brute_force(spark, monkeypatch, seed, width, block):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(near, "GROUP_SHINGLES", 2 * block)
    rows = copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(near.near_duplicates(df, width), *COLUMNS) == sorted(brute.near(rows, width))


def test_odd_rows(spark, odd, empty):
    from tests.llm.conftest import ODD

    rows = [(d, t) for d, t, _ in ODD]
    expected = brute.near(rows, 5)
    expected += [r for r in expected if r[0] in (1, 3, 9)]  # the repeated rows
    assert rows_of(near.near_duplicates(odd), *COLUMNS) == sorted(expected)
    assert near.near_duplicates(empty).count() == 0


def test_rows_without_id_and_ids_with_several_texts(spark):
    one, two = "a b c d e f g h", "p q r s t u v w"
    rows = [(None, one), (None, one), (1, one), (2, one), (2, two), (3, two)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near.near_duplicates(df, 2), "doc_id", "component_id", "kept") == [
        (1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (None, None, True), (None, None, True)]


def test_no_signature_within_the_distance_is_missed():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 16, near.VALUES, dtype=np.uint16)
    keys = set(near._index_keys(base[None])[0].tolist())
    for _ in range(200):
        other = base.copy()
        other[rng.choice(near.VALUES, 2 * near.CHUNKS - 1, replace=False)] ^= 1
        assert keys & set(near._index_keys(other[None])[0].tolist())


def test_query_equals_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows_of(near.op2_hamming_join(spark, SF_DIR), *COLUMNS) == sorted(brute.near(rows, 2))


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_connected_components(spark, shape):
    rng = random.Random(7)
    links = {
        "path": [(i, i + 1) for i in range(70)], "star": [(500, i) for i in range(90)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)], "none": [(4, 4), (None, 3)],
    }[shape]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert rows_of(found, "node", "component") == sorted((x, root(x)) for x in parent)


@pytest.mark.parametrize("size", [100, 100_000, 400_000])
def test_signatures_tell_unrelated_sets_of_any_size_apart(size):
    drawn = np.random.default_rng(size).integers(0, 1 << 63, 2 * size, dtype=np.uint64)
    one, other, near_one = drawn[:size], drawn[size:], np.concatenate([drawn[: size * 9 // 10], drawn[-size // 10 :]])
    found = near.signatures(np.concatenate([one, other, near_one]), np.cumsum([0, size, size, len(near_one)]))
    assert (found[0] != found[1]).sum() >= 110
    assert (found[0] != found[2]).sum() <= near.NEAR


def _changed(rng, values, count):
    out = values.copy()
    out[rng.choice(near.VALUES, count, replace=False)] = rng.integers(0, 1 << 16, count, dtype=np.uint16)
    return out


def polluted(seed, size=700):
    """Signatures drawn from one small pool, so that buckets hold many that are far apart, copies at all
    distances, and a group of near copies whose leaders are at its rim."""
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 1 << 16, (near.VALUES, 2), dtype=np.uint16)
    rows = [np.where(rng.random(near.VALUES) < 0.45, pool[:, 0], rng.integers(0, 1 << 16, near.VALUES, dtype=np.uint16)) for _ in range(size)]
    rows += [_changed(rng, rows[i], int(rng.integers(1, 2 * near.CHUNKS))) for i in range(0, size, 5)]
    centre = rng.integers(0, 1 << 16, near.VALUES, dtype=np.uint16)
    rows += [_changed(rng, centre, int(n)) for n in rng.integers(0, 34, 120)]
    return np.array(rows, np.uint16)[rng.permutation(len(rows))]


@pytest.mark.parametrize(("seed", "block"), [(1, near.BLOCK_ROWS), (2, 40)])
def test_no_near_pair_of_a_polluted_bucket_is_lost(spark, monkeypatch, tmp_path, seed, block):
    """Every pair within the distance, and every near pair with a bucket in common, is in one cluster."""
    monkeypatch.setattr(near, "BLOCK_ROWS", block)
    values = polluted(seed)
    classes = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(values)], "id long, signature binary").repartition(3)

    def written(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    links = near.candidates(classes, written)
    assert all((values[r.a] != values[r.b]).sum() <= near.NEAR for r in links.collect())
    cluster = {r.node: r.component for r in components(links).collect()}
    keys = [set(k) for k in near._index_keys(values).tolist()]
    pairs = [(a, b) for a in range(len(values)) for b in np.flatnonzero((values[a + 1 :] != values[a]).sum(1) <= near.NEAR) + a + 1]
    certain = [(a, b) for a, b in pairs if (values[a] != values[b]).sum() <= 2 * near.CHUNKS - 1]
    assert len(certain) > 100 and all(keys[a] & keys[b] for a, b in certain)
    assert all(cluster[a] == cluster[b] for a, b in pairs if keys[a] & keys[b])
