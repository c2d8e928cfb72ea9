import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.conftest import ODD, SF_DIR, rows_of
from twinview.llm import blocks, induced, repeats, suffixes

WORDS = ("doc.doc_id", "n_words", "n_removed", "sha2(kept_text, 256)")
BYTES = ("doc.doc_id", "n_bytes", "n_removed", "size(spans)", "sha2(kept, 256)")


def passages(seed, count=60):
    """Texts made of passages they share, cut and put together anew."""
    rng = random.Random(seed)
    words = [f"{rng.choice('aeiouxyz')}{rng.randrange(900)}é" for _ in range(300)]
    shared = [" ".join(rng.choices(words, k=rng.choice([5, 25, 60]))) for _ in range(9)]
    out = []
    for i in range(count):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(rng.randrange(1, 6))]
        text = " ".join(parts)
        out.append((i - 4, text[rng.randrange(30):] if rng.random() < 0.5 else text))
    return out + [(900, "ab" * 300), (901, "x" + "ab" * 200), (902, " ".join("abc"[i % 3] for i in range(99)))]


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_brute_force(spark, seed):
    rows = passages(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.remove_repeats(df, block_bytes=3000, slice_windows=1 << 10)
    assert rows_of(found, *WORDS) == sorted(brute.repeats(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_strings_equal_brute_force(spark, seed):
    rows = passages(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffixes.cut_repeats(df, block_bytes=3000, slice_bytes=9000)
    assert rows_of(found, *BYTES) == sorted(brute.cut(rows))
    assert rows_of(suffixes.cut_repeats(df, as_text=True), "doc.doc_id", "length(kept)") == [
        (d, len(bytes(kept).decode(errors="ignore"))) for d, kept in rows_of(suffixes.cut_repeats(df), "doc.doc_id", "kept")]


def test_a_sort_larger_than_its_memory(spark):
    rows = passages(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(suffixes.cut_repeats(df, memory_bytes=100), *BYTES) == sorted(brute.cut(rows))


@pytest.mark.parametrize("operator", ["words", "bytes"])
def test_odd_rows(odd, empty, operator):
    run, columns, plain = {
        "words": (repeats.remove_repeats, WORDS, brute.repeats), "bytes": (suffixes.cut_repeats, BYTES, brute.cut)}[operator]
    found = run(odd)
    rows = [(d, t) for d, t, _ in [*ODD, ODD[0], ODD[2], ODD[8]]]
    assert rows_of(found, *columns) == sorted(plain(rows))
    assert rows_of(found, "doc.kept", "doc.block") == [("own kept", "own block")] * len(rows)
    assert run(empty).count() == 0


def test_rows_without_id_come_first(spark):
    text = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (None, text), (-9, text)], "doc_id long, text string")
    assert rows_of(repeats.remove_repeats(df), "doc.doc_id", "n_removed") == [(-9, 40), (1, 40), (None, 0)]
    assert rows_of(suffixes.cut_repeats(df), "doc.doc_id", "n_removed") == [(-9, len(text)), (1, len(text)), (None, 0)]


def test_queries_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = repeats.op5_count_min_windows(spark, SF_DIR)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.repeats(rows))
    found = suffixes.op9_induced_suffixes(spark, SF_DIR)
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.cut(rows))


def common_prefix(text, a, b, depth):
    n = 0
    while n < depth and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
        n += 1
    return n


@pytest.mark.parametrize(("part", "few"), [(1 << 20, 64), (1 << 20, 1), (7, 64), (7, 1)])
def test_sorted_suffixes_and_common_prefixes(monkeypatch, part, few):
    monkeypatch.setattr(induced, "SLICE", part)
    monkeypatch.setattr(induced, "FEW_NAMES", few)
    rng = random.Random(part + few)
    for _ in range(60):
        signs, text = rng.choice([b"\x01\x02", b"abc", bytes(range(1, 30))]), []
        for _ in range(rng.randrange(1, 4)):
            text += [rng.choice(signs) for _ in range(rng.randrange(1, 90))]
            text += [c for c in text[: rng.randrange(40)] if c] + [signs[0]] * rng.randrange(1, 25) + [0]
        depth = rng.choice([3, 10, 100])
        found = [(int(p), int(c)) for ps, cs in induced.Sorter(np.array(text, np.uint8), depth).descending() for p, c in zip(ps, cs)]
        assert sorted(p for p, _ in found) == list(range(len(text)))
        for (a, _), (b, shared) in zip(found, found[1:]):
            assert shared == common_prefix(text, a, b, depth)
            assert shared == depth or text[a:] > text[b:]


def test_scratch_space_is_used_again():
    scratch = induced.Scratch(1000)
    for _ in range(50):
        held = [scratch.keep(np.arange(1 << 18)) for _ in range(8)]
        assert all((x == np.arange(1 << 18)).all() for x in held)
        for x in held:
            scratch.free(x)
    assert scratch.spilled == 50 * 8 << 21 and scratch.at <= induced.EXTENT_BYTES


def table_of(rows):
    return pa.table({"doc": [{"doc_id": d} for d, _ in rows], "doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": [t for _, t in rows]})


@pytest.mark.parametrize("slices", [1, 3, 1000, 5_000_000])
def test_keys_meet_their_slices_and_answers(slices):
    rng = np.random.default_rng(slices)
    keys = np.unique(np.append(rng.integers(0, 1 << 64, 3000, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)))
    numbers, bounds, values = repeats._sliced(keys, slices)
    exact = [int(k) * slices for k in keys]
    assert np.repeat(numbers, np.diff(bounds)).tolist() == [x >> 64 for x in exact]
    assert np.abs(values.astype(np.int64) - [(x >> 32) & 0xFFFFFFFF for x in exact]).max() <= 1
    flags = rng.random(len(keys)) < 0.2
    table = pa.table({"slice": numbers, "block": numbers})
    answers = repeats._answered(table, 1, flags, bounds)
    assert answers.num_rows == len(np.unique(np.repeat(numbers, np.diff(bounds))[flags]))
    shuffled = answers.take(pa.array(rng.permutation(answers.num_rows)))
    assert (repeats._flags(shuffled, numbers, bounds) == flags).all()


@pytest.mark.parametrize("slices", [8, 1 << 20])
def test_rows_sent_grow_with_the_windows_at_most(slices):
    block = repeats._Block(table_of(passages(4)), 20)
    sent = repeats._sketched(block, 7, slices)
    assert sent.num_rows <= min(slices, len(block.keys))
    assert sum(map(len, sent["body"].to_pylist())) == 4 * (len(block.keys) + block.many.sum())
    asked = repeats._asked(block, np.flatnonzero(block.many), 7, slices, 20)
    assert 0 < asked.num_rows <= block.many.sum()


def test_no_repeated_window_is_lost_by_a_small_sketch():
    one, two = (repeats._Block(table_of(passages(seed)), 20) for seed in (5, 6))
    rows = pa.concat_tables([repeats._sketched(b, i, 4) for i, b in enumerate([one, two, one])])
    for width in (16, 4096, 1 << 16):
        parts = [rows.filter(pa.array(rows["slice"].to_numpy() == s)) for s in range(4)]
        answers = pa.concat_tables([repeats._merged(p, width) for p in parts])
        for i, block in enumerate([one, two, one]):
            found = repeats._estimated(block, answers.filter(pa.array(answers["block"].to_numpy() == i)), 4)
            assert found[block.many].all() and (found.all() or block is two)


def test_ids_far_apart_are_owners_too():
    far = [(-(1 << 62), "a " * 30), (None, "b " * 30), (1 << 62, "c " * 30), (7, "d " * 30)]
    near = [(6, "a " * 30), (8, "d " * 30), (1 << 31, "c " * 30), (-5, "b " * 30)]
    parts = [repeats._Block(table_of(rows), 20) for rows in (far, near)]
    table = pa.concat_tables([repeats._asked(b, np.arange(len(b.keys)), i, 1, 20) for i, b in enumerate(parts)])
    answers = repeats._grouped(table)
    later = [repeats._flags(answers.filter(pa.array(answers["block"].to_numpy() == i)), np.array([0]), np.array([0, 4])) for i in (0, 1)]
    owners = [b.ids[np.searchsorted(b.words.bounds, b.starts[b.first], "right") - 1].tolist() for b in parts]
    assert sorted(i for i, x in zip(owners[0], later[0]) if x) == [1 << 62]
    assert sorted(i for i, x in zip(owners[1], later[1]) if x) == [-5, 6, 8]


def test_first_ones_tell_long_keys_apart():
    keys = [np.array([5, 5, 5, 7], np.uint64), np.array([1, 2, 1, 1], np.uint32)]
    assert blocks.first_ones(keys, np.array([9, 3, 4, 0])).tolist() == [False, True, True, True]


def test_rows_asked_do_not_grow_with_the_slices():
    block = suffixes._Block(table_of(passages(4)), 100, 32)
    answers = pa.table({"key": block.anchors()[0].view(np.int64)})
    few, many = (suffixes._asked_runs(block, 3, slices, answers) for slices in (8, 8000))
    assert few.num_rows == many.num_rows == len(np.unique(few["place"].to_numpy()))
    assert max(few["slice"].to_pylist()) < 8 <= max(many["slice"].to_pylist()) < 8000
