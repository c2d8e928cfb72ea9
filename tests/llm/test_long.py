"""Texts longer than what is worked on at once, beside short ones, in every text operator."""

import random

import pytest

from tests.llm import brute
from tests.llm.conftest import rows_of
from twinview.llm import arrow, chunks, lines, middle, mix, near, repeats, suffixes, toxicity, transducer
from twinview.llm.pieces import default_model, processor

PASSAGE = " ".join(f"shared{i}" for i in range(60))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = [f"{rng.choice('abcdefgh')}{rng.randrange(40_000)}" for _ in range(780_000)]
    changed = [w if rng.random() > 0.01 else "other" for w in words]
    long, copy = " ".join([*words, PASSAGE]), " ".join(changed)
    assert len(long) > arrow.PIECE_BYTES
    return [(1, PASSAGE + " and a little more of it", "a"), (2, long, "a"), (3, copy, "b"), (4, "short", "b")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_tokens(docs, rows):
    model = processor(default_model())
    expected = {d: model.encode(t) for d, t, _ in rows}
    assert rows_of(transducer.count_tokens(docs), "doc_id", "n_tokens") == [(d, len(expected[d])) for d in sorted(expected)]
    checked = chunks.encode_checked(docs, ["doc_id"]).collect()
    assert all(r.round_trip and r.ids == expected[r.doc_id] for r in checked)


def test_near_duplicates(docs):
    assert rows_of(near.near_duplicates(docs, 2), "doc_id", "component_id") == [(1, 1), (2, 2), (3, 2), (4, 4)]


def test_mix(docs, rows):
    assert rows_of(mix.mix(docs), "doc.doc_id", "size") == [(d, len(brute.words(t))) for d, t, _ in rows]


def test_quality(docs, rows):
    found = rows_of(lines.quality(docs), "doc.doc_id", "n_words", "word_chars", "n_repeat_words")
    expected = brute.quality([(d, s, t) for d, t, s in rows], lines.LINE_DOCS, lines.LINE_SHARE, lines.KEPT_SHARE)
    assert found == sorted((v[0], v[1], v[2], v[5]) for v in expected)


def test_windows(docs, rows):
    expected = [(d, n, gone) for d, n, gone, _ in brute.repeats([(d, t) for d, t, _ in rows])]
    assert rows_of(repeats.remove_repeats(docs), "doc.doc_id", "n_words", "n_removed") == expected


def test_strings(docs, rows):
    expected = [(d, n, gone) for d, n, gone, _, _ in brute.cut([(d, t) for d, t, _ in rows])]
    assert rows_of(suffixes.cut_repeats(docs), "doc.doc_id", "n_bytes", "n_removed") == expected


def test_toxicity_at_the_end_of_a_text(spark, docs, rows):
    channel = toxicity.fit_channel(docs)
    more = docs.union(spark.createDataFrame([(5, rows[1][1] + " you are s t u p i d", "a")], docs.schema))
    found = {r.doc_id: r.score for r in toxicity.score(more, channel, {"stupid": 9.0}, -3.0).collect()}
    assert found[5] > 0.9 > 0.1 > max(found[i] for i in (1, 2, 3, 4))


def test_fill_in_middle(docs, rows):
    assert rows_of(middle.restored(middle.fill_in_middle(docs, transformed=100)), "doc_id", "text") == [(d, t) for d, t, _ in rows]
