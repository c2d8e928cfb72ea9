import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import sha256
from tests.llm.conftest import SF_DIR, rows_of
from twinview.llm import chunks, transducer
from twinview.llm.pieces import default_model, processor


def fuzz(seed):
    rng = random.Random(seed)
    signs = "aeth rn▁ 　é1203<s>\n\t中の😀\x00ÿß--==__ABC"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(70))) for _ in range(400)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzthein ") for _ in range(rng.randrange(1500))) for _ in range(40)]
    return [*texts, "", " ", "▁", "a" * 3000, "=-" * 700, " " * 999, "x" + " " * 777 + "y", "中" * 900]


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_are_those_of_the_library(seed):
    texts = fuzz(seed)
    counts = transducer.counted([t.encode() for t in texts], default_model())
    assert counts.tolist() == [len(x) for x in processor(default_model()).encode(texts)]


def test_transitions_are_forgotten_beyond_the_bound(monkeypatch):
    machine = transducer.Transducer(default_model())
    monkeypatch.setattr(transducer, "KEPT_TRANSITIONS", 50)
    monkeypatch.setattr(transducer, "transducer", lambda path: machine)
    for seed in range(3):
        texts = fuzz(seed)[:150]
        counts = transducer.counted([t.encode() for t in texts], default_model())
        assert counts.tolist() == [len(x) for x in processor(default_model()).encode(texts)]


def test_chunk_length_does_not_matter(monkeypatch):
    texts = [t.encode() for t in fuzz(5)]
    expected = transducer.counted(texts, default_model())
    for length in (1, 3, 17, 1000):
        monkeypatch.setattr(transducer, "CHUNK", length)
        assert np.array_equal(transducer.counted(texts, default_model()), expected)


def test_counts_of_odd_rows(odd, empty):
    model = processor(default_model())
    texts = [r.text for r in odd.select("text").collect()]
    expected = sorted((len((t or "").encode()), len(model.encode(t or ""))) for t in texts)
    found = transducer.count_tokens(odd)
    assert rows_of(found, "n_bytes", "n_tokens") == expected and set(odd.columns) < set(found.columns)
    assert transducer.count_tokens(empty).count() == 0
    again = transducer.count_tokens(found.withColumn("n_tokens", F.lit("own")))
    assert rows_of(again, "n_bytes", "n_tokens") == expected


def test_ids_and_decoded_texts_are_those_of_the_library():
    model, texts = processor(default_model()), fuzz(3)
    for part in (texts[:200], texts[200:], texts):
        ids = model.encode(part)
        assert chunks._encoded(pa.array(part, pa.string()), default_model()).to_pylist() == ids
        decoded = chunks._decoded(pa.array(ids, pa.list_(pa.int32())), chunks._surface(default_model()))
        assert decoded.to_pylist() == [model.decode(x) for x in ids]


def test_a_word_is_segmented_once_a_task(monkeypatch):
    plain, asked = chunks._segmented, []
    monkeypatch.setattr(chunks, "_segmented", lambda words, path: asked.extend(words) or plain(words, path))
    model, texts, table = processor(default_model()), fuzz(6), chunks._Table(default_model())
    for a in range(0, len(texts), 20):
        part = pa.array(texts[a : a + 20], pa.string())
        assert chunks._encoded(part, default_model(), table).to_pylist() == model.encode(texts[a : a + 20])
    assert len(asked) == len(set(asked)) == len(table.places) and table.held == sum(map(len, asked))


@pytest.mark.parametrize("bound", [{"TABLE_WORDS": 30}, {"TABLE_BYTES": 400}, {"TABLE_WORDS": 0}])
def test_a_table_over_its_bound_begins_anew(monkeypatch, bound):
    for name, value in bound.items():
        monkeypatch.setattr(chunks, name, value)
    model, texts, table = processor(default_model()), fuzz(7), chunks._Table(default_model())
    for a in range(0, len(texts), 3):
        part = pa.array(texts[a : a + 3], pa.string())
        assert chunks._encoded(part, default_model(), table).to_pylist() == model.encode(texts[a : a + 3])
        assert len(table.places) <= max(bound.get("TABLE_WORDS", 1 << 18), sum(len(t) + 1 for t in texts[a : a + 3]))


def test_encoding_of_odd_rows(odd, empty):
    model = processor(default_model())
    both = chunks.decode(chunks.encode(odd))
    for row in both.collect():
        ids = model.encode(row.text or "")
        assert row.ids == ids and row.decoded == model.decode(ids) and row.value == "own value"
    assert both.count() == odd.count()
    assert chunks.decode(chunks.encode(empty)).count() == 0
    replaced = chunks.decode(chunks.encode(odd, ids="doc"), ids="doc", text="kept")
    assert rows_of(replaced, "doc", "kept") == rows_of(both, "ids", "decoded")


def test_queries_equal_the_library(spark, documents):
    model = processor(default_model())
    counts, digests = [], []
    for row in documents.collect():
        ids = model.encode(row.text or "")
        counts.append((row.doc_id, len((row.text or "").encode()), len(ids), len(ids) > 4096))
        digests.append((row.doc_id, len(ids), sha256(",".join(map(str, ids))), sha256(model.decode(ids))))
    found = transducer.op1_transducer_counts(spark, SF_DIR)
    assert rows_of(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(counts)
    found = chunks.op7_chunk_table(spark, SF_DIR)
    assert rows_of(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(digests)


def test_checked_encoding_is_encode_and_decode(odd, empty, monkeypatch):
    both = chunks.decode(chunks.encode(odd)).selectExpr("doc_id", "ids", "decoded = coalesce(text, '') AS same")
    checked = chunks.encode_checked(odd.withColumn("round_trip", F.lit("own")), ["doc_id", "source", "round_trip"])
    assert checked.columns == ["doc_id", "source", "ids", "round_trip"]
    assert rows_of(checked, "doc_id", "ids", "round_trip") == rows_of(both, "doc_id", "ids", "same")
    assert chunks.encode_checked(empty, ["doc_id"]).count() == 0
    with_text = chunks.encode_checked(odd, ["doc_id", "text"])
    assert rows_of(with_text, "doc_id", "text") == rows_of(odd, "doc_id", "text")


def test_decoding_in_small_slices_is_the_same(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"i": [1, 2, 3, 4], "ids": pa.array([[1] * 5, None, [], [2, 3]], pa.list_(pa.int32()))})
    monkeypatch.setattr(chunks, "PIECE_IDS", 4)
    parts = list(chunks._by_ids(iter([batch]), "ids"))
    assert [p.column("i").to_pylist() for p in parts] == [[1], [2, 3, 4]]
