import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import ODD, SF_DIR
from twinview.llm import lines, mix
from twinview.llm.pieces import default_model


def cut_texts(rows, length=100):
    """Rows (doc_id, text) without repeated strings, and whether anything was cut."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(data[i : i + length])
        out[doc] = (bytes(c for c, g in zip(data, gone) if not g).decode(errors="ignore") if any(gone) else text, any(gone))
    return out


def plain(rows):
    """The first three stages on (doc_id, text, source), as {doc_id: text}."""
    verdicts = brute.quality([(d, s, t) for d, t, s in rows], lines.LINE_DOCS, lines.LINE_SHARE, lines.KEPT_SHARE)
    good = {v[0] for v in verdicts if v[-1]}
    rows = [r for r in rows if r[0] in good]
    first = {d for d, _, _, kept in brute.near([(d, t) for d, t, _ in rows], 5) if kept}
    cut = cut_texts([(d, t) for d, t, _ in rows if d in first])
    return {d: t for d, (t, changed) in cut.items() if not changed or brute.words(t)}


def test_the_whole_pipeline(spark, documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    expected = plain(rows)
    model = sentencepiece.SentencePieceProcessor(model_file=default_model())
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in found} <= set(expected) and all(r.round_trip for r in found)
    assert all(r.ids == model.encode(expected[r.doc_id]) and r.n_tokens == len(r.ids) for r in found)
    # the mix of what is left decides how often a document is there
    left = spark.createDataFrame([(d, t, s) for (d, _, s) in rows if d in expected for t in [expected[d]]], "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mix.mix(left).select("doc.doc_id", "copies").collect()}
    times = {d: sum(r.doc_id == d for r in found) for d in expected}
    assert times == copies


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, documents, empty):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(40)), f"s{i % 3}") for i in range(100, 130)]
    rows += [*ODD, ODD[0], ODD[2], ODD[-1], *((i + 1000, t, s) for i, t, s in rows[:5]), (None, rows[0][1], "s1"), (None, rows[0][1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"lang": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"), "kept": F.lit("own"), "_id": F.lit(1)})
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before
    assert (docs.count() == 0) == empty


def test_an_id_of_several_texts_keeps_the_same_row(spark):
    rows = [(1, f"text {i} of this id " + " ".join(f"w{i}x{j}" for j in range(20)), s) for i in range(6) for s in ("a", None)]
    docs = spark.createDataFrame([*rows, *rows[:3]], "doc_id long, text string, source string")
    kept = [[tuple(r) for r in corpus_pipeline.near_dedup(spark, docs.repartition(n), SF_DIR).collect()] for n in (1, 7)]
    assert len(kept[0]) == 1 and kept[0] == kept[1] and kept[0][0] in rows
