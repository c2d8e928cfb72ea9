import re

import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import ODD, rows_of
from twinview.llm import lines

COLUMNS = ("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@pytest.mark.parametrize(("docs", "share"), [(2, 0.0), (1, 0.2), (50, 0.01)])
def test_counts_and_verdicts_equal_brute_force(spark, documents, docs, share):
    shared = "Shared line %d of the host\n"
    rows = [(r.doc_id, r.source, r.text) for r in documents.collect()]
    rows += [(10_000 + i, "src0", shared % i + "own words here are enough to stay in the corpus %d\n" % i + "menu | home\n" * (i % 3)) for i in range(12)]
    rows += [(20_000 + i, "src1", "\n".join([f"line of all {j}" for j in range(i % 9 + 3)])) for i in range(15)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    found = lines.quality(df, line_docs=docs, line_share=share)
    expected = brute.quality(rows, docs, share, lines.KEPT_SHARE)
    assert rows_of(found, *COLUMNS) == sorted(expected)
    assert any(not r[-1] and not r[-2] for r in expected) or docs == 50


def test_copies_are_one_document(spark):
    rows = [(i, "h", "the very same line of words that was copied here quite often") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert {r.kept for r in lines.quality(df, line_docs=1, line_share=0.0).collect()} == {True}


def test_copies_and_blank_texts_do_not_hide_a_line(spark):
    rows = [(i, "h", f"all of the menu stands here in one line of its own\nown {i}") for i in range(4)]
    rows += [(100 + i, "h", "some other text that is copied a great many times here") for i in range(40)] + [(200 + i, "h", " \n") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = lines.quality(df, line_docs=3, line_share=0.5)
    assert rows_of(found, *COLUMNS) == sorted(brute.quality(rows, 3, 0.5, lines.KEPT_SHARE))
    assert {r.doc.doc_id for r in found.where("n_boilerplate > 0").collect()} == {0, 1, 2, 3}


def test_odd_rows(odd, empty):
    rows = [(d, s, t) for d, t, s in [*ODD, ODD[0], ODD[2], ODD[8]]]
    found = lines.quality(odd, line_docs=1, line_share=0.0)
    assert rows_of(found, *COLUMNS) == sorted(brute.quality(rows, 1, 0.0, lines.KEPT_SHARE))
    assert rows_of(found, "doc.n_words", "doc.line", "doc.content") == [("own n_words", "own line", "own content")] * len(rows)
    assert lines.quality(empty).count() == 0


def test_lines_above_the_limit_are_left_out(spark, empty):
    menu, notice = "Home | About | Contact 20%d", "we use cookies\there"
    own = [f"text {i} {chr(97 + i)} has these very own words in one long line" for i in range(12)]
    texts = [f"{menu % i}\n{x}\n\n{notice.upper() if i % 2 else notice}" for i, x in enumerate(own)]
    texts += [f"{own[0]} \r\n{menu % 5}\nlast é line\n", f"\n{notice}\n{notice}\n{own[1]} once more", own[2] + " alone", "", None, menu % 3]
    rows = [(i, "h", t, -1) for i, t in enumerate(texts)] + [(0, "h", texts[0], -1), (None, "h", texts[1], -1), (90, None, texts[0], -1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars long").repartition(3)

    def normal(line):
        return re.sub("[0-9]+", "0", " ".join(brute.words(line.lower())))

    often = {normal(menu % 0), normal(notice)}
    expected = [(d, None if t is None else "\n".join(x for x in t.split("\n") if s is None or normal(x) not in often)) for d, s, t, _ in rows]
    found = lines.quality(df, line_docs=5, line_share=0.0, as_text=True)
    assert rows_of(found, "doc.doc_id", "cleaned") == sorted(expected, key=lambda r: [(v is None, v) for v in r])
    assert lines.quality(empty, as_text=True).count() == 0


def test_the_pipeline_goes_on_without_them(spark):
    def letters(i):
        return "".join(chr(97 + i // 26**k % 26) for k in range(3))

    own = {i: " ".join(f"{letters(i)}{letters(j)}" for j in range(20)) for i in range(lines.LINE_DOCS + 10)}
    rows = [(i, f"we use cookies here\n{x}\nall rights reserved", "h", len(x) + 40) for i, x in own.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = corpus_pipeline.quality(spark, docs, "")
    assert found.columns == docs.columns
    assert rows_of(found, "*") == [(i, x, "h", len(x)) for i, x in sorted(own.items())]
