import hashlib
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.brute import sha256
from tests.llm.conftest import rows_of
from twinview.llm import middle


def plain_version(doc_id, text, seed=1):
    """(n, form, prefix_chars, middle_chars, output) by slicing the list of units."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


MORE = [(100 + i, t) for i, t in enumerate(
    ["<P>", "a <S> b", "<M", "<P<S<M><", "><P", "P><S>M", "<" * 50, "a", "ab", "é", "😀" * 7, "\x00\x00", "aé" * 99, "x" * 500])]


def test_odd_rows_as_by_slicing_and_back(spark, odd):
    more = spark.createDataFrame([(None, "no id, but a text"), (None, None), *MORE, *((i, f"text number {i}. <P") for i in range(200, 320))], "doc_id long, text string")
    rows = odd.withColumn("output", F.lit("own output")).withColumn("form", F.lit("own form")).unionByName(more, allowMissingColumns=True)
    made = middle.fill_in_middle(rows)
    assert "own doc" in [r.doc for r in made.select("doc").collect()] and made.columns.count("output") == 1
    back = middle.restored(made.drop("text")).collect()
    texts = rows.collect()
    assert len(back) == len(texts)
    expected = sorted((r.doc_id is None, r.doc_id, *plain_version(r.doc_id, r.text)) for r in texts)
    assert sorted((r.doc_id is None, r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back) == expected
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in back) == sorted((r.doc_id is None, r.doc_id, r.text or "") for r in texts)
    assert {r.form for r in back} == {"plain", "psm", "spm"}


def test_digests_are_of_output_and_restored_text(documents):
    found = rows_of(middle.fill_in_middle(documents, digests=True), "doc_id", "output_sha256", "restored_sha256")
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    assert found == sorted((i, sha256(plain_version(i, t)[4]), sha256(t)) for i, t in texts.items())


def test_no_rows_give_no_rows(empty):
    assert middle.fill_in_middle(empty).count() == 0
    assert middle.restored(middle.fill_in_middle(empty)).count() == 0


def test_rates_and_seed(spark):
    docs = spark.createDataFrame([(i, "one two three") for i in range(50)], "doc_id long, text string")
    assert {r.form for r in middle.fill_in_middle(docs, transformed=0).collect()} == {"plain"}
    assert {r.form for r in middle.fill_in_middle(docs, transformed=100, spm=100).collect()} == {"spm"}
    assert rows_of(middle.fill_in_middle(docs, seed=2), "doc_id", "output") == [(i, plain_version(i, "one two three", 2)[4]) for i in range(50)]


@given(st.binary(max_size=40), st.integers(0, 40), st.integers(0, 40), st.integers(0, 40))
def test_rotation_exchanges_segments(data, a, b, c):
    a, b, c = sorted(min(x, len(data)) for x in (a, b, c))
    if not data:
        return
    buffer = bytearray(data)
    middle.rotate(buffer, a, b, c)
    assert bytes(buffer) == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_long_text_in_windows(monkeypatch):
    """Units across the bounds of windows, and reversals of many steps, are as in one go."""
    monkeypatch.setattr(middle, "WINDOW", 7)
    monkeypatch.setattr(middle, "STEP", 3)
    text = "letters é😀 and ... " * 30 + "x" * 40 + "中" * 20
    data = np.frombuffer(text.encode(), np.uint8)
    units, found = middle.Units(data), re.findall("[A-Za-z]+|[^A-Za-z]", text)
    assert len(units) == len(found) and middle.characters(data) == len(text)
    for k in range(len(found) + 1):
        assert units.end(k) == len("".join(found[:k]).encode())
    for form in ("psm", "spm"):
        buffer = bytearray(data)
        middle.transform(buffer, form, units.end(11), units.end(300))
        assert len(buffer) == len(data) + 9
        middle.restore(buffer, form)
        assert bytes(buffer) == bytes(data)


def test_text_of_some_megabytes(spark):
    docs = spark.createDataFrame([(i, "word, " * 500_000) for i in (4, 5, 6)], "doc_id long, text string")
    assert rows_of(middle.restored(middle.fill_in_middle(docs)), "doc_id", "length(text)") == [(i, 3_000_000) for i in (4, 5, 6)]


def test_a_missing_sentinel_is_an_error():
    with pytest.raises(ValueError):
        middle.restore(bytearray(b"no sentinel"), "psm")
