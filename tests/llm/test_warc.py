import hashlib
import random

import pytest

from tests.llm.conftest import rows_of
from twinview.llm import warc


def pages_of(seed=1):
    rng = random.Random(seed)
    signs = "ab <p>é中😀\r\n\r\n0\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/ b", None), (2, None, ""), (3, "http://c\r\nX: y", "short"), (3, "http://c", "short"), (None, "u", "z" * 1500), (8, "u", "z" * 1500), (4, "http://d", "z" * 1500)]
    rows += [(9, "w", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n" * 60)] * 2
    rows += [(20 + i, f"http://x/{i}", "".join(rng.choice(signs) for _ in range(rng.choice([10, 999, 1000, 4096, 30_000])))) for i in range(25)]
    return rows + [(100 + i, f"http://y/{i}", rows[-1 - i % 3][2]) for i in range(9)] + [(-7, "big", "中文" * 60_000)]


def expected_of(rows, least=1000):
    last = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            last[data] = max(page, last.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        original = last.get(data)
        revisit = page is not None and original is not None and page < original
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=lambda r: [(v is None, v) for v in r])


def read_back(spark, path):
    return warc.read(spark, path).selectExpr(
        "try_cast(split_part(record_id, ':', 3) AS long) AS page_id", "coalesce(octet_length(payload), stated_bytes)",
        "coalesce(sha1(payload), digest)", "record_type", "try_cast(split_part(refers_to, ':', 3) AS long)")


@pytest.mark.parametrize(("segment", "chunk"), [(warc.SEGMENT_BYTES, warc.CHUNK_BYTES), (700, 64), (100, 9)])
def test_pages_come_back(spark, tmp_path, segment, chunk):
    rows = pages_of()
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, payload string").repartition(4)
    warc.write(df, str(tmp_path / "w"), segment, chunk)
    assert rows_of(read_back(spark, str(tmp_path / "w")), "*") == expected_of(rows)
    digests = warc.read(spark, str(tmp_path / "w")).where("record_type = 'response'").where("sha1(payload) != digest")
    assert digests.count() == 0


def test_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(df, str(tmp_path / "w"))
    assert warc.read(spark, str(tmp_path / "w")).count() == 0


def test_records_with_missing_segments_have_no_payload(spark):
    head = ("r", "response", "u", None, None)
    schema = warc._schema(warc._SEGMENT)
    whole = [(*head, "a", 1, None, b"xx"), (*head, "a", 2, None, b"yy"), (*head, "a", 3, 5, b"z"), (*head, "a", 2, None, b"yy")]
    wrong_length = [(*head, "b", 1, None, b"xx"), (*head, "b", 2, 5, b"yy")]
    gap = [(*head, "c", 1, None, b"xx"), (*head, "c", 3, 4, b"yy")]
    no_end = [(*head, "d", 1, None, b"xx")]
    found = warc.reassemble(spark.createDataFrame([*whole, *wrong_length, *gap, *no_end], schema)).select("blocks").collect()
    assert sorted(b"".join(r.blocks) if r.blocks else b"" for r in found) == [b"", b"", b"", b"xxyyz"]


def test_plain_and_many_member_archives_are_read():
    import gzip

    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 7\r\n\r\na\r\n\r\nbc\r\n\r\n"
    for content in (record * 3, gzip.compress(record * 3), gzip.compress(record) * 3):
        assert [b for _, b in warc.parse(content)] == [b"a\r\n\r\nbc"] * 3
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse(record[:-8]))
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse(b"HTTP/1.1 200 OK\r\n\r\n"))
