"""WARC archives written and read as Spark tables of records, with segmented payloads.

Writing: pages with equal payloads are found by SHA-1 (only ids and digests are grouped); the one
with the largest id is a response, the others revisit it. A record's block over ``segment_bytes``
is written as a first record and continuation records. Spark's text writer makes the gzip files,
with the end of a record as line separator, so that a lost task's files are written anew.

Reading: each archive is unpacked and parsed as a stream. Whole records are decoded on the spot.
Segments are grouped by the identifier of their origin, put in order, held against the total
length that the last one states, and then decoded like any other. The chunked transfer framing of
the HTTP body is taken off last, as its chunks may cross segments.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.session import new_table_dir

# Marks of the format (fixed values).
VERSION = "WARC/1.1"
LINE = b"\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

MIN_REVISIT = 1000  # bytes of a payload that may be revisited
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
DATE = "2024-01-01T00:00:00Z"
FILE_RECORDS = 20_000
_YIELD_BYTES = 4 << 20
_READ_BYTES = 1 << 20


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Consecutive parts of at most ``size`` bytes that end between characters."""
    at = 0
    while at < len(data):
        to = min(at + size, len(data))
        while to < len(data) and to > at + 1 and data[to] & 0xC0 == 0x80:
            to -= 1
        yield data[at:to]
        at = to


def _header(fields: list[tuple[str, object]], length: int) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields), f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + END.encode()


def _records(row: dict, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of one page, each without the end mark."""
    payload = row["payload"]
    fields = [("WARC-Type", "revisit" if row["refers_to"] else "response"), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", DATE)]
    if row["uri"] is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in row["uri"])))
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if row["refers_to"]:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{row['refers_to']}>")]
        block = HTTP + b"Content-Length: %d" % len(payload) + END.encode()
        yield _header(fields, len(block)) + block
        return
    framed = [b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(payload, chunk_bytes)]
    block = HTTP + b"Transfer-Encoding: chunked" + END.encode() + b"".join(framed) + b"0" + END.encode()
    if len(block) <= segment_bytes:
        yield _header(fields, len(block)) + block
        return
    parts = list(_cuts(block, segment_bytes))
    for n, part in enumerate(parts, 1):
        own = [*fields, ("WARC-Segment-Number", 1)]
        if n > 1:
            own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{row['record_id']}:segment:{n}>"), ("WARC-Date", DATE),
                   ("WARC-Segment-Number", n), ("WARC-Segment-Origin-ID", f"<{row['record_id']}>")]
        if n == len(parts):
            own.append(("WARC-Segment-Total-Length", len(block)))
        yield _header(own, len(part)) + part


def with_originals(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Rows (page_id, uri, payload, digest, record_id, refers_to) of pages (page_id, url, html).

    Ids and digests alone decide which pages revisit which; the payloads then meet that by id, so
    that a payload shared by a third of all pages doesn't gather them in one task.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", F.col("url").alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    narrow = rows.where((F.octet_length("payload") >= min_bytes) & F.col("page_id").isNotNull()).select("page_id", "digest")
    originals = narrow.groupBy("digest").agg(F.max("page_id").alias("original"), F.min("page_id").alias("_least"))
    originals = originals.where("original > _least").drop("_least")
    revisits = narrow.join(originals, "digest").where("page_id < original").distinct()
    rows = rows.join(revisits, ["page_id", "digest"], "left")
    copy = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("uri"))
    name = F.concat_ws(":", F.lit("urn:page"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "digest", copy.cast("string"))
    original = F.concat_ws(":", F.lit("urn:page"), F.col("original").cast("string"), "digest", F.lit("1"))
    return rows.select("page_id", "uri", "payload", "digest", name.alias("record_id"),
                       F.when(F.col("original").isNotNull(), original).alias("refers_to"))


def write(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
          min_bytes: int = MIN_REVISIT) -> None:
    """Archives of ``pages`` (page_id, url, html) at ``path``, one record per row or more.

    A null html is an empty payload and a null url no target. Rows of one page_id and payload are
    records of their own; only smaller ids revisit a larger one, so repeats of the largest id are
    all responses, and so are rows without a page_id. Other columns are left out. An empty table
    gives archives without pages.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        about = b"software: twinview" + LINE
        fields = [("WARC-Type", "warcinfo"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")]
        out, size = [_header(fields, len(about)) + about], 0
        for batch in batches:
            for first in range(batch.num_rows):
                for record in _records(batch.slice(first, 1).to_pylist()[0], segment_bytes, chunk_bytes):
                    out.append(record)
                    size += len(record)
                if size >= _YIELD_BYTES:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
        if size:
            yield pa.record_batch([pa.array(out, pa.binary())], ["value"])

    rows = with_originals(pages, min_bytes).mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS).mode("append").text(path)


class _Stream:
    """Bytes of an unpacked archive, taken from the front."""

    def __init__(self, content: bytes):
        self.content, self.at, self.buffer = memoryview(content), 0, bytearray()
        self.unpack = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.unpack and self.unpack.eof:  # the next member
            left = self.unpack.unused_data
            self.at -= len(left)
            self.unpack = zlib.decompressobj(31)
        if self.at >= len(self.content):
            return False
        part = self.content[self.at : self.at + _READ_BYTES]
        self.at += len(part)
        self.buffer += self.unpack.decompress(part) if self.unpack else part
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the next mark, which is taken too; None at the end."""
        seen = 0
        while (where := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                return None
        return self.take(where + len(mark))[: -len(mark)]

    def take(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.buffer[:size])
        del self.buffer[:size]
        return out


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    stream = _Stream(content)
    while (head := stream.until(END.encode())) is not None:
        version, *lines = head.lstrip(LINE).decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record begins with {version[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        yield fields, stream.take(int(fields["content-length"]))
        stream.until(END.encode())


def body(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of an HTTP response, the chunked framing taken off."""
    head, _, rest = block.partition(END.encode())
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    if fields.get("transfer-encoding", "").lower() != "chunked":
        return fields, rest
    out, at = [], 0
    while True:
        to = rest.index(LINE, at)
        size, at = int(rest[at:to].partition(b";")[0], 16), to + len(LINE)
        if size == 0:
            return fields, b"".join(out)
        out.append(rest[at : at + size])
        at += size
        if len(out[-1]) < size or rest[at : at + 2] != LINE:
            raise ValueError("a chunk is cut off")
        at += len(LINE)


_HEAD = [("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("digest", pa.string())]
_SEGMENT = [*_HEAD, ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]
_DECODED = [*_HEAD, ("stated_bytes", pa.int64()), ("payload", pa.binary())]


def _bare(name: str | None) -> str | None:
    return name and name.strip("<>")


def _decoded(head: tuple, block: bytes | None) -> tuple:
    if block is None:
        return (*head, None, None)
    fields, payload = body(block)
    stated = int(fields["content-length"]) if "content-length" in fields else len(payload)
    return (*head, stated, payload if head[1] != "revisit" else None)


def _batches(rows: Iterator[tuple], schema: list) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += 200 + len(row[-1] or b"")
        if size >= _YIELD_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), schema)], [n for n, _ in schema])
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), schema)], [n for n, _ in schema])


def _schema(fields: list) -> T.StructType:
    kinds = {pa.string(): T.StringType(), pa.int32(): T.IntegerType(), pa.int64(): T.LongType(), pa.binary(): T.BinaryType()}
    return T.StructType([T.StructField(n, kinds[t]) for n, t in fields])


def _read(archives: DataFrame, segmented: bool) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                for fields, block in parse(batch.column("content")[i].as_py()):
                    kind = fields.get("warc-type")
                    if kind not in ("response", "revisit", "continuation") or ("warc-segment-number" in fields) != segmented:
                        continue
                    digest = fields.get("warc-payload-digest", "")
                    hexed = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
                    head = (_bare(fields["warc-record-id"]), kind, fields.get("warc-target-uri"), _bare(fields.get("warc-refers-to")), hexed)
                    if segmented:
                        total = fields.get("warc-segment-total-length")
                        origin = _bare(fields.get("warc-segment-origin-id")) or head[0]
                        yield (*head, origin, int(fields["warc-segment-number"]), total and int(total), block)
                    else:
                        yield _decoded(head, block)

    schema = _SEGMENT if segmented else _DECODED
    return archives.mapInArrow(lambda batches: _batches(rows(batches), schema), _schema(schema))


def reassemble(segments: DataFrame) -> DataFrame:
    """One row for each origin of (origin, number, total, block, ...): its head and whole block.

    The block is null unless the numbers run from 1 on, the last segment states a total length
    and that is the length of all together. Repeated segments count once. A group is one record.
    """
    part = F.struct("number", "block", "total", *(n for n, _ in _HEAD))
    found = segments.groupBy("origin").agg(F.array_sort(F.collect_set(part)).alias("parts"))
    last = F.element_at("parts", -1)
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    good = (F.element_at("parts", 1)["number"] == 1) & (last["number"] == F.size("parts")) & (last["total"] == length)
    first = F.element_at("parts", 1)
    return found.select(*(first[n].alias(n) for n, _ in _HEAD), F.when(good, F.col("parts")["block"]).alias("blocks"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of the archives at ``path``, their payloads reassembled and unframed.

    Columns record_id, record_type, uri, refers_to, digest (as the record states it), stated_bytes
    and payload (null for revisits, and for records whose segments are not all there).
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                *head, blocks = batch.slice(i, 1).to_pylist()[0].values()
                yield _decoded(tuple(head), b"".join(blocks) if blocks is not None else None)

    whole = _read(archives, segmented=False)
    joined = reassemble(_read(archives, segmented=True))
    return whole.unionByName(joined.mapInArrow(lambda batches: _batches(rows(batches), _DECODED), _schema(_DECODED)))


def op4_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    path = new_table_dir(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    records = read(spark, path)

    def page(name: str) -> F.Column:
        return F.split_part(name, F.lit(":"), F.lit(3)).try_cast("long")

    return records.select(
        page(F.col("record_id")).alias("page_id"),
        F.when(F.col("record_type") == "revisit", F.col("stated_bytes")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.col("digest")).otherwise(F.sha1("payload")).alias("payload_digest"),
        "record_type",
        page(F.col("refers_to")).alias("refers_to"))


ORACLE = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
q AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < original THEN original END AS refers_to
FROM q"""
