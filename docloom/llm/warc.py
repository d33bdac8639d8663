"""WARC archives of pages: written, read back, and put together as captures.

A capture is a request, a response (or a revisit, where the payload is stored
elsewhere) and a metadata record.  The response has an id of its own; the other two name it
as concurrent to themselves.  Assembly joins the three kinds of records over these
identifiers and gives one nested row per capture.

Archives are written by Spark's text writer with the record separator as line separator:
one compressed file per task, committed as any table is.  They are read one file at a time
in the task that parses them, record after record by Content-Length, so that a payload may
hold anything.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import cut_lineage, read, shared_path

VERSION = "WARC/1.0"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Payloads from this size on become revisits of an equal one.
MIN_REVISIT_BYTES = 0
#: A file is read as one row: records per file keep it small.
RECORDS_PER_FILE = 10_000
_LINE = "\r\n"

RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes bigint, fields map<string,string>, payload binary"
)
_NAMES = [x.split()[0] for x in RECORD.split(", ")]


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of a SHA-1: 40 hexadecimal digits are eight groups of 20 bits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digest = F.sha1(data)
    out = []
    for at in range(1, 41, 5):
        group = F.conv(F.substring(digest, at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(group, shift).bitwiseAND(31)
            out.append(F.substring(F.lit(letters), place + 1, F.lit(1)))
    return F.concat(*out)


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """One record without the separator that ends it."""
    lines = [F.lit(VERSION + _LINE)]
    for name, value in headers:
        text = F.lit(value) if isinstance(value, str) else value
        # A header with a NULL value is left out.
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), text, F.lit(_LINE)), F.lit("")))
    size = F.octet_length(block).cast("string")
    head = F.concat(*lines, F.lit("Content-Length: "), size, F.lit(_LINE + _LINE))
    return F.concat(head.cast("binary"), block).cast("string")


def _uri(url: Column) -> Column:
    """An address that fits on a header line."""
    return F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20")


def decisions(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(_digest, _page, keeper): pages whose payload a page with a larger id holds; ``_page`` is never null."""
    digests = pages.where(F.octet_length("_payload") >= min_bytes).select("page_id", "_page", "_digest")
    keepers = digests.groupBy("_digest").agg(F.max("page_id").alias("keeper"))
    return (
        digests.distinct().join(keepers, "_digest")
        .where(F.col("keeper").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper"))))
        .select("_digest", "_page", "keeper")
    )


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES,
    page_id: str = "page_id", url: str = "url", html: str = "html",
) -> None:
    """Archives of ``pages`` below ``path``: a request, a response or revisit, and a metadata record a row.

    The payload is the html in UTF-8, empty for null.  Of equal payloads of ``min_bytes`` or
    more the one with the largest page_id is a response, the others revisit it; rows that
    share that id are all responses.  A row without page_id is smaller than any other and
    a response if no equal payload has an id.  Repeated rows are captures of their own.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("_payload"),
        F.coalesce(F.col(page_id).cast("string"), F.lit("-")).alias("_page"),
    ).withColumn("_digest", F.sha1("_payload"))
    # Join and window have one key, so payloads are shuffled once.
    found = rows.join(decisions(rows, min_bytes), ["_digest", "_page"], "left")
    # Rows that repeat a page are numbered; a page's first is the one that others refer to.
    order = Window.partitionBy("_digest", "_page").orderBy("url")
    found = found.withColumn("_n", F.row_number().over(order))
    named = lambda page, n: F.concat(F.lit("<urn:page:"), page, F.lit(":"), "_digest", F.lit(":"), n, F.lit(">"))
    own = named(F.col("_page"), F.col("_n").cast("string"))
    part = lambda name: F.concat(F.substring_index(own, ">", 1), F.lit(f":{name}>"))
    size = F.octet_length("_payload").cast("string")
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("_payload")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_LINE}Content-Type: text/html; charset=utf-8{_LINE}Content-Length: "), size,
        F.lit(_LINE + _LINE),
    ).cast("binary")
    again = F.col("keeper").isNotNull()
    common = [("WARC-Date", DATE), ("WARC-Target-URI", _uri(F.col("url")))]
    response = _record(
        [
            ("WARC-Type", F.when(again, "revisit").otherwise("response")), ("WARC-Record-ID", own), *common,
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(again, F.lit(PROFILE))),
            ("WARC-Refers-To", F.when(again, named(F.col("keeper").cast("string"), F.lit("1")))),
            ("Content-Type", "application/http;msgtype=response"),
        ],
        F.concat(http, F.when(again, F.lit("").cast("binary")).otherwise(F.col("_payload"))),
    )
    request = _record(
        [
            ("WARC-Type", "request"), ("WARC-Record-ID", part("request")), *common, ("WARC-Concurrent-To", own),
            ("Content-Type", "application/http;msgtype=request"),
        ],
        F.concat(F.lit("GET "), F.coalesce(_uri(F.col("url")), F.lit("/")), F.lit(f" HTTP/1.1{_LINE}{_LINE}")).cast("binary"),
    )
    about = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(_LINE)), F.lit(""))
    metadata = _record(
        [
            ("WARC-Type", "metadata"), ("WARC-Record-ID", part("metadata")), *common, ("WARC-Concurrent-To", own),
            ("Content-Type", "application/warc-fields"),
        ],
        about.cast("binary"),
    )
    records = found.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", _LINE + _LINE).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


def _inflate(data: bytes) -> bytes:
    """A gzip file of one member or of one for each record."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        one = zlib.decompressobj(31)
        out.append(one.decompress(data))
        out.append(one.flush())
        data = one.unused_data
    return b"".join(out)


def _headers(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def _parsed(data: bytes, payloads: bool) -> Iterator[tuple]:
    at = 0
    while True:
        at = data.find(b"WARC/", at)
        if at < 0:
            return
        head_end = data.find(b"\r\n\r\n", at)
        if head_end < 0:
            return
        head = _headers(data[at:head_end])
        begin = head_end + 4
        size = int(head.get("content-length", "0"))
        end = begin + size
        kind = head.get("warc-type", "")
        fields: dict[str, str] = {}
        start = begin
        if "application/http" in head.get("content-type", ""):
            gap = data.find(b"\r\n\r\n", begin, end)
            if gap >= 0:
                fields, start = _headers(data[begin:gap]), gap + 4
        elif "warc-fields" in head.get("content-type", ""):
            fields = _headers(data[begin:end])
        body = memoryview(data)[start:end]
        if kind == "response":
            digest, length = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
        else:
            digest = head.get("warc-payload-digest", "").rpartition(":")[2] or None
            length = int(fields["content-length"]) if kind == "revisit" and "content-length" in fields else len(body)
        yield (
            head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"),
            head.get("warc-target-uri"), digest, length, list(fields.items()), bytes(body) if payloads else None,
        )
        at = end


def _parse(payloads: bool):
    kinds = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                held, size = [], 0
                for record in _parsed(_inflate(content.as_py()), payloads):
                    held.append(record)
                    size += len(record[-1] or b"") + 500
                    if size > 8 << 20:
                        yield _batch(held, kinds)
                        held, size = [], 0
                if held:
                    yield _batch(held, kinds)

    return parse


def _batch(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=_NAMES)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archives below ``path``, in columns RECORD.

    ``payload_digest`` of a response is computed from the payload; a revisit's digest and
    size are those of the full payload, from its headers.
    """
    # One file a row, and a file a partition if files are large.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_parse(payloads), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """(capture_id, target_uri, request, response, metadata): one nested row for each capture.

    A capture is a response or revisit record.  Requests belong to the response they are
    concurrent to, metadata to the response or to its request.  Captures without a request
    or metadata have NULL there; several of a kind are reduced to the one with the
    smallest id.  Requests and metadata whose response is not there are left out.
    """
    whole = F.struct(*[F.col(c) for c in _NAMES])
    one = lambda kind: records.where(F.col("type") == kind)
    responses = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), "target_uri", whole.alias("response")
    )
    least = F.min_by(whole, "record_id")
    requests = one("request").groupBy(F.col("concurrent_to").alias("capture_id")).agg(least.alias("request"))
    by_request = one("request").select(F.col("record_id").alias("concurrent_to"), F.col("concurrent_to").alias("_via"))
    metadata = (
        one("metadata").join(by_request, "concurrent_to", "left")
        .groupBy(F.coalesce("_via", "concurrent_to").alias("capture_id")).agg(least.alias("metadata"))
    )
    return (
        responses.join(requests, "capture_id", "left").join(metadata, "capture_id", "left")
        .select("capture_id", "target_uri", "request", "response", "metadata")
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), path)
    captures = assemble(cut_lineage(read_archives(spark, path, payloads=False)))
    refers = F.regexp_extract("response.refers_to", r"^<urn:page:(-?[0-9]+):", 1)
    return captures.select(
        F.try_element_at("metadata.fields", F.lit("page-id")).cast("bigint").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(refers != "", refers.try_cast("bigint")).alias("refers_to"),
    )


def _sql_base32() -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    group = "('0x' || substr(h, {at}, 5))::INT"
    return " || ".join(
        f"substr({letters}, (({group.format(at=at)} >> {shift}) & 31) + 1, 1)"
        for at in range(1, 41, 5) for shift in (15, 10, 5, 0)
    )


SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT h, max(page_id) AS keeper FROM p GROUP BY h)
SELECT page_id, n AS payload_bytes, {_sql_base32()} AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN k USING (h)
"""
