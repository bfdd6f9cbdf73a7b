"""WARC archives: writing captures, reading them back, and assembling transactions.

A capture is three records: the request, the response (or a revisit, where an earlier record has the same payload) and a
metadata record; the first and the last name the second in WARC-Concurrent-To. Archives are written by Spark's text writer
with the four bytes that end a record as line separator, so a file is a sequence of records as it stands, and one lost
task rewrites one file. Files are read whole, record by record by their lengths; ``FILE_RECORDS`` bounds a file.

Transactions are put together by joining requests and metadata to responses and revisits through these identifiers. Of
several requests or metadata records of one capture the one with the smallest id counts.

Defined results: null html is an empty payload; null page_id and url are left out of the records and come back as null. Of
equal payloads the smallest page_id is the response, a null one only if there is no other; rows that repeat its page_id
and payload are responses, too. A table without rows gives none. Extra columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import join_small, settle
from millrace.session import fresh_path

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

DATE = "2026-01-01T00:00:00Z"
FILE_RECORDS = 2000  # captures per file
MIN_BYTES = 0  # smaller payloads are never revisits
HEADERS = "map<string,string>"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary in base32: 160 bits make 32 characters without padding."""
    digits = F.sha1(payload)
    out = []
    for group in range(8):  # five hex digits are four characters
        value = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _record(kind: str, headers: dict[str, Column], block: Column) -> Column:
    """One record without its end, as a binary; a header whose value is null is left out."""
    lines = [F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}\r\n")]
    for name, value in headers.items():
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END)))
    return F.concat(F.concat(*lines).cast("binary"), block)


def _urn(kind: str) -> Column:
    """The same for equal pages, so that a revisit can name the response without seeing it."""
    hexed = F.md5(F.concat_ws("|", F.lit(kind), F.col("id").cast("string"), F.col("digest")))
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES
) -> None:
    """Write a capture per row of ``pages`` below ``path``."""
    clean = F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"), clean.alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", base32_sha1(F.col("payload")))
    # Only payloads that are met again have a first page to look up.
    again = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "url")).alias("first"), F.count("*").alias("n")
    )
    again = settle(again.where("n > 1").select("digest", F.col("first.id").alias("first"), F.col("first.url").alias("first_url")), "again")
    known = again.withColumn("known", F.lit(True))
    rows = join_small(rows, known, "digest").withColumn(
        "revisit", F.col("known").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    )

    target, main = F.col("url"), _urn("capture")
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    request = _record(
        "request",
        {
            "WARC-Record-ID": _urn("request"),
            "WARC-Target-URI": target,
            "WARC-Concurrent-To": main,
            "Content-Type": F.lit("application/http; msgtype=request"),
        },
        F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(f" HTTP/1.1{END}")).cast("binary"),
    )
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
    ).cast("binary")
    shared = {
        "WARC-Record-ID": main,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": digest,
        "Content-Type": F.lit("application/http; msgtype=response"),
    }
    response = _record("response", shared, F.concat(head, F.col("payload")))
    first = F.md5(F.concat_ws("|", F.lit("capture"), F.col("first").cast("string"), F.col("digest")))
    parts = [F.substring(first, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    revisit = _record(
        "revisit",
        shared
        | {
            "WARC-Profile": F.lit(PROFILE),
            "WARC-Refers-To": F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")),
            "WARC-Refers-To-Target-URI": F.col("first_url"),
        },
        head,
    )
    fields = F.coalesce(F.concat(F.lit("pageId: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit(""))
    metadata = _record(
        "metadata",
        {
            "WARC-Record-ID": _urn("metadata"),
            "WARC-Target-URI": target,
            "WARC-Concurrent-To": main,
            "Content-Type": F.lit("application/warc-fields"),
        },
        fields.cast("binary"),
    )
    end = F.lit(END).cast("binary")
    capture = F.concat(request, end, F.when(F.col("revisit"), revisit).otherwise(response), end, metadata)
    rows.select(capture.cast("string").alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(path, compression="gzip")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, which may be compressed as a whole or
    record by record."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        begin = stop + 4
        at = begin + int(headers["content-length"])
        yield headers, data[begin:at]
        at += 4


def _payload(headers: dict[str, str], block: bytes) -> bytes | None:
    """The payload of a response: what follows the HTTP header."""
    if headers.get("warc-type") != "response":
        return None
    return block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: record_id, type, concurrent_to, refers_to, target_uri, headers, block (null for responses),
    payload, payload_bytes and payload_digest (of responses; the digest is computed, not copied).

    Without ``payloads`` the payload is measured and left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for headers, block in parse_records(data.as_py()):
                    payload = _payload(headers, block)
                    found = payload is not None
                    rows.append(
                        {
                            "record_id": headers.get("warc-record-id"),
                            "type": headers.get("warc-type"),
                            "concurrent_to": headers.get("warc-concurrent-to"),
                            "refers_to": headers.get("warc-refers-to"),
                            "target_uri": headers.get("warc-target-uri"),
                            "headers": list(headers.items()),
                            "block": None if found else block,
                            "payload": payload if found and payloads else None,
                            "payload_bytes": len(payload) if found else None,
                            "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if found else None,
                        }
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    text = pa.string()
    schema = pa.schema(
        [(name, text) for name in ("record_id", "type", "concurrent_to", "refers_to", "target_uri")]
        + [("headers", pa.map_(text, text)), ("block", pa.binary()), ("payload", pa.binary())]
        + [("payload_bytes", pa.int64()), ("payload_digest", text)]
    )
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        run,
        "record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
        f"headers {HEADERS}, block binary, payload binary, payload_bytes long, payload_digest string",
    )


def assemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit: record_id, type, target_uri, request, response and metadata (structs).

    A revisit's payload_bytes are those of the response it refers to, if that is among ``records``.
    """

    def beside(kind: str) -> DataFrame:
        some = records.where(F.col("type") == kind).where("concurrent_to IS NOT NULL")
        return some.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.min_by(F.struct("record_id", "headers", "block"), "record_id").alias(kind)
        )

    captures = records.where(F.col("type").isin("response", "revisit"))
    sizes = records.where("type = 'response'").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.max("payload_bytes").alias("referred_bytes")
    )
    # One response may have a large part of all revisits: a settled table lets the join split them.
    revisited = captures.where("refers_to IS NOT NULL").select("refers_to").distinct()
    sizes = settle(sizes.join(revisited, "refers_to", "left_semi"), "sizes")
    resolved = join_small(captures, sizes, "refers_to")
    stated = F.regexp_replace(F.element_at("headers", "warc-payload-digest"), "^sha1:", "")
    response = F.struct(
        "headers",
        "payload",
        F.coalesce("payload_bytes", "referred_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", stated).alias("payload_digest"),
        "refers_to",
    )
    main = resolved.select("record_id", "type", "target_uri", response.alias("response"))
    return main.join(beside("request"), "record_id", "left").join(beside("metadata"), "record_id", "left")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives, read them and assemble: page_id, payload_bytes, payload_digest, record_type,
    refers_to (a page_id)."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path)
    captures = settle(assemble(settle(read_archives(spark, path, payloads=False), "records")), "captures")
    page = F.regexp_extract(F.col("metadata.block").cast("string"), r"pageId: (-?\d+)", 1)
    rows = captures.select(
        F.when(page != "", page.cast("long")).alias("page_id"),
        "record_id",
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("response.refers_to").alias("to"),
    )
    named = rows.where("record_type = 'response'").select(F.col("record_id").alias("to"), F.col("page_id").alias("refers_to"))
    named = settle(named.join(rows.where("to IS NOT NULL").select("to").distinct(), "to", "left_semi").distinct(), "named")
    return join_small(rows, named, "to").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_CHARS = " || ".join(
    f"substr('{BASE32}', ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0)
)
SQL = f"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
named AS (SELECT page_id, payload_bytes, {_CHARS} AS payload_digest FROM hashed),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM named)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
"""
