"""WARC archives with revisit resolution.

Only headers (id, digest, length) are shuffled: they are grouped by payload
digest to find each digest's original response.  Digests that occur once
need nothing, so the pages meet a table of the repeated digests alone.
Records are written by Spark's own text writer, whose line separator is the
blank line that ends a WARC record; a lost task is simply written again.
Archives are read as whole files and cut by Content-Length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, shared_folder, written

CRLF = "\r\n"
#: Payloads shorter than this many bytes are never revisits.
MIN_BYTES = 100
#: Records, and bytes of blocks, of one archive file (or one longer record);
#: bounds what the reader holds at once.
RECORDS_PER_FILE, FILE_BYTES = 2000, 128 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

READ_SCHEMA = ("record_id string, record_type string, page_id string, url string, refers_to_id string, "
               "payload_digest string, payload_bytes bigint, payload binary")


def _record_id(page_id: Column, digest: Column) -> Column:
    """A name made from page id and digest alone, so a retry writes the same one."""
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("~")), digest))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL; line breaks are percent-encoded."""
    safe = F.regexp_replace(F.regexp_replace(value.cast("string"), "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(name + ": "), safe, F.lit(CRLF)), F.lit(""))


def resolve(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_bytes: int = MIN_BYTES) -> DataFrame:
    """``pages`` as (page_id, url, payload, bytes, digest, original).

    ``original`` is the page a revisit refers to, else NULL.  Among equal
    payloads of at least ``min_bytes`` the smallest page_id is the original;
    rows that share that id are all responses; rows with a NULL id are
    revisits of a page with an id, and responses if there is none.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("bigint")).withColumn("digest", F.sha2("payload", 256))
    headers = rows.filter(F.col("bytes") >= min_bytes).select("page_id", "digest")
    repeated = headers.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = written(repeated.select(F.col("digest").alias("d"), "first"), "warc-originals")
    out = rows.join(repeated, F.col("digest") == F.col("d"), "left")
    original = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return out.select("page_id", "url", "payload", "bytes", "digest", original.alias("original"))


def write_archives(resolved: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, date: str = DATE,
                   file_bytes: int = FILE_BYTES) -> None:
    """One record per row of ``resolve``: a response with its payload, or a
    revisit with the HTTP header alone.

    Records too large for ``records_per_file`` of them to fit ``file_bytes``
    go, by size class, to files of their own with fewer records.
    """
    c = F.col
    revisit = c("original").isNotNull()
    http = F.concat(F.lit(HTTP), c("bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, c("payload")))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(c("bytes"))
    record = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", F.concat(F.lit("<"), _record_id(c("page_id"), c("digest")), F.lit(">"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", c("url")),
        _field("WARC-Page-ID", F.url_encode(c("page_id").cast("string"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), c("digest"))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), _record_id(c("original"), c("digest")), F.lit(">")))),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", length),
        F.lit(CRLF), block)
    largest = resolved.agg(F.max("bytes")).first()[0] or 0
    above, records, mode = -1, records_per_file, "error"
    while True:
        limit = file_bytes // records
        fits = (length > above) & (length <= limit) if records > 1 else length > above
        rows = (resolved if mode == "error" and largest + 2 * len(HTTP) <= limit else resolved.filter(fits)).select(record.alias("value"))
        rows.write.mode(mode).option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", records).text(path)
        if records == 1 or largest + 2 * len(HTTP) <= limit:
            return
        above, records, mode = limit, max(1, records // 16), "append"


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive; payload is empty for a revisit."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(CRLF)
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        block = end + 4
        at = block + int(head["content-length"])
        body = data.index(b"\r\n\r\n", block, at) + 4
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record does not end at byte {at}")
        revisit = head["warc-type"] == "revisit"
        payload = b"" if revisit else view[body:at]
        yield {"record_id": head["warc-record-id"][1:-1], "record_type": head["warc-type"],
               "page_id": unquote_plus(head["warc-page-id"]) if "warc-page-id" in head else None, "url": head.get("warc-target-uri"),
               "refers_to_id": head["warc-refers-to"][1:-1] if revisit else None,
               "payload_digest": head["warc-payload-digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest(),
               "payload_bytes": None if revisit else len(payload), "payload": payload}
        at += 4


def read_archives(spark: SparkSession, path: str, payloads: bool = True, id_type: str = "bigint") -> DataFrame:
    """The records of all archives below ``path``, page ids as ``id_type``.

    Digest and length of a response are computed from the bytes read; a
    revisit's digest is its header's, and its length NULL until resolved.
    """
    schema = READ_SCHEMA if payloads else READ_SCHEMA.rsplit(",", 1)[0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()),
                           ("refers_to_id", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())]
                          + [("payload", pa.binary())] * payloads)
        for batch in batches:
            for data in batch.column("content"):
                rows = []
                for r in parse_archive(data.as_py()):
                    r["payload"] = bytes(r["payload"]) if payloads else None
                    rows.append(r)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist([{k: x[k] for k in arrow.names} for x in rows], arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([{k: x[k] for k in arrow.names} for x in rows], arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(released(cut), schema).withColumn(
        "page_id", F.col("page_id").cast(id_type))


def resolved_records(records: DataFrame) -> DataFrame:
    """Every record with the length of its full payload and, for a revisit,
    ``refers_to``: the response's page id.

    A revisit meets its response by record id.  A response that is written
    more than once counts once; a revisit without its response raises.
    """
    first = records.filter("record_type = 'response'").groupBy("record_id").agg(
        F.min("page_id").alias("o_page"), F.min("payload_bytes").alias("o_bytes"), F.min("payload_digest").alias("o_digest"))
    first = first.withColumnRenamed("record_id", "o_id")
    revisits = records.filter("record_type = 'revisit'")
    met = revisits.join(first, F.col("refers_to_id") == F.col("o_id"), "left")
    checked = F.when(F.col("o_digest") == F.col("payload_digest"), F.col("o_bytes")).otherwise(
        F.raise_error(F.concat(F.lit("no response for revisit "), F.col("record_id"))).cast("bigint"))
    cols = ["page_id", "url", "payload_digest", "record_type"]
    return met.select(*cols, checked.alias("payload_bytes"), F.col("o_page").alias("refers_to")).unionByName(
        records.filter("record_type = 'response'").select(*cols, "payload_bytes", F.lit(None).cast(records.schema["page_id"].dataType).alias("refers_to")))


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as deduplicated archives and read them back, resolved.

    An empty table writes no record and gives no row; a NULL html is an
    empty payload; a NULL url writes no target header; other columns of
    ``pages`` are ignored; ids may be of any type that a text stands for, and
    come back as that type.
    """
    path = path or shared_folder(pages.sparkSession, "warc")
    resolved = resolve(pages, **options)
    write_archives(resolved, path)
    id_type = resolved.schema["page_id"].dataType.simpleString()
    records = written(read_archives(pages.sparkSession, path, payloads=False, id_type=id_type), "warc-records")
    return resolved_records(records)
