"""WARC archives with revisit records for repeated payloads.

1. Every page's header (id, payload digest, payload length) is shuffled by
   digest; the smallest page_id of each digest that several pages share is the
   original, and headers join it, so each page knows whether it is a response
   or a revisit.  Payloads take no part in that shuffle.
2. The decisions join the pages again on page_id and digest, and each page
   becomes one record with fresh headers: responses carry the payload, revisits
   refer to the original.  Records go out by Spark's text writer (a record ends
   with two CRLFs, the writer's line separator), as gzip files of a bounded
   number of records each; payloads are shuffled once, for that join.
3. Archives are read back file by file; records are cut by Content-Length only,
   so a payload may hold anything, CRLFs and record-like text included, and a
   response's digest is taken again from the payload that was read.

Defined cases: null html is an empty payload; payloads under ``min_bytes`` are
always responses; rows repeating an id and payload are all of the type that
id has; a page without id is a response unless a page with an id has the same
payload (then a revisit of it).  Control characters in a url are percent-coded.
Payloads of any length are written and read whole; an empty table gives no
records; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialise, shared_path, table

MIN_BYTES = 100
FILE_BYTES = 32 << 20
CRLF = "\r\n"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
RESPONSE_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _digests(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("bigint").alias("payload_bytes"),
                        F.sha2(html.cast("binary"), 256).alias("payload_digest"))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each page."""
    heads = materialise(_digests(pages).drop("url", "html"), "warc-heads")
    first = (heads.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    joined = heads.join(first, "payload_digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "payload_bytes", "payload_digest",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("first")).alias("refers_to"))


def record_id(page_id: Column) -> Column:
    """<urn:uuid:..> whose last 64 bits are the page's id; null: none."""
    low = F.lpad(F.lower(F.hex(page_id.cast("bigint"))), 16, "0")
    return F.concat(F.lit("<urn:uuid:00000000-0000-8000-"), F.substring(low, 1, 4), F.lit("-"), F.substring(low, 5, 12), F.lit(">"))


def records(pages: DataFrame, decided: DataFrame, date: str) -> DataFrame:
    """One string column ``value``: each page's record without the two CRLFs after it."""
    keys = decided.select(F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest"), "record_type", "refers_to").distinct()
    rows = _digests(pages)
    rows = rows.join(keys, rows["page_id"].eqNullSafe(keys["__id"]) & (rows["payload_digest"] == keys["__digest"]))
    response = F.col("record_type") == "response"
    block = F.concat(F.lit(RESPONSE_HEAD), F.when(response, F.col("html")).otherwise(""))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\r\n]", "%0A"), r"[\x00-\x20\x7F]", "%20")

    def line(name: str, value: Column) -> Column:  # a null value leaves the line out
        return F.concat(F.lit(name + ": "), value, F.lit(CRLF))

    head = F.concat_ws("", F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.col("record_type")),
                       line("WARC-Record-ID", record_id(F.col("page_id"))), line("WARC-Date", F.lit(date)),
                       line("WARC-Target-URI", url),
                       line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
                       line("WARC-Refers-To", record_id(F.col("refers_to"))),
                       line("WARC-Profile", F.when(~response, F.lit(REVISIT_PROFILE))),
                       line("X-Payload-Length", F.when(~response, F.col("payload_bytes").cast("string"))),
                       line("Content-Type", F.lit("application/http;msgtype=response")),
                       line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF))
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = "1970-01-01T00:00:00Z",
                   file_bytes: int = FILE_BYTES) -> None:
    """Write every page of ``pages`` (page_id, url, html) to gzip WARC files under ``path``."""
    decided = materialise(resolve(pages, min_bytes), "warc-decided")
    whole = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    mean = decided.agg(F.avg(whole).alias("bytes")).first()["bytes"] or 0
    (records(pages, decided, date).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", max(1, int(file_bytes / (mean + 700)))).text(path))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(header fields in lower case, block) of each record."""
    at = 0
    while at < len(data):
        lines, end = [], at
        while (stop := data.find(b"\r\n", end)) != end:  # header lines up to the empty one
            if stop < 0:
                raise ValueError(f"a record's header doesn't end, at byte {at}")
            lines.append(data[end:stop].decode())
            end = stop + 2
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        start, size = end + 2, int(head["content-length"])
        if lines[0][:5] != "WARC/" or data[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"no whole record at byte {at}")
        yield head, memoryview(data)[start:start + size]
        at = start + size + 4


def _id(field: str | None) -> int | None:
    if not field:
        return None
    low = int(field.strip("<>")[-17:].replace("-", ""), 16)
    return low - (1 << 64) if low >> 63 else low


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records under ``path``; a payload that doesn't match its header's digest is an error."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                for head, block in parse(gzip.decompress(content.as_py())):
                    digest, kind = head["warc-payload-digest"].partition(":")[2], head["warc-type"]
                    size = int(head.get("x-payload-length", -1))
                    if kind == "response":
                        payload = block[len(RESPONSE_HEAD):]
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {head['warc-target-uri']} isn't what was written")
                    rows.append((_id(head.get("warc-record-id")), head["warc-target-uri"], size, digest, kind, _id(head.get("warc-refers-to"))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], NAMES)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, RECORD)


NAMES = [x.split()[0] for x in RECORD.split(", ")]
KINDS = [pa.int64() if x.endswith(" long") else pa.string() for x in RECORD.split(", ")]


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""
