"""WARC archives with revisit resolution.

Headers (page, length, digest) are shuffled by payload digest, without payloads; the smallest
page_id of a digest becomes the original response, and the others are joined to it as revisits.
Archives are then written with fresh headers: responses carry their payload once, revisits only
refer to it. A record is text up to its last line feed, which Spark's text sink appends, so the
part files are gzipped WARC files on any file system that Spark writes to. Reading parses whole
records by their Content-Length, checks payload digests and resolves references by record id.

Defined results: a null html is an empty payload; payloads of fewer than ``least`` bytes are never
revisits; rows that share the smallest page_id of a payload are all responses; a null page_id is
never the smallest one; line breaks in a URL are percent-encoded; an empty table gives an empty
archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.llm.packed import stored, tuned
from auditlens.session import fresh_path

LEAST = 100
DATE = "2026-01-01T00:00:00Z"
PER_FILE = 20_000
# The format's revisit profile.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def record_id(page_id: Column, digest: Column) -> Column:
    """A UUID from page and payload, the same in every run."""
    h = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))


def with_digest(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        F.col("page_id").cast("long"), "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload.cast("binary"), 256).alias("digest"),
    )


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, digest, original, original_url) of the pages whose payload another page holds."""
    heads = with_digest(pages).select("page_id", "url", "digest", "payload_bytes").filter(F.col("payload_bytes") >= least)
    first = heads.groupBy("digest").agg(F.min("page_id").alias("original"), F.min_by("url", "page_id").alias("original_url"), F.count("*").alias("n"))
    first = first.filter("n > 1 AND original IS NOT NULL").drop("n")
    return heads.select("page_id", "digest").join(first, "digest").filter("page_id IS NULL OR page_id != original").distinct()


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(value): one WARC record per row of ``pages``, without its last line feed."""
    again = stored(revisits(pages, least), "revisits").withColumnsRenamed({"page_id": "again_id", "digest": "again_digest"})
    pages = with_digest(pages)
    joined = pages.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    revisit = F.col("again_digest").isNotNull()
    clean = lambda url: F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    field = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(END))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END + END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    only = lambda text: F.when(revisit, text).otherwise(F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1" + END),
        field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", clean(F.col("url"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        only(field("WARC-Profile", F.lit(PROFILE))),
        only(field("WARC-Refers-To", record_id(F.col("original"), F.col("digest")))),
        only(field("WARC-Refers-To-Target-URI", clean(F.col("original_url")))),
        field("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
    )
    return joined.select(F.concat(header, block, F.lit("\r\n\r")).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST) -> None:
    records(pages, least).write.option("compression", "gzip").option("maxRecordsPerFile", PER_FILE).text(path)


def _parsed(content: bytes):
    """(header fields, block) of each record of one gzipped archive, decompressed as it is read."""
    inflate, buffer, at = zlib.decompressobj(31), b"", 0
    step = 1 << 20

    def more() -> bool:
        nonlocal buffer, at, inflate
        while at < len(content):
            buffer += inflate.decompress(content[at : at + step])
            at += step
            if inflate.eof and inflate.unused_data:  # next member of the file
                at -= len(inflate.unused_data) + max(0, at - len(content))
                inflate = zlib.decompressobj(31)
            return True
        return False

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                return
        lines = buffer[:end].decode("utf-8").split(END)
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(fields["Content-Length"])
        while len(buffer) < end + 4 + size + 4:
            if not more():
                raise ValueError("a record ends before its length")
        yield fields, buffer[end + 4 : end + 4 + size]
        buffer = buffer[end + 8 + size :]


READ_DDL = "record_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to_id string"


def read_archives(spark, path: str) -> DataFrame:
    """One row per record of the archives below ``path``; payload digests are checked."""

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                out = []
                for fields, block in _parsed(content.as_buffer().to_pybytes()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    http = dict(line.split(": ", 1) for line in head.decode().split(END)[1:])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if fields["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
                    page = fields["X-Page-ID"]
                    out.append((fields["WARC-Record-ID"], int(page) if page else None, fields["WARC-Target-URI"], fields["WARC-Type"],
                                int(http["Content-Length"]), digest, fields.get("WARC-Refers-To")))
                if out:
                    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [x.split()[0] for x in READ_DDL.split(", ")])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, READ_DDL)


def resolved(read: DataFrame) -> DataFrame:
    """Records with the page_id of the response that a revisit refers to."""
    answer = read.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    return read.join(answer.dropDuplicates(["refers_to_id"]), "refers_to_id", "left")


def archived_pages(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to archives in the shared folder and reads them back."""
    spark = tuned(pages.sparkSession)
    path = fresh_path(spark, "warc")
    write_archives(pages, path, least)
    read = stored(read_archives(spark, path), "warc-records")
    return resolved(read).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""
WITH heads AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM heads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM original AND original IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM firsts
"""
