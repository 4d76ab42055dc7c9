"""WARC archives: writing pages as transactions, reading archives, and assembling captures.

Each page is written as three records: the request, the response (or a revisit, which has no payload), and metadata.
Request and metadata name the response's record in WARC-Concurrent-To. Reading gives one row per record;
assembly joins the records of a transaction through these identifiers into one nested row per capture.

Archives are files in the shared folder, of a bounded number of bytes (but for a single page that is larger), each record a gzip member of its
own, so that a reader holds one record at a time. Equal payloads are counted by digest, with partial sums; then pages meet what is known of
their digest in a join that deals a very common digest over SALTS tasks.

Results for edge cases: null html is an empty payload; a null url has an empty target; line ends in a url are
percent-encoded. Pages that repeat the largest page_id of their payload are all responses. A null page_id is
less than any other. A transaction without a response record is dropped as incomplete; one without request or metadata
keeps nulls there. An empty table gives no archives and no captures. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, shared_dir, table

#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
#: Bytes of an archive, after which another begins.
FILE_BYTES = 8 << 20
#: Compression of records.
LEVEL = 4
#: Bytes of records, and records, that a reader hands on at once.
READ_BYTES, READ_RECORDS = 8 << 20, 1024
#: Tasks over which the pages of one digest are dealt.
SALTS = 8
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_type string, record_id string, concurrent_to string, target_uri string, refers_to string, payload_bytes long, payload_digest string, page_id {id}, payload binary"


def _record(kind: Column | str, record_id: Column, uri: Column, content_type: str, body: Column, *headers: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), uri, *headers,
        F.lit(f"\r\nContent-Type: {content_type}\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def _header(name: str, value: Column) -> Column:
    """Nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))


def write_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", path: str | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Writes every page to archives in ``path`` (a new shared folder if none is given), and returns the path."""
    bounded_batches(df.sparkSession)
    path = path or shared_dir(df.sparkSession)
    pages = df.select(F.col(id_col).alias("page"), F.regexp_replace(F.coalesce(url_col, F.lit("")), r"[\r\n]", "%0A").alias("uri"), F.coalesce(html_col, F.lit("")).alias("html"))
    pages = pages.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html"))
    large = F.col("size") >= REVISIT_BYTES
    copies = (
        pages.where(large).groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page", "uri")).alias("first")).where("n > 1")
        .select(F.col("digest").alias("of"), F.col("first.page").alias("to_page"), F.col("first.uri").alias("to_uri"), F.lit(True).alias("shared"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    )
    salt = F.pmod(F.hash("page", "uri"), F.lit(SALTS))
    pages = pages.join(copies, (F.col("digest") == F.col("of")) & (salt == F.col("of_salt")) & large, "left")
    revisit = F.coalesce("shared", F.lit(False)) & ~F.col("page").eqNullSafe(F.col("to_page"))
    pages = pages.withColumn("revisit", revisit).withColumn("row", F.monotonically_increasing_id())

    def urn(kind: str) -> Column:
        h = F.md5(F.concat(F.lit(f"{kind} "), F.col("row").cast("string")))
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))

    uri, response = F.col("uri"), urn("response")
    beside = _header("WARC-Concurrent-To", response)
    host = F.regexp_extract("uri", r"^[a-zA-Z]+://([^/?#]*)", 1)
    target = F.regexp_replace("uri", r"^[a-zA-Z]+://[^/?#]*", "")
    request = _record("request", urn("request"), uri, "application/http; msgtype=request", F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")), beside)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"), F.when(F.col("revisit"), "").otherwise(F.col("html")))
    response = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"), response, uri, "application/http; msgtype=response", http,
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(F.col("revisit"), F.concat(_header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To-Target-URI", F.col("to_uri")), _header("WARC-Refers-To-Date", F.lit(DATE)), _header("WARC-Refers-To-Page", F.col("to_page")))).otherwise(""),
    )
    metadata = _record("metadata", urn("metadata"), uri, "application/warc-fields", F.concat(F.lit("page: "), F.coalesce(F.col("page").cast("string"), F.lit("")), F.lit("\r\n")), beside)
    records = pages.select(*(r.cast("binary").alias(n) for r, n in ((request, "request"), (response, "response"), (metadata, "metadata"))))
    # a file for each row; the writer ends it by the byte 0 that ends a gzip member
    files = records.mapInArrow(partial(_archives, file_bytes), "value binary").select(F.col("value").cast("string"))
    files.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)
    return path


def _archives(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transactions as gzip members, joined to archives, without the last byte, a 0."""
    held: list[bytes] = []
    size = 0

    def archive() -> pa.RecordBatch:
        data = b"".join(held)
        if data[-1]:  # the last record has 16 MB or more; an empty member follows
            data += gzip.compress(b"", mtime=0)
        return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], ["value"])

    for b in batches:
        for i in range(b.num_rows):
            for column in b.columns:
                held.append(gzip.compress(column[i].as_py(), LEVEL, mtime=0))
                size += len(held[-1])
            if size >= most:
                yield archive()
                held, size = [], 0
    if held:
        yield archive()


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, compressed or not, one at a time."""
    raw = io.BytesIO(data)
    file = gzip.GzipFile(fileobj=raw) if data[:2] == b"\x1f\x8b" else raw
    while version := file.readline():
        if not version.startswith(b"WARC/1."):
            raise ValueError(f"no record where one should begin: {version[:40]!r}")
        headers = {}
        while (line := file.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.lower()] = value.strip()
        size = int(headers["content-length"])
        block = file.read(size)
        if len(block) < size or file.read(4) != b"\r\n\r\n":
            raise ValueError(f"{headers.get('warc-record-id')}: the record is cut off")
        yield headers, block


def read_archives(spark: SparkSession, path: str, id_type: str = "long", with_payload: bool = True) -> DataFrame:
    """A row for each record of the archives in a folder. Digests and lengths of responses are those of the payload that was read."""
    bounded_batches(spark)
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.string(), pa.binary()]

    def row(h: dict[str, str], block: bytes) -> tuple:
        kind = h["warc-type"]
        size = digest = page = payload = None
        if kind in ("response", "revisit"):
            head, _, payload = block.partition(b"\r\n\r\n")
            if kind == "response":
                size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                if h.get("warc-payload-digest", f"sha1:{digest}") != f"sha1:{digest}":
                    raise ValueError(f"{h['warc-record-id']}: the payload doesn't have its digest")
            else:
                size = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                digest = h["warc-payload-digest"].removeprefix("sha1:")
        elif kind == "metadata":
            page = next((x[5:].strip() or None for x in block.decode().split("\r\n") if x.startswith("page:")), None)
        return kind, h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-target-uri"), h.get("warc-refers-to-page"), size, digest, page, payload if with_payload else None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows, size = [], 0
                for headers, block in _records(data.as_py()):
                    rows.append(row(headers, block))
                    size += len(rows[-1][-1] or b"")
                    if size >= READ_BYTES or len(rows) >= READ_RECORDS:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD.format(id="string")).withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, response, requests, metadata. Of requests and metadata all records that name the capture are kept, by record id; page_id is that of the first
    metadata record that has one. Records of other kinds are left out, and so are captures without a response; of two responses of one id, which the format forbids, one stays."""
    part = F.struct("record_id", *(c for c in records.columns if c not in ("concurrent_to", "record_id")))
    kind = F.col("record_type")
    of = lambda k: F.array_sort(F.collect_list(F.when(kind == k, part)))
    whole = records.withColumn("capture", F.coalesce("concurrent_to", "record_id")).groupBy("capture").agg(F.max(F.when(kind.isin("response", "revisit"), part)).alias("response"), of("request").alias("requests"), of("metadata").alias("metadata"))
    page = F.get(F.filter(F.transform("metadata", lambda m: m["page_id"]), lambda p: p.isNotNull()), F.lit(0))
    return whole.where("response IS NOT NULL").select(page.alias("page_id"), "response", "requests", "metadata")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = assemble(read_archives(spark, write_pages(table(spark, sf_dir, "pages")), with_payload=False).drop("payload"))
    return captures.select("page_id", *(F.col(f"response.{c}").alias(c) for c in ("payload_bytes", "payload_digest", "record_type", "refers_to")))


ORACLE_SQL = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 1000 OR page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 1000 OR page_id = newest THEN NULL ELSE newest END AS refers_to
FROM (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS newest
      FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
"""
