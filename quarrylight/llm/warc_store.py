"""A content-addressed WARC archive.

Every page becomes one WARC record. Its exact header lies in one table, its payload in
another, once for each SHA-256, which is recomputed and compared when payloads are read.
Of equal payloads the smallest page_id is the response and the others are revisits without
a body; a join by digest gives every record back, byte for byte, to be written as gzipped
WARC files. These are read again record by record, by the lengths their headers state.

Payloads are cut to one per digest inside the tasks before any shuffle, and headers are
counted by page before they are joined; revisits are written without a join and find the
size and digest of their response by one that carries no payload. A file holds about
``FILE_BYTES`` of text, a longer record alone; a task that reads holds the compressed files of
one input partition. Null html is the empty payload, which is deduplicated like any other from
``min_bytes`` = 0 on. Null page_ids rank last; among equal page_ids the smaller url is the
response, and repeated rows give one response and revisits of it. An empty table gives an
empty archive. Extra columns are not read.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.functions.batches import map_batches
from quarrylight.llm.common import table
from quarrylight.session import scratch_path

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Written where a page has no capture time of its own.
DATE = "1970-01-01T00:00:00Z"
#: Text of a WARC file, and of the records that a task returns at a time.
FILE_BYTES = 16 << 20
#: About what a header takes.
HEADER_BYTES = 400
#: The first bytes of a gzipped file.
GZIP = b"\x1f\x8b"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: five of them make four letters."""
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _name(page: Column, copy: Column) -> Column:
    """A record's URN: the page_id in URL encoding, empty for null, and the copy's number."""
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.url_encode(page.cast("string")), F.lit("")), F.lit(":"), copy.cast("string"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value. Line ends cannot stand in a value."""
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", "%0D%0A"), F.lit("\r\n"))


def headers(pages: DataFrame, min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """The exact header of each page's record and the digest of its payload."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = (
        pages.select(
            "page_id", F.col("url").cast("string").alias("url"),
            F.sha2(payload, 256).alias("digest"), base32(F.sha1(payload)).alias("sha1"),
            F.length(payload).cast("long").alias("bytes"),
        )
        .groupBy("page_id", "url", "digest", "sha1", "bytes")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    rank = F.struct(F.col("page_id").isNull().alias("missing"), F.col("page_id").alias("page"), F.col("url").alias("url"))
    first = records.groupBy("digest").agg(F.min(rank).alias("first"))
    records = records.join(first, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    is_first = (
        (F.col("bytes") < min_bytes)
        | (
            F.col("page_id").eqNullSafe(F.col("first.page"))
            & F.col("url").eqNullSafe(F.col("first.url"))
            & (F.col("copy") == 1)
        )
    )
    target = F.when(~is_first, _name(F.col("first.page"), F.lit(1)))
    header = F.concat_ws(
        "",
        F.lit(f"{VERSION}\r\n"),
        F.when(is_first, F.lit("WARC-Type: response\r\n")).otherwise(F.lit("WARC-Type: revisit\r\n")),
        _line("WARC-Record-ID", _name(F.col("page_id"), F.col("copy"))),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Refers-To", target),
        F.when(~is_first, F.lit(f"WARC-Profile: {PROFILE}\r\n")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", F.when(is_first, F.col("bytes")).otherwise(F.lit(0))),
        F.lit("\r\n"),
    )
    return records.select(header.alias("header"), "digest")


def payloads(pages: DataFrame) -> DataFrame:
    """Each payload once, by its SHA-256."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload")).dropDuplicates(["digest"])


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Two tables below ``path``: headers and payloads."""
    headers(pages, min_bytes, date).write.option("compression", "zstd").parquet(f"{path}/headers")
    payloads(pages).write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_payloads(spark, path: str) -> DataFrame:
    """digest and payload; a payload that is not what its digest says fails the job."""
    stored = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    broken = F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))
    payload = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(broken.cast("binary"))
    return stored.select("digest", payload.alias("payload"))


def records(spark, path: str) -> DataFrame:
    """Every original record as bytes: its header, and its payload unless it is a revisit."""
    stored = spark.read.schema("header string, digest string").parquet(f"{path}/headers")
    revisit = F.col("header").contains("\r\nWARC-Type: revisit\r\n")
    full = stored.filter(~revisit).join(read_payloads(spark, path), "digest")
    return (
        full.select(F.concat(F.col("header").cast("binary"), "payload").alias("record"))
        .unionByName(stored.filter(revisit).select(F.col("header").cast("binary").alias("record")))
    )


def write_warc_files(spark, path: str, to: str, records_per_file: int | None = None) -> None:
    """The archive as gzipped WARC files of about ``FILE_BYTES``: two line ends close each record."""
    if records_per_file is None:
        mean = read_payloads(spark, path).agg(F.avg(F.length("payload"))).first()[0] or 0
        records_per_file = max(1, int(FILE_BYTES / (HEADER_BYTES + mean)))
    lines = records(spark, path).select(F.col("record").cast("string").alias("value"))
    options = {"lineSep": "\r\n\r\n", "compression": "gzip", "maxRecordsPerFile": records_per_file}
    lines.write.options(**options).text(to)


def parse(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, body) of each record of a WARC file, gzipped or not, read in order by the lengths it states."""
    plain = io.BytesIO(content)
    file = gzip.GzipFile(fileobj=plain) if content[:2] == GZIP else plain
    while line := file.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"damaged record: {line[:40]!r}")
        header, length = [line], None
        while (line := file.readline()).strip():
            header.append(line)
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                length = int(value)
        body = file.read(length or 0)
        if length is None or len(body) < length or file.read(4) != b"\r\n\r\n":
            raise ValueError(f"damaged record: {header[0]!r} without its {length} bytes")
        yield b"".join(header) + line, body


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of files, as many at a time as fill ``FILE_BYTES``."""
    found, held = [], 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array([h.decode() for h, _ in found], pa.string()), pa.array([b for _, b in found], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["header", "body"])

    for files in batches:
        for content in files.column(0):
            for record in parse(content.as_py()):
                found.append(record)
                held += len(record[0]) + len(record[1])
                if held >= FILE_BYTES:
                    yield batch()
                    found, held = [], 0
    if found:
        yield batch()


def read_warc_files(spark, folder: str) -> DataFrame:
    """header and body of each record of the WARC files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return map_batches(files, _parsed, "header string, body binary")


def described(found: DataFrame, id_type: T.DataType) -> DataFrame:
    """What the headers of records say, and the size and SHA-1 of the bodies beside them."""
    value = lambda name, rest=r"([^\r]*)": F.regexp_extract("header", rf"\r\n{name}: {rest}\r\n", 1)
    page = lambda name: F.url_decode(F.nullif(value(name, r"<urn:x-page:([^:\r]*):\d+>"), F.lit(""))).cast(id_type)
    return found.select(
        page("WARC-Record-ID").alias("page_id"),
        value("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        value("WARC-Record-ID").alias("record_id"),
        value("WARC-Refers-To").alias("target_id"),
        value("WARC-Payload-Digest", r"sha1:([A-Z2-7]*)").alias("named_digest"),
        F.length("body").cast("long").alias("body_bytes"),
        base32(F.sha1("body")).alias("body_digest"),
    )


def report(found: DataFrame, id_type: T.DataType) -> DataFrame:
    """Per record read, the size and digest of its full payload: its own body's, or that of the response it revisits.

    Revisits find their response by record and digest, since page_ids may repeat; bodies
    are not carried along. One without a response has nulls and is not verified.
    """
    known = described(found, id_type)
    responses = known.filter("record_type = 'response'")
    bodies = responses.select(
        F.col("record_id").alias("target_id"), F.col("body_digest").alias("named_digest"),
        F.col("body_bytes").alias("payload_bytes"), F.col("body_digest").alias("payload_digest"),
    )
    own = responses.withColumns({"payload_bytes": F.col("body_bytes"), "payload_digest": F.col("body_digest")})
    others = known.filter("record_type = 'revisit'").join(bodies, ["target_id", "named_digest"], "left")
    return own.unionByName(others).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        F.coalesce(F.col("named_digest") == F.col("payload_digest"), F.lit(False)).alias("verified"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    write_archive(pages, path)
    write_warc_files(spark, path, f"{path}/warc")
    return report(read_warc_files(spark, f"{path}/warc"), pages.schema["page_id"].dataType)


#: Base32 of a SHA-1 without such a function: 32 places of five bits.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, html, array_to_string(list_transform(range(32), lambda i:
        substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          ((('0x' || substring(h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - i % 4 * 5)::INT) & 31)::INT + 1, 1)), '') AS d,
        min(page_id) OVER (PARTITION BY html) AS f FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to, true AS verified
FROM b
"""
