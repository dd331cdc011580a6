"""WARC archives: written as monolithic gzip streams, then normalised to one gzip member per record.

Spark's text writer puts whole records into one gzip stream per file (a record ends with two line breaks,
which is the writer's line separator), so archives reach any store that Spark can write. The normaliser
inflates each archive's stream once, writes every record as a member of its own, and a sidecar index of
member offsets. The members leave through the text writer as well: a gzip member of less than 16 MiB ends
with a zero byte, which is taken off and put back as line separator; a larger one is followed by an empty member.

Of pages with equal payloads, the one with the smallest id is a ``response``; the others are ``revisit``
records that name its id and carry no payload. Defined results: a null html is an empty payload; repeated
rows of the smallest id are all responses; a null id is larger than any other, and alone among equals a
response; archives of an empty table are an empty set.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

SEPARATOR = "\r\n\r\n"
BATCH_BYTES = 4 << 20
#: Records in one archive at most. Only the size of a file hangs on it: an archive is read by one task.
RECORDS_PER_ARCHIVE = 2_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of SHA-1: five hex digits are four base-32 digits."""
    digest = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", records: int = RECORDS_PER_ARCHIVE) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) into monolithic gzip archives below ``path``."""
    own = pages.select(
        F.col("page_id"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumns({"digest": base32_sha1(F.col("html").cast("binary")), "size": F.octet_length("html")})
    first = own.groupBy("digest", "size").agg(F.min("page_id").alias("first_id"))
    typed = own.join(first, ["digest", "size"]).withColumn("revisit", ~F.coalesce(F.col("page_id") == F.col("first_id"), F.col("first_id").isNull()))
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("Payload-Length: "), F.col("size").cast("string")),
        F.concat(F.lit("Page-ID: "), F.col("page_id").cast("string")),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first_id").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(SEPARATOR), body)
    typed.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", SEPARATOR).option("maxRecordsPerFile", records).text(path)


def inflated(content: memoryview, step: int = 1 << 18) -> Iterator[bytes]:
    """The bytes of a gzip file of any number of members."""
    stream = zlib.decompressobj(31)
    for at in range(0, len(content), step):
        data = bytes(content[at : at + step])
        while data:
            yield stream.decompress(data)
            data = stream.unused_data
            if stream.eof:
                stream = zlib.decompressobj(31)
    yield stream.flush()


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of an uncompressed WARC stream."""
    buffer = bytearray()
    for chunk in chunks:
        buffer += chunk
        at = 0
        while (blank := buffer.find(b"\r\n\r\n", at)) >= 0:
            lines = buffer[at:blank].decode("utf-8").split("\r\n")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            end = blank + 4 + int(headers["Content-Length"]) + 4
            if end > len(buffer):
                break
            yield headers, bytes(buffer[at:end])
            at = end
        del buffer[:at]
    if buffer:
        raise ValueError(f"the archive ends inside a record: {len(buffer)} bytes are left")


def _member(record: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


EMPTY_MEMBER = _member(b"")


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the archives below ``source``: ``target/kind=warc/archive=...`` and the index ``target/kind=index/archive=...``."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {"kind": [], "archive": [], "ordinal": [], "value": []}
        size = 0

        def full() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held["kind"]), pa.array(held["archive"]), pa.array(held["ordinal"], pa.int64()), pa.array(held["value"], pa.binary())], list(held))
            for column in held.values():
                column.clear()
            return batch

        def put(kind: str, archive: str, ordinal: int, value: bytes) -> None:
            for column, x in zip(held.values(), (kind, archive, ordinal, value), strict=True):
                column.append(x)

        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                archive, offset, ordinal = path.as_py().rsplit("/", 1)[1].split(".")[0], 0, 0
                for headers, record in records_of(inflated(memoryview(content.as_buffer()))):
                    member = _member(record)
                    line = "\t".join([str(offset), str(len(member)), headers.get("Page-ID", ""), headers["WARC-Type"], headers["WARC-Target-URI"].replace("\t", " "), headers["WARC-Payload-Digest"]])
                    whole = member if not member[-1] else member + EMPTY_MEMBER
                    put("warc", archive, ordinal, whole[:-1])
                    put("index", archive, ordinal, line.replace("\0", " ").encode())
                    offset, ordinal, size = offset + len(whole), ordinal + 1, size + len(whole)
                    if size >= BATCH_BYTES:
                        yield full()
                        size = 0
        if held["kind"]:
            yield full()

    streams = spark.read.format("binaryFile").load(source).select("path", "content")
    members = streams.mapInArrow(rewrite, "kind string, archive string, ordinal long, value binary")
    ordered = members.sortWithinPartitions("kind", "archive", "ordinal").select("kind", "archive", F.col("value").cast("string").alias("value"))
    ordered.write.partitionBy("kind", "archive").option("lineSep", "\0").text(target)


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecar index: archive, offset, length, page_id, record_type, url, payload_digest."""
    lines = spark.read.option("lineSep", "\0").option("basePath", f"{target}/kind=index").schema("value string, archive string").text(f"{target}/kind=index")
    part = F.split("value", "\t")
    return lines.select(
        "archive", part[0].cast("bigint").alias("offset"), part[1].cast("bigint").alias("length"), F.nullif(part[2], F.lit("")).alias("page_id"),
        part[3].alias("record_type"), part[4].alias("url"), part[5].alias("payload_digest"),
    )


def read_members(spark: SparkSession, target: str, entries: DataFrame) -> DataFrame:
    """The compressed members that ``entries`` of the index name, cut out at their offsets."""
    archives = spark.read.format("binaryFile").load(f"{target}/kind=warc").select(F.regexp_extract("path", "archive=([^/]+)/", 1).alias("archive"), "content")
    return entries.join(archives, "archive").select(entries["*"], F.expr("substring(content, cast(offset + 1 as int), cast(length as int))").alias("member"))


def read_records(spark: SparkSession, target: str) -> DataFrame:
    """Read all archives back: page_id (text), payload_bytes, payload_digest, record_type, refers_to (text), payload.

    The digest of a response is computed anew from its payload and must equal the header's.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, record in records_of(inflated(memoryview(content.as_buffer()))):
                    payload = record[len(record) - 4 - int(headers["Content-Length"]) : -4]
                    digest, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
                    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"the payload of page {headers.get('Page-ID')} differs from its digest")
                    refers = headers["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">") if revisit else None
                    rows.append((headers.get("Page-ID"), int(headers["Payload-Length"]), digest, headers["WARC-Type"], refers, None if revisit else payload))
                    size += len(payload)
                    if size >= BATCH_BYTES or len(rows) >= 10_000:
                        yield as_batch(rows)
                        rows, size = [], 0
                if rows:
                    yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    files = spark.read.format("binaryFile").load(f"{target}/kind=warc").select("content")
    return files.mapInArrow(read, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, normalise them, and read them back, one row per page without the payload."""
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    raw, target = shared_dir(spark, "warc-raw"), shared_dir(spark, "warc")
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    if pages.isEmpty():
        found = spark.createDataFrame([], schema)
    else:
        write_archives(pages, raw)
        normalise(spark, raw, target)
        found = read_records(spark, target)
    return found.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))
