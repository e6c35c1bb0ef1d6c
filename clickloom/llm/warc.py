"""WARC archives: segmented writing, and reading with reassembly of the segments.

Writing. Every page becomes one HTTP response whose body is sent in chunks. Pages with equal payloads
of at least ``min_revisit`` bytes share one ``response`` record, that of the largest id; the others are
``revisit`` records that refer to it. A block longer than ``segment_bytes`` is cut: the first segment
keeps the record's type, the rest are ``continuation`` records with the origin's identifier, their number
and, on the last, the total length. Spark's text writer puts the records into gzip files of at most
``file_records`` records, so that no file, and no task that reads one, grows with the corpus.

Reading. Every file is parsed by the records' Content-Length. Segments are grouped by the identifier of
their origin and put in order of their numbers; numbers must run from 1 without a gap, and the length
must be the total that the last one states. Chunked framing is then decoded. Records in one piece don't
take part in the shuffle. A record that can't be put together is returned with a status that says why:
``missing segment``, ``wrong length``, ``bad chunks`` or ``bad http``; whole ones have ``ok``.

Two equal copies of a segment count once; different segments with the same origin and number are a
``wrong length`` or ``bad chunks`` at the latest. A null url is written as an empty target, a null body
as an empty payload. Every row has a record: rows that share an id, or have none, are told apart by their
content and a running number. Of equal payloads, all rows of the largest id are responses, and so are rows
without an id; a revisit refers to one of the former. Ids are whole numbers. Empty tables give empty
archives, which read as no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import each_copy, emit, join_keys, map_arrow
from clickloom.sources.tables import materialize

#: Fixed values of the formats.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
FILE_RECORDS = 4096
MIN_REVISIT = 1000


def record_id(name: object) -> str:
    """The identifier of a row's record: the same for the same row, so a repeated task writes it again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{name}')}>"


def chunked(body: bytes, size: int) -> bytes:
    """The body in chunks, as HTTP sends it."""
    parts = [b"%x\r\n%s\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes | None:
    """What the chunks carry; None if the framing is broken or anything but trailer lines follows."""
    out, at = [], 0
    while True:
        line = framed.find(b"\r\n", at)
        if line < 0:
            return None
        head = framed[at:line].split(b";")[0].strip()
        if not head or head.strip(b"0123456789abcdefABCDEF"):
            return None
        size, at = int(head, 16), line + 2
        if not size:
            break
        if framed[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(framed[at : at + size])
        at += size + 2
    rest = framed[at:]
    return b"".join(out) if rest == b"\r\n" or rest.endswith(b"\r\n\r\n") else None


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    lines = [VERSION, *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _records(key: int | None, name: str, url: str, body: bytes, refers_to: str | None, segment: int, chunk: int) -> Iterator[bytes]:
    origin = record_id(name)
    url = "".join(url.split())  # a header is one line
    digest = hashlib.sha1(body).hexdigest()
    shared = [
        ("WARC-Target-URI", url),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", "" if key is None else key),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        extra = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", origin), *extra, *shared], head)
        return
    block = head + chunked(body, chunk)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", origin), *shared]
    if len(block) <= segment:
        yield _record(first, block)
        return
    yield _record([*first, ("WARC-Segment-Number", 1)], block[:segment])
    for number, at in enumerate(range(segment, len(block), segment), 2):
        headers = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{name}:{number}')}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Segment-Origin-ID", origin),
            ("WARC-Segment-Number", number),
        ]
        if at + segment >= len(block):
            headers.append(("WARC-Segment-Total-Length", len(block)))
        yield _record(headers, block[at : at + segment])


def plan_records(rows: DataFrame, min_revisit: int) -> DataFrame:
    """id, name, url, body (binary) and refers_to (the name of a response) of each of the named rows.

    Only digests, ids and names are grouped; a digest's rows are counted in the map tasks first. The
    representatives are written down, so that both sides of the join come straight from a shuffle (or
    the small one is broadcast by Spark's own limit) and a digest with very many pages is split.
    """
    sized = rows.withColumn("digest", F.when((F.octet_length("body") >= min_revisit) & F.col("id").isNotNull(), F.sha1("body")))
    shared = sized.where(F.col("digest").isNotNull()).groupBy("digest")
    shared = shared.agg(F.max(F.struct("id", "name")).alias("first"), F.min("id").alias("least")).where(F.col("first.id") != F.col("least"))
    shared = materialize(shared.select("digest", "first"), "warc-shared")
    joined = sized.join(shared, "digest", "left")
    return joined.select("id", "name", "url", "body", F.when(F.col("id") != F.col("first.id"), F.col("first.name")).alias("refers_to"))


def named_rows(pages: DataFrame, key: str, url: str, body: str) -> DataFrame:
    """id, name, url and body (binary) of every row; nothing is moved where ids are unique.

    The name is the id. To rows with an id that others have too, or without one, it adds a digest of the content
    and the number among equal rows.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(body).cast("string").cast("binary"), F.lit(b"")).alias("body"),
    )
    twice = rows.groupBy("id").count().where((F.col("count") > 1) & F.col("id").isNotNull()).select("id")
    twice = materialize(twice, "warc-repeated")
    without = rows.where(F.col("id").isNull())
    single = rows.where(F.col("id").isNotNull())
    if not twice.isEmpty():
        without = without.unionByName(join_keys(single, twice, "id", "left_semi"))
        single = join_keys(single, twice, "id", "left_anti")
    alike = without.groupBy("id", "url", "body").agg(F.count("*").alias("copies"))
    content = F.sha1(F.concat(F.sha1("body"), F.col("url").cast("string")).cast("binary"))
    named = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), content, "copy")
    again = each_copy(materialize(alike, "warc-alike"), "copies", "copy").withColumn("name", named)
    single = single.withColumn("name", F.col("id").cast("string"))
    return single.unionByName(again.select("id", "url", "body", "name"))


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    body: str = "html",
    min_revisit: int = MIN_REVISIT,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    file_records: int = FILE_RECORDS,
) -> None:
    """Write the pages as gzipped WARC files below ``path``."""
    planned = plan_records(named_rows(pages, key, url, body), min_revisit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record", pa.binary())])
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns))
            records = ((r,) for row in rows for r in _records(*row, segment_bytes, chunk_bytes))
            yield from emit(records, schema, lambda row: len(row[0]))

    records = map_arrow(planned, run, "record binary")
    # The text writer passes the bytes of a string on as they are, and the line separator ends each record.
    writer = records.select(F.col("record").cast("string").alias("value")).write.mode("overwrite")
    writer.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an archive, gzipped or not."""
    raw = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        headers: dict[str, str] = {}
        name = ""
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and name:
                headers[name] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            name = name.strip().lower()
            headers[name] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


_FIELDS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "refers_to_id": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "page": "x-page-id",
    "origin_id": "warc-segment-origin-id",
    "number": "warc-segment-number",
    "total": "warc-segment-total-length",
}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record as it stands in the archives: the header fields above as strings, and its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*((name, pa.string()) for name in _FIELDS), ("block", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                rows = ((*(h.get(x) for x in _FIELDS.values()), block) for h, block in parse(content.as_py()))
                yield from emit(rows, schema, lambda row: len(row[-1]) + 400)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return map_arrow(files, run, ", ".join(f"{name} string" for name in _FIELDS) + ", block binary")


def reassemble(records: DataFrame) -> DataFrame:
    """One row a record, segments put together: ``block`` and ``status``.

    The segments of a record meet in one task, as the record must in one row; no other grouping is done.
    """
    whole = records.where(F.col("number").isNull() & F.col("origin_id").isNull())
    parts = records.where(F.col("number").isNotNull() | F.col("origin_id").isNotNull())
    number = F.coalesce(F.expr("try_cast(number as int)"), F.lit(0))
    names = [name for name in _FIELDS if name not in ("origin_id", "number", "total")]
    first = number == 1
    segments = parts.groupBy(F.coalesce("origin_id", "record_id").alias("origin")).agg(
        *[F.max(F.when(first, F.col(name))).alias(name) for name in names],
        F.max(F.expr("try_cast(total as bigint)")).alias("total"),
        F.array_sort(F.collect_set(F.struct(number.alias("n"), F.col("block").alias("block")))).alias("parts"),
    )
    count = F.size("parts")
    text = F.array_join(F.transform("parts", lambda x: x["block"].cast("string")), "")
    ordered = (F.get("parts", F.lit(0))["n"] == 1) & (F.get("parts", count - 1)["n"] == count)
    block = text.cast("binary")
    segments = segments.select(
        *[F.coalesce(F.col("record_id"), F.col("origin")).alias(n) if n == "record_id" else F.col(n) for n in names],
        block.alias("block"),
        F.when(~ordered | F.col("total").isNull(), "missing segment")
        .when(F.octet_length(block) != F.col("total"), "wrong length")
        .otherwise("ok")
        .alias("status"),
    )
    return whole.select(*names, "block", F.lit("ok").alias("status")).unionByName(segments)


def payloads(assembled: DataFrame) -> DataFrame:
    """The records with ``payload`` instead of the block: the HTTP body, its chunked framing decoded."""
    kept = [c for c in assembled.columns if c not in ("block", "status")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*((name, pa.string()) for name in kept), ("payload", pa.binary()), ("status", pa.string())])
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in (*kept, "block", "status")]
            rows = ((*row[:-2], *_payload(row[-2], row[-1], row[kept.index("record_type")])) for row in zip(*columns))
            yield from emit(rows, schema, lambda row: len(row[-2] or b"") + 400)

    return map_arrow(assembled, run, ", ".join(f"{name} string" for name in kept) + ", payload binary, status string")


def _payload(block: bytes | None, status: str, kind: str | None) -> tuple[bytes | None, str]:
    if status != "ok":
        return None, status
    head, found, body = (block or b"").partition(b"\r\n\r\n")
    if not found:
        return None, "bad http"
    if kind == "revisit":
        return None, "ok"
    if b"transfer-encoding: chunked" in head.lower():
        decoded = unchunked(body)
        return decoded, "bad chunks" if decoded is None else "ok"
    return body, "ok"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path`` put together and decoded: the fields of a record, payload and status."""
    return payloads(reassemble(read_records(spark, path)))
