"""WARC archives: records in segments, written by Spark tasks and put together again."""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlens.llm.common import arrow_schema, map_batches, text_bytes

#: Payloads below this size are never stored as a revisit.
LEAST_REVISIT = 100
END = b"\r\n\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int) -> bytes:
    """A payload in chunked transfer framing."""
    out = [b"%x\r\n%s\r\n" % (len(part), part) for i in range(0, len(payload), size) for part in (payload[i : i + size],)]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def _record(kind: bytes, name: bytes, fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    """One record less the blank lines that end it."""
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name + b">"]
    head += [a + b": " + b for a, b in fields]
    head.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(head) + END + block


def _name(page: object, digest: str, segment: int = 1, copy: int = 0) -> bytes:
    """A record's identifier; repeated rows have a number of their own in it."""
    parts = (page, digest, segment, copy) if copy else (page, digest, segment)
    return b"urn:uuid:" + str(uuid.uuid5(uuid.NAMESPACE_URL, "/".join(map(str, parts)))).encode()


def _line(value: str) -> bytes:
    """A value fit for a header line."""
    return " ".join(value.split()).encode()


def page_records(
    page: object,
    url: str | None,
    payload: bytes,
    digest: str,
    first: object,
    segment_bytes: int,
    chunk_bytes: int,
    copy: int = 0,
    one_first: bool = True,
) -> Iterator[bytes]:
    """The records of one page: a revisit of page ``first``, or a response in one or more segments.

    ``copy`` tells apart rows of one id and payload.  A revisit names the record it refers to if
    that page has ``one_first`` row only, else just the page.
    """
    fields = [(b"WARC-Date", b"2024-01-01T00:00:00Z"), (b"WARC-Payload-Digest", b"sha256:" + digest.encode())]
    if url is not None:
        fields.append((b"WARC-Target-URI", _line(url)))
    if page is not None:
        fields.append((b"X-Page", quote(str(page), safe="").encode()))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is not None:
        more = [(b"WARC-Profile", PROFILE), (b"X-Refers-To-Page", quote(str(first), safe="").encode())]
        if one_first:
            more.append((b"WARC-Refers-To", b"<" + _name(first, digest) + b">"))
        yield _record(b"revisit", _name(page, digest, 1, copy), fields + more, http + b"Content-Length: %d" % len(payload) + END)
        return
    block = http + b"Transfer-Encoding: chunked" + END + chunked(payload, chunk_bytes)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    origin = _name(page, digest, 1, copy)
    if len(parts) == 1:
        yield _record(b"response", origin, fields, block)
        return
    for number, part in enumerate(parts, 1):
        place = [(b"WARC-Segment-Number", b"%d" % number)]
        if number == len(parts):
            place.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        if number == 1:
            yield _record(b"response", origin, fields + place, part)
        else:
            place.append((b"WARC-Segment-Origin-ID", b"<" + origin + b">"))
            yield _record(b"continuation", _name(page, digest, number, copy), place, part)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = 16 << 10,
    chunk_bytes: int = 4 << 10,
    records_a_file: int = 2000,
) -> None:
    """Write a record per page into gzipped archives under ``folder``.

    Of equal payloads of at least 100 bytes the one with the smallest id is a response, the
    others revisit it.  A response whose block exceeds ``segment_bytes`` goes on in continuation
    records.  The rows are written as text whose line end is the blank lines that end a record;
    an archive has at most ``records_a_file`` records, so its size is bounded.

    A NULL payload is empty.  A NULL id is never the smallest: where all ids of a payload are
    NULL each is a response; so are repeated rows with the smallest id.  Where rows share an id
    and a payload their place in the write is part of their records' identifiers, so each row's
    segments are a group of their own.  Ids are of any type that Spark orders and turns into text
    and back.  Other columns are not read.
    """
    body = text_bytes(payload_col)
    narrow = pages.select(F.col(id_col).alias("page"), F.sha2(body, 256).alias("_digest"), F.length(body).alias("_size"))
    rows_of = narrow.groupBy("_digest", "_size", "page").agg(F.count("*").alias("_rows"))
    least = F.min(F.when(F.col("page").isNotNull(), F.struct("page", "_rows")))
    groups = (
        rows_of.groupBy("_digest", "_size").agg(least.alias("_least"), F.sum("_rows").alias("_n")).filter("_n > 1")
        .select("_digest", F.when(F.col("_size") >= LEAST_REVISIT, F.col("_least")).alias("_least"))
    )
    full = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    )
    first = F.col("_least.page")
    one_first = F.coalesce(F.col("_least._rows") == 1, F.lit(False))
    is_first = F.coalesce(F.col("page") == first, F.lit(False))
    alone = F.col("_digest").isNull() | (is_first & one_first)
    joined = full.join(groups, F.col("digest") == F.col("_digest"), "left")
    marked = joined.withColumn("_place", F.monotonically_increasing_id() + 1).select(
        F.col("page").cast("string").alias("page"), "url", "payload", "digest",
        F.when(~is_first, first).cast("string").alias("first"),
        F.when(alone, 0).otherwise(F.col("_place")).alias("copy"), one_first.alias("one_first"),
    )

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        columns = (c.to_pylist() for c in batch.columns)
        return {
            "value": [
                record for *row, copy, one in zip(*columns)
                for record in page_records(*row, segment_bytes, chunk_bytes, copy, one)
            ]
        }

    records = map_batches(marked, rows, "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", END.decode()).option("maxRecordsPerFile", records_a_file).option(
        "compression", "gzip"
    ).text(folder)


def parse_records(archive: io.BufferedIOBase) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    while True:
        line = archive.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := archive.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            fields[name.lower()] = value.strip()
        size = int(fields[b"content-length"])
        block = archive.read(size)
        if len(block) != size or archive.read(len(END)) != END:
            raise ValueError("a record is cut short")
        yield fields, block


def payload_of(block: bytes) -> tuple[bytes | None, int]:
    """The payload of an HTTP response, None without a body, and its length."""
    head, _, body = block.partition(END)
    fields = dict(
        (name.strip().lower(), value.strip().lower())
        for name, _, value in (line.partition(b":") for line in head.split(b"\r\n")[1:])
    )
    if fields.get(b"transfer-encoding") == b"chunked":
        payload = unchunked(body)
        return payload, len(payload)
    length = int(fields.get(b"content-length", b"%d" % len(body)))
    return (body, length) if len(body) == length else (None, length)


_PAGE = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary, complete boolean"
_SEGMENT = "origin string, segment int, total long, block binary"


def _page_row(fields: dict[bytes, bytes], block: bytes) -> dict[str, object]:
    text = lambda name: unquote(fields[name].decode()) if name in fields else None
    digest = fields.get(b"warc-payload-digest", b"").decode().removeprefix("sha256:")
    payload, length = payload_of(block)
    revisit = fields[b"warc-type"] == b"revisit"
    found = digest if revisit else hashlib.sha256(payload or b"").hexdigest()
    return {
        "page_id": text(b"x-page"),
        "url": fields[b"warc-target-uri"].decode() if b"warc-target-uri" in fields else None,
        "record_type": fields[b"warc-type"].decode(), "refers_to": text(b"x-refers-to-page"),
        "payload_bytes": length, "payload_digest": found, "payload": payload,
        "complete": found == digest and (revisit or payload is not None),
    }


def read_archives(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """The pages of the archives under ``folder``: one row per response or revisit record.

    Columns: ``page_id`` and ``refers_to`` of ``id_type``, ``url``, ``record_type``, ``payload_bytes`` and
    ``payload_digest`` (hex SHA-256) of the full payload, ``payload`` (NULL for revisits), and
    ``complete``.  Records that fit one segment are decoded where they are read.  Segments are
    grouped by the identifier of their first record and put in order; when a number is missing or
    the total length differs the row is not ``complete`` and has no payload.  An empty folder
    gives no rows.
    """
    names = [c.split()[0] for c in _PAGE.split(", ")]
    parts = [c.split()[0] for c in _SEGMENT.split(", ")]
    schema = f"{_PAGE}, {_SEGMENT}, head binary"
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")

    target, page_target = arrow_schema(schema), arrow_schema(_PAGE)

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                with gzip.open(io.BytesIO(content.as_py())) as archive:
                    for fields, block in parse_records(archive):
                        if b"warc-segment-number" not in fields:
                            if fields[b"warc-type"] in (b"response", b"revisit"):
                                rows.append(_page_row(fields, block))
                        else:
                            origin = fields.get(b"warc-segment-origin-id", fields[b"warc-record-id"])
                            total = fields.get(b"warc-segment-total-length")
                            first = b"warc-segment-origin-id" not in fields
                            rows.append({
                                "origin": origin.decode(), "segment": int(fields[b"warc-segment-number"]),
                                "total": int(total) if total else None, "block": block,
                                "head": b"\n".join(a + b":" + b for a, b in fields.items()) if first else None,
                            })
                        size += len(block)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, target)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, target)

    def assemble(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["segment"])
        # Repeated rows of a page share their identifier: each segment then comes as often as they do.
        copies = sum(r["segment"] == 1 for r in rows)
        numbers = [r["segment"] for r in rows[:: max(copies, 1)]]
        block = b"".join(r["block"] for r in rows[:: max(copies, 1)])
        head = next((r["head"] for r in rows if r["head"]), b"warc-type:response")
        fields = dict(line.split(b":", 1) for line in head.split(b"\n"))
        total = next((r["total"] for r in rows if r["total"] is not None), None)
        if copies and len(rows) == copies * len(numbers) and numbers == list(range(1, len(numbers) + 1)) and total == len(block):
            row = _page_row(fields, block)
        else:
            row = _page_row(fields, b"HTTP/1.1 200 OK\r\nContent-Length: 0" + END)
            row |= {"payload": None, "payload_bytes": None, "payload_digest": None, "complete": False}
        return pa.Table.from_pylist([row] * max(copies, 1), page_target)

    parsed = raw.mapInArrow(parse, schema)
    whole = parsed.filter("origin IS NULL").select(*names)
    segments = parsed.filter("origin IS NOT NULL").select(*parts, "head")
    found = whole.union(segments.groupBy("origin").applyInArrow(assemble, _PAGE))
    return found.withColumns({name: F.col(name).cast(id_type) for name in ("page_id", "refers_to")})
