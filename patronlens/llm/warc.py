"""Web archives: writing pages as WARC records, reading them back, joining their segments.

A record is one line of Spark's text writer with ``CRLF CRLF`` as line end, which is how
WARC closes records; files are committed by Spark and a lost task is written again.
Reading follows Content-Length and never looks for line ends in a block.

Blocks are HTTP responses with chunked transfer framing. One above ``SEGMENT`` bytes is split:
a first record and continuations, which name its id and carry their number, the last
one also the total length. Reading groups them by origin, orders them by number, checks
that none is missing and that the total fits, and decodes the framing; the payload must
have the digest that was written. Of equal payloads one is written as response and the
others as revisits without payload.

Defined results: a null html is an empty payload; a null page_id is smaller than any and
comes back null; of rows that repeat the largest page_id of a payload all are responses; a
url may hold any character and is escaped in headers; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.operators.lineage import settle

SEGMENT = 16_384  # bytes of a block in one record
CHUNK = 4_096  # bytes of a chunk of the transfer framing
RECORDS_PER_FILE = 1_000  # so a file is at most some 17 MB before compression
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_END = b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def to_chunks(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0" + _END


def from_chunks(body: bytes) -> bytes:
    """Payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)  # trailer fields may follow
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut or too long")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, mark, body = block.partition(_END)
    if not mark:
        raise ValueError("HTTP header has no end")
    fields = dict(_field(line) for line in head.split(b"\r\n")[1:])
    return from_chunks(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def _field(line: bytes) -> tuple[str, str]:
    name, _, value = line.decode("utf-8", "replace").partition(":")
    return name.strip().lower(), value.strip()


def record(kind: str, record_id: str, block: bytes, **fields: object) -> bytes:
    """A record without its closing line ends. Fields that are None are left out."""
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE}
    named |= {name.replace("_", "-"): value for name, value in fields.items() if value is not None}
    head = "".join(f"{name}: {value}\r\n" for name, value in (named | {"Content-Length": len(block)}).items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page: a revisit if it refers to another, else a response in one or more segments."""
    record_id = f"urn:uuid:{uuid.uuid4()}"
    common = {
        "WARC_Target_URI": None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"),
        "WARC_Payload_Digest": f"sha1:{base32_sha1(payload)}",
        "X_Page_Id": page_id,
    }
    if refers_to is not None:
        yield record(
            "revisit", record_id, _HTTP + b"\r\n", **common, Content_Type="application/http;msgtype=response",
            WARC_Profile=_PROFILE, X_Refers_To_Page_Id=refers_to,
        )
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + to_chunks(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    many = len(parts) > 1
    yield record(
        "response", record_id, parts[0], **common, Content_Type="application/http;msgtype=response",
        WARC_Segment_Number=1 if many else None,
    )
    for i, part in enumerate(parts[1:], 2):
        yield record(
            "continuation", f"urn:uuid:{uuid.uuid4()}", part, WARC_Segment_Origin_ID=f"<{record_id}>", WARC_Segment_Number=i,
            WARC_Segment_Total_Length=len(block) if i == len(parts) else None,
        )


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        end = archive.index(_END, at)
        version, *lines = archive[at:end].split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(map(_field, lines))
        start = end + len(_END)
        stop = start + int(fields["content-length"])
        if archive[stop : stop + len(_END)] != _END:
            raise ValueError(f"record at byte {at} is cut")
        yield fields, archive[start:stop]
        at = stop + len(_END)


def write(pages: DataFrame, path: str, segment: int = SEGMENT, least: int = 0) -> None:
    """Write every row of ``pages`` (page_id, url, html) as records below ``path``.

    Equal payloads of at least ``least`` bytes are stored once, with the largest page_id.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    groups = settle(rows.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))).where("n > 1")
    # Only payloads that occur again look up their group; the join may split a payload with many rows.
    joined = rows.join(groups, "digest", "left")
    again = (F.col("n") > 1) & (F.length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    roles = joined.select("page_id", "url", "payload", F.when(again, F.col("first")).alias("refers_to"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                out += records(*(x.as_py() for x in row), segment)
                size += len(row[2].as_buffer() or b"")
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = roles.mapInArrow(build, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", _END.decode()).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


_FIELDS = "origin string, segment int, total long, page_id long, kind string, digest string, refers_to long, size long, block binary"


def _read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives; whole responses are decoded at once, segments keep their block."""
    number = lambda text: None if text is None else int(text)
    schema = pa.schema([
        ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()), ("kind", pa.string()),
        ("digest", pa.string()), ("refers_to", pa.int64()), ("size", pa.int64()), ("block", pa.binary()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for f, block in parse(gzip.decompress(content.as_buffer())):
                    segment, size, digest = number(f.get("warc-segment-number")), None, f.get("warc-payload-digest", ":").partition(":")[2]
                    if f["warc-type"] == "response" and segment is None:
                        size, block = _checked(http_payload(block), digest), None
                    elif f["warc-type"] == "revisit":
                        block = None
                    rows.append((
                        f.get("warc-segment-origin-id", f["warc-record-id"]), segment, number(f.get("warc-segment-total-length")),
                        number(f.get("x-page-id")), f["warc-type"], digest, number(f.get("x-refers-to-page-id")), size, block,
                    ))
                columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return settle(files.mapInArrow(read, _FIELDS))


def _checked(payload: bytes, digest: str) -> int:
    if base32_sha1(payload) != digest:
        raise ValueError(f"payload does not have the digest {digest}")
    return len(payload)


def assemble(segments: list[dict]) -> bytes:
    """Block of a segmented record, from its (segment, total, block) in any order."""
    ordered = sorted(segments, key=lambda s: s["segment"])
    if [s["segment"] for s in ordered] != list(range(1, len(ordered) + 1)):
        raise ValueError("a segment is missing or there twice")
    block = b"".join(s["block"] for s in ordered)
    if ordered[-1]["total"] != len(block):
        raise ValueError(f"segments have {len(block)} bytes, not {ordered[-1]['total']}")
    return block


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page below ``path``."""
    found = _read_records(spark, path)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            sizes = [
                _checked(http_payload(assemble(parts.as_py())), digest)
                for parts, digest in zip(batch.column("parts"), digests, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(digests, pa.string()), pa.array(sizes, pa.int64())], ["page_id", "digest", "size"]
            )

    # All segments of one page, which are as large as the page.
    origins = found.where("segment IS NOT NULL").groupBy("origin").agg(
        F.max("page_id").alias("page_id"), F.max(F.when(F.col("segment") == 1, F.col("digest"))).alias("digest"),
        F.collect_list(F.struct("segment", "total", "block")).alias("parts"),
    ).select("page_id", "digest", "parts")
    joined = origins.mapInArrow(join, "page_id long, digest string, size long")
    whole = found.where("kind = 'response' AND segment IS NULL").select("page_id", "digest", "size")
    responses = settle(whole.unionByName(joined))
    sizes = settle(responses.groupBy("digest").agg(F.max("size").alias("size")))
    revisits = found.where("kind = 'revisit'").select("page_id", "digest", "refers_to").join(sizes, "digest")
    shape = lambda rows, kind, refers: rows.select(
        "page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.lit(kind).alias("record_type"), refers.cast("long").alias("refers_to"),
    )
    return shape(responses, "response", F.lit(None)).unionByName(shape(revisits, "revisit", F.col("refers_to")))
