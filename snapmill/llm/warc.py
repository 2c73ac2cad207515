"""WARC archives of pages: written with segments, chunked framing and revisits, and read back.

An archive is a gzip file of WARC/1.1 records that Spark's text writer makes: its line separator
is the blank line that ends a record. Blocks beyond SEGMENT_BYTES are cut into a first record and
continuations. Reading groups the segments by the identifier of their origin, orders them by
number, verifies the total length, and decodes the HTTP message and its chunks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.llm.common import bound_batches

#: Bytes of a record's block; longer ones are segmented.
SEGMENT_BYTES = 16 << 10
#: Characters of an HTTP chunk.
CHUNK_CHARS = 4 << 10
#: Records of a file. A file is read by one task, record by record, and takes RECORDS_PER_FILE *
#: SEGMENT_BYTES at most.
RECORDS_PER_FILE = 20_000
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Writing


def chunked(payload: str) -> str:
    """The payload in chunked transfer framing; chunks are cut between characters."""
    parts = (payload[i : i + CHUNK_CHARS] for i in range(0, len(payload), CHUNK_CHARS))
    return "".join(f"{len(p.encode()):x}\r\n{p}\r\n" for p in parts) + "0" + END


def segments(block: str, size: int) -> list[str]:
    """The block in pieces of at most ``size`` bytes, cut between characters."""
    raw, out, start = block.encode(), [], 0
    while len(raw) - start > size:
        end = start + size
        while raw[end] & 0xC0 == 0x80:
            end -= 1
        out.append(raw[start:end].decode())
        start = end
    return [*out, raw[start:].decode()]


def record(kind: str, record_id: str, block: str, fields: dict[str, object]) -> str:
    """A record but for the blank line at its end; fields that are None are left out."""
    lines = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, **fields}
    lines |= {"Content-Length": len(block.encode())}
    head = "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None)
    return f"WARC/1.1\r\n{head}\r\n{block}"


def _uri(url: str | None) -> str | None:
    return None if url is None else "".join(f"%{b:02X}" if b < 0x21 else chr(b) for b in url.encode()).encode("latin-1").decode()


def page_records(row: dict, segment_bytes: int) -> list[str]:
    """The records of a page: page_id, url, html, row, refers_to (with refers_url) or None."""
    name, payload = f"urn:page:{'' if row['page_id'] is None else row['page_id']}:{row['row']}", row["html"]
    fields = {"WARC-Target-URI": _uri(row["url"]), "X-Page-ID": row["page_id"]}
    fields["WARC-Payload-Digest"] = f"sha1:{base32_sha1(payload.encode())}"
    status = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if row["revisit"]:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To-Target-URI": _uri(row["refers_url"])}
        fields |= {"WARC-Refers-To-Date": DATE, "X-Refers-To-Page-ID": row["refers_to"]}
        fields |= {"Content-Type": "application/http;msgtype=response"}
        return [record("revisit", name, f"{status}Content-Length: {len(payload.encode())}{END}", fields)]
    fields |= {"Content-Type": "application/http;msgtype=response"}
    block = f"{status}Transfer-Encoding: chunked{END}{chunked(payload)}"
    parts = segments(block, segment_bytes)
    if len(parts) == 1:
        return [record("response", name, block, fields)]
    out = [record("response", name, parts[0], fields | {"WARC-Segment-Number": 1})]
    for n, part in enumerate(parts[1:], 2):
        last = len(block.encode()) if n == len(parts) else None
        own = {"WARC-Segment-Number": n, "WARC-Segment-Origin-ID": f"<{name}>", "WARC-Segment-Total-Length": last}
        out.append(record("continuation", f"{name}:{n}", part, own))
    return out


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE
) -> None:
    """Write a response or revisit record per page (page_id, url, html) into archives under ``path``.

    Of payloads that are equal and have ``least_bytes`` or more, the page with the smallest page_id
    is the response, and of several the one whose url hashes lowest; rows equal in both are
    responses each. A null html is an empty payload. A null page_id comes after all others.
    """
    bound_batches(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    key = F.struct(F.col("page_id").isNull().alias("unknown"), F.col("page_id"), F.xxhash64("url").alias("mixed"))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), key.alias("key"))
    equal = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest")
    # One row per repeated payload; the join is a plain one that is split at a payload many pages have.
    first = equal.agg(F.min(F.struct("key", "url")).alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(first.select("digest", "first"), "digest", "left").select(
        "page_id",
        "url",
        "html",
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("key") != F.col("first.key"), F.lit(False)).alias("revisit"),
        F.col("first.key.page_id").alias("refers_to"),
        F.col("first.url").alias("refers_url"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = [r for row in batch.slice(start, 512).to_pylist() for r in page_records(row, segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["value"])

    writer = joined.mapInArrow(run, "value string").write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


# Reading


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should start: {line[:60]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
        yield fields, block


def unchunk(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        start = end + 2
        if body[start + size : start + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[start : start + size])
        at = start + size + 2


def http_payload(block: bytes) -> tuple[bytes, dict[bytes, bytes]]:
    """Payload and header fields of an HTTP message, without its transfer framing."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    return (unchunk(body) if fields.get(b"transfer-encoding", b"").lower() == b"chunked" else body), fields


def reassemble(parts: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of segments (number, total length on the last, bytes) in any order, if it is whole."""
    parts = sorted(parts, key=lambda p: p[0])
    block = b"".join(p[2] for p in parts)
    if [p[0] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1][1] != len(block):
        raise ValueError(f"segments {[p[0] for p in parts]} have {len(block)} bytes of {parts[-1][1]}")
    return block


FIELDS = "record_id string, record_type string, target_uri string, page_id string, refers_to string, payload_digest string, payload_bytes long, payload binary"
SEGMENT = "origin string, number int, total long, block binary"
ARROW = pa.schema(
    [*((n, pa.string()) for n in ("record_id", "record_type", "target_uri", "page_id", "refers_to", "payload_digest"))]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)
SEGMENT_ARROW = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])


def _row(fields: dict[str, str], block: bytes) -> dict:
    """A row for a whole record; its digest is that of the payload read, and has to be the one written."""
    payload, http = http_payload(block)
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    found = said if revisit else base32_sha1(payload)
    if said and found != said:
        raise ValueError(f"the payload of {fields['warc-record-id']} has digest {found}, not {said}")
    return {
        "record_id": fields["warc-record-id"][1:-1],
        "record_type": fields["warc-type"],
        "target_uri": fields.get("warc-target-uri"),
        "page_id": fields.get("x-page-id"),
        "refers_to": fields.get("x-refers-to-page-id"),
        "payload_digest": found,
        "payload_bytes": int(http[b"content-length"]) if revisit else len(payload),
        "payload": None if revisit else payload,
    }


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record: record_id, record_type, target_uri, page_id, refers_to,
    payload_digest, payload_bytes, payload.

    A revisit has the digest and length its headers tell and no payload. Records whose segments
    are not all there, whose length is not the one said, or whose digest is wrong fail the job.
    """
    bound_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")

    def scan(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = ARROW if whole else SEGMENT_ARROW
            for batch in batches:
                for content in batch.column(0):
                    rows, size = [], 0
                    for fields, block in records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                        number = fields.get("warc-segment-number")
                        if whole and number is None and fields["warc-type"] in ("response", "revisit"):
                            rows.append(_row(fields, block))
                        elif not whole and number is not None:
                            total = fields.get("warc-segment-total-length")
                            origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                            # The first segment's header goes along, for what it says of the record.
                            head = "".join(f"{k}: {v}\r\n" for k, v in fields.items()) if number == "1" else ""
                            rows.append({"origin": origin, "number": int(number), "total": total and int(total), "block": head.encode() + b"\r\n" + block})
                        size += len(block)
                        if size > SEGMENT_BYTES * 256:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

        return run

    def join_up(rows: pa.Table) -> pa.Table:
        parts, fields = [], {}
        for r in rows.to_pylist():
            head, _, block = r["block"].partition(b"\r\n\r\n") if r["number"] == 1 else (b"", b"", r["block"][2:])
            fields |= {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n") if x)}
            parts.append((r["number"], r["total"], block))
        return pa.Table.from_pylist([_row(fields, reassemble(parts))], ARROW)

    whole = files.mapInArrow(scan(True), FIELDS)
    cut_up = files.mapInArrow(scan(False), SEGMENT).groupBy("origin").applyInArrow(join_up, FIELDS)
    return whole.unionByName(cut_up)
