import base64
import gzip
import hashlib
import io
import random
from pathlib import Path

import pytest

from snapmill.llm.common import shared_path
from snapmill.llm.warc import chunked, http_payload, read_archives, reassemble, records, segments, unchunk, write_archives

NASTY = ["", None, "é" * 9_000, "WARC/1.1\r\n\r\nx" * 700, "a\r\n\r\n" * 5_000, "0\r\n\r\n", "\x00\n", "𝄞" * 6_000, "plain"]


def round_trip(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, key string, row string")
    path = shared_path(spark, "warc-test")
    write_archives(df, path, **options)
    return path, read_archives(spark, path).collect()


@pytest.mark.parametrize("options", [{}, {"segment_bytes": 64, "records_per_file": 50}, {"least_bytes": 100}])
def test_round_trip(spark, options):
    odds = random.Random(1)
    rows = [(i, f"http://h/{i} x\r\ny" if i % 4 else None, odds.choice(NASTY), "d", "k", "r") for i in range(80)]
    rows += [(None, "http://n", "plain", None, None, None), (200, "u", "only here", None, None, None)]
    _, found = round_trip(spark, rows, **options)
    least = {}
    for i, _, html, *_ in rows:
        if i is not None and len((html or "").encode()) >= options.get("least_bytes", 0):
            least[html or ""] = min(i, least.get(html or "", i))
    want = []
    for i, _, html, *_ in rows:
        payload = (html or "").encode()
        first = least.get(html or "")
        revisit = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append(repr((str(i) if i is not None else None, len(payload), digest, "revisit" if revisit else "response", str(first) if revisit else None, None if revisit else payload)))
    got = [repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))) for r in found]
    assert sorted(got) == sorted(want)


def test_rows_that_repeat_and_no_rows(spark):
    _, found = round_trip(spark, [(1, "u", "x" * 50_000, *"abc")] * 3)
    assert [r.record_type for r in found] == ["response"] * 3
    assert round_trip(spark, [])[1] == []


def test_archives_are_plain_warc(spark):
    path, _ = round_trip(spark, [(i, f"http://h/{i}", "é" * 20_000 + str(i // 2), *"abc") for i in range(6)])
    seen = []
    for file in Path(path.removeprefix("file:")).glob("*.gz"):
        raw = gzip.decompress(file.read_bytes())
        assert raw.endswith(b"\r\n\r\n")
        seen += [f["warc-type"] for f, _ in records(io.BytesIO(raw))]
    assert seen.count("response") == 3 and seen.count("revisit") == 3 and seen.count("continuation") == 6


def test_segments_are_verified():
    block = "é" * 100
    parts = [(n, None, p.encode()) for n, p in enumerate(segments(block, 33), 1)]
    parts[-1] = (parts[-1][0], len(block.encode()), parts[-1][2])
    assert all(len(p[2]) <= 33 for p in parts)
    assert reassemble(parts[::-1]) == block.encode()
    for broken in (parts[:-1], parts[1:], parts[:2] + parts[3:], [*parts[:-1], (parts[-1][0], 7, parts[-1][2])]):
        with pytest.raises(ValueError):
            reassemble(broken)


def test_chunks():
    for text in ("", "abc", "é" * 10_000):
        assert unchunk(chunked(text).encode()) == text.encode()
    assert unchunk(b"3;x=1\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    assert http_payload(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody")[0] == b"body"
    with pytest.raises(ValueError):
        unchunk(b"2\r\nabc\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))
    with pytest.raises(ValueError):
        list(records(io.BytesIO(b"no archive\r\n")))
