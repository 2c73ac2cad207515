"""Removal of word passages that repeat across documents, by fixed-block anchors.

Reference blocks are the runs of BLOCK words at every BLOCK-th place of a document. A window of
2 * BLOCK - 1 words always holds a whole one, so whatever repeats a window also repeats a block at
some place. All rolling runs of BLOCK words are probed against the blocks; where a run meets a
block, the hit is extended: every window that holds the run is looked up as a whole, and the runs
of windows that are found make up the maximal exact repeats.

Documents are dealt into chunks by a hash, and a chunk is read as one array of word hashes. A
chunk sends each distinct hash once, however often a passage occurs in it, to the bucket that
hashes of its range belong to, and gets one bit back for each. So what meets at a bucket for the
most frequent passage is one entry per chunk. Texts are shuffled once, and only to their chunk.

With many chunks a bucket would get very many very short messages. From RELAY_FROM chunks on messages
go through relays: a chunk sends one message per range of buckets, a relay holds the messages of a
group of chunks for a range and sends each bucket of the range one message, and answers go back the
same way. With the square root of all chunks in a group, and of all buckets in a range, a relay holds about
as much as a chunk or a bucket, and what any task receives grows with the square root of the input.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import bound_batches, collapsed
from snapmill.llm.windows import Powers, mix, rolling, span_hashes, spans, text_bytes

#: Bytes of text of a chunk and of the share of a bucket. A task holds one chunk or one bucket,
#: some ten times that size.
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
#: Chunks from which messages are relayed.
RELAY_FROM = 4096
#: Bits of an anchor's hash that are sent, beside those that its bucket tells; wrong hits are
#: found out when they are extended.
ANCHOR_BITS = 38
ANCHOR_BYTES = 5
SECOND_BASE = 0xC2B2AE3D27D4EB4F

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Messages to a bucket, or to the relay of a range of buckets, which get the entries of each bucket in ``parts``.
HASHES = "bucket int, chunk int, codes binary, ids binary, counts binary, live binary, parts binary"
BITS = "chunk int, bucket int, bits binary, live binary"


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; larger hashes have larger buckets."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def slices(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, end) of the runs of a sorted array."""
    edges = np.flatnonzero(np.diff(sorted_buckets, prepend=-1, append=-1))
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(sorted_buckets[start]), start, end


class Chunk:
    """The documents of a chunk in order of doc_id, as arrays of words."""

    def __init__(self, rows: pa.Table, window: int):
        self.rows = rows.sort_by([("doc_id", "ascending"), ("digest", "ascending")]).combine_chunks()
        self.window, self.block = window, (window + 1) // 2
        self.text = self.rows["text"].combine_chunks() if self.rows.num_rows else pa.array([], pa.string())
        if isinstance(self.text, pa.ChunkedArray):
            self.text = pa.concat_arrays(self.text.chunks)
        data, edges = text_bytes(self.text)
        self.powers = Powers()
        start, end = spans(~SPACE[data], edges)
        self.row = np.searchsorted(edges, start, "right") - 1
        self.words = np.bincount(self.row, minlength=self.rows.num_rows)
        self.first = np.cumsum(self.words) - self.words
        self.hash = span_hashes(data, start, end, self.powers)
        # Documents without an id are neither references nor probes.
        known = ~np.asarray(self.rows["doc_id"].is_null())
        self.ids = np.asarray(self.rows["doc_id"].fill_null(0)).astype(np.int64)
        self.known = known[self.row] if len(self.row) else np.empty(0, bool)

    def starts(self, width: int) -> np.ndarray:
        """Words at which a run of ``width`` words of one document starts."""
        n = len(self.row) - width + 1
        if n <= 0:
            return np.empty(0, np.int64)
        return np.flatnonzero((self.row[:n] == self.row[width - 1 :]) & self.known[:n])

    def anchors(self) -> None:
        """Distinct rolling runs of BLOCK words (sorted), and where each start has its run."""
        self.at = self.starts(self.block)
        hashes = rolling(self.hash, self.block, self.powers)[self.at]
        self.anchor, self.which, self.times = np.unique(hashes, return_inverse=True, return_counts=True)
        place = self.at - self.first[self.row[self.at]]
        self.aligned = np.zeros(len(self.anchor), bool)
        self.aligned[self.which[place % self.block == 0]] = True

    def candidates(self, live: np.ndarray) -> None:
        """Distinct windows that hold a live anchor, in the order they are sent, and where they start."""
        marks = np.zeros(len(self.row) + 1, np.int64)
        marks[self.at[live[self.which]]] = 1
        marks = np.concatenate(([0], np.cumsum(marks)))
        starts = self.starts(self.window)
        starts = starts[marks[starts + self.block] > marks[starts]]
        hashes = rolling(self.hash, self.window, self.powers)[starts]
        # Rows are in order of doc_id, so the first start of a window is in its smallest document.
        values, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        least = self.row[starts[first]]
        order = np.lexsort((values, least, buckets_of(values, self.buckets)))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.window_at, self.window_which = starts, back[which]
        self.window_hash, self.window_least = values[order], least[order]
        self.window_second = self._second(starts[first[order]])

    def _second(self, starts: np.ndarray) -> np.ndarray:
        both = rolling(mix(self.hash + np.uint64(SECOND_BASE)), self.window, Powers(SECOND_BASE))
        return (both[starts] >> np.uint64(32)).astype(np.uint32)


def pack_anchors(chunk: Chunk) -> np.ndarray:
    """ANCHOR_BYTES bytes for each anchor: hash bits, whether it is a block, whether it occurs again."""
    low = chunk.anchor & np.uint64((1 << ANCHOR_BITS) - 1)
    codes = (low << np.uint64(2)) | (chunk.aligned.astype(np.uint64) << np.uint64(1)) | (chunk.times > 1)
    return codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ANCHOR_BYTES]


def unpack_anchors(blobs: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, ANCHOR_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :ANCHOR_BYTES] = raw
    return out.view("<u8").ravel()


def live_anchors(codes: np.ndarray) -> np.ndarray:
    """Which entries of a bucket occur more than once in all, at least once as a block."""
    order = np.argsort(codes >> np.uint64(2))
    ordered = codes[order]
    key = ordered >> np.uint64(2)
    run = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    size = np.diff(run, append=len(key))
    flags = np.bitwise_or.reduceat(ordered & np.uint64(3), run) if len(run) else np.empty(0, np.uint64)
    good = ((flags & np.uint64(2)) > 0) & ((size > 1) | ((flags & np.uint64(1)) > 0))
    out = np.empty(len(codes), bool)
    out[order] = np.repeat(good, size)
    return out


def preceded(hashes: np.ndarray, second: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which entries of a bucket have an equal one with a smaller id."""
    order = np.lexsort((ids, second, hashes))
    h, s, i = hashes[order], second[order], ids[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
    run = np.flatnonzero(fresh)
    out = np.empty(len(h), bool)
    out[order] = i > np.repeat(i[run], np.diff(run, append=len(h)))
    return out


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def pack_windows(hashes: np.ndarray, second: np.ndarray, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Codes, and the ids of the documents with the lengths of their runs."""
    run = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.empty(0, np.int64)
    counts = np.diff(run, append=len(ids)).astype(np.int32)
    return hashes.tobytes() + second.tobytes(), ids[run].tobytes(), counts.tobytes()


def unpack_windows(codes: bytes, ids: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(codes) // 12
    runs = np.repeat(np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int32))
    return np.frombuffer(codes, np.uint64, n), np.frombuffer(codes, np.uint32, n, 8 * n), runs


def pack_parts(buckets: np.ndarray, first: int, span: int) -> bytes:
    """How many entries each bucket of a range has."""
    return zlib.compress(np.bincount(buckets - first, minlength=span).astype("<u4").tobytes(), 1)


def unpack_parts(parts: bytes) -> np.ndarray:
    """The bucket within its range of each entry."""
    sizes = np.frombuffer(zlib.decompress(parts), "<u4").astype(np.int64)
    return np.repeat(np.arange(len(sizes)), sizes)


def relay_order(rows: pa.Table) -> tuple[pa.Table, list[np.ndarray], np.ndarray, np.ndarray]:
    """The messages a relay holds by chunk, the bucket of each of their entries, the order of all
    entries by bucket, and the buckets in that order."""
    rows = rows.sort_by("chunk")
    own = [unpack_parts(p) for p in rows["parts"].to_pylist()]
    every = np.concatenate(own)
    order = np.argsort(every, kind="stable")
    return rows, own, order, every[order]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


HASHES_ARROW = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int32()), *((c, pa.binary()) for c in ("codes", "ids", "counts", "live", "parts"))]
)
BITS_ARROW = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary()), ("live", pa.binary())])


def repeats(
    docs: DataFrame,
    window: int = 13,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    relay_from: int = RELAY_FROM,
) -> DataFrame:
    """One row per document: doc_id, n_words, spans (start, end) of words to remove, kept_text.

    Words are runs of anything but ASCII white space. A word is removed if a window of ``window``
    words that covers it also starts in a document with a smaller doc_id; windows are judged on
    the input. The spans are maximal and in order, the kept words are joined by one space. Null
    text has no words. A null doc_id is neither smaller nor larger than another: nothing is
    removed there, or because of it. Rows of one doc_id do not precede each other; rows that repeat
    doc_id and text are read once and returned as often as they are there. Only doc_id (an integer)
    and text are read. No documents give no rows.
    """
    if window % 2 == 0:
        raise ValueError("a window has 2 * block - 1 words, an odd number")
    bound_batches(docs.sparkSession)
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = (max(1, -(-size // b)) for b in (chunk_bytes, bucket_bytes))
    # Chunks of a group and buckets of a range that share a relay; 1 and 1 without relays.
    relayed = chunks >= relay_from
    group, span = (math.isqrt(chunks - 1) + 1, math.isqrt(buckets - 1) + 1) if relayed else (1, 1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    digest = F.xxhash64("text")
    chunked = collapsed(docs).select(
        F.pmod(F.xxhash64("doc_id", digest), F.lit(chunks)).cast("int").alias("chunk"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        digest.alias("digest"),
        "n",
    )

    def read(rows: pa.Table) -> Chunk:
        chunk = Chunk(rows, window)
        chunk.buckets = buckets
        chunk.anchors()
        return chunk

    def bits_by_bucket(entry_buckets: np.ndarray, replies: pa.Table) -> np.ndarray:
        out = np.zeros(len(entry_buckets), bool)
        bits = dict(zip(replies["bucket"].to_pylist(), replies["bits"].to_pylist()))
        for bucket, start, end in slices(entry_buckets):
            out[start:end] = _flags(bits[bucket], end - start)
        return out

    def send_anchors(key: tuple, rows: pa.Table) -> pa.Table:
        chunk = read(rows)
        codes, own = pack_anchors(chunk), buckets_of(chunk.anchor, buckets)
        return _table(
            [
                (b, key[0].as_py(), codes[i:j].tobytes(), None, None, None, pack_parts(own[i:j], b * span, span) if relayed else None)
                for b, i, j in slices(own // span)
            ],
            HASHES_ARROW,
        )

    def relay_anchors(key: tuple, rows: pa.Table) -> pa.Table:
        rows, _, order, own = relay_order(rows)
        raw = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.uint8).reshape(-1, ANCHOR_BYTES)[order]
        return _table(
            [(key[0].as_py() * span + b, key[1].as_py(), raw[i:j].tobytes(), None, None, None, None) for b, i, j in slices(own)],
            HASHES_ARROW,
        )

    def relay_windows(key: tuple, rows: pa.Table) -> pa.Table:
        rows, _, order, own = relay_order(rows)
        found = [unpack_windows(r["codes"], r["ids"], r["counts"]) for r in rows.select(["codes", "ids", "counts"]).to_pylist()]
        every = [np.concatenate(column)[order] for column in zip(*found)]
        return _table(
            [
                (key[0].as_py() * span + b, key[1].as_py(), *pack_windows(*(c[i:j] for c in every)), None, None)
                for b, i, j in slices(own)
            ],
            HASHES_ARROW,
        )

    def relay_back(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        rows, parts, order, own = relay_order(rows)
        bits = dict(zip(replies["bucket"].to_pylist(), replies["bits"].to_pylist()))
        flags = np.empty(len(order), bool)
        for b, i, j in slices(own):
            flags[order[i:j]] = _flags(bits[key[0].as_py() * span + b], j - i)
        edges = np.cumsum([0, *map(len, parts)]).tolist()
        return _table(
            [
                (chunk, key[0].as_py(), _bits(flags[i:j]), live)
                for chunk, live, i, j in zip(rows["chunk"].to_pylist(), rows["live"].to_pylist(), edges, edges[1:])
            ],
            BITS_ARROW,
        )

    def answer_anchors(key: tuple, rows: pa.Table) -> pa.Table:
        blobs = rows["codes"].to_pylist()
        edges = np.cumsum([0] + [len(b) // ANCHOR_BYTES for b in blobs])
        live = live_anchors(unpack_anchors(blobs))
        return _table(
            [(c, key[0].as_py(), _bits(live[i:j]), None) for c, i, j in zip(rows["chunk"].to_pylist(), edges, edges[1:])],
            BITS_ARROW,
        )

    def send_windows(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = read(rows)
        live = bits_by_bucket(buckets_of(chunk.anchor, buckets) // span, replies)
        chunk.candidates(live)
        out, own = [], buckets_of(chunk.window_hash, buckets)
        for b, i, j in slices(own // span):
            packed = pack_windows(chunk.window_hash[i:j], chunk.window_second[i:j], chunk.ids[chunk.window_least[i:j]])
            parts = pack_parts(own[i:j], b * span, span) if relayed else None
            out.append((b, key[0].as_py(), *packed, None if out else _bits(live), parts))
        return _table(out, HASHES_ARROW)

    def answer_windows(key: tuple, rows: pa.Table) -> pa.Table:
        hashes, second, ids, edges = [], [], [], [0]
        for row in rows.select(["codes", "ids", "counts"]).to_pylist():
            h, s, i = unpack_windows(row["codes"], row["ids"], row["counts"])
            hashes.append(h)
            second.append(s)
            ids.append(i)
            edges.append(edges[-1] + len(h))
        later = preceded(np.concatenate(hashes), np.concatenate(second), np.concatenate(ids))
        return _table(
            [
                (c, key[0].as_py(), _bits(later[i:j]), live)
                for c, live, i, j in zip(rows["chunk"].to_pylist(), rows["live"].to_pylist(), edges, edges[1:])
            ],
            BITS_ARROW,
        )

    def remove(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = read(rows)
        covered = np.zeros(len(chunk.row) + 1, np.int64)
        if replies.num_rows:
            live = next(b for b in replies["live"].to_pylist() if b is not None)
            chunk.candidates(_flags(live, len(chunk.anchor)))
            later = bits_by_bucket(buckets_of(chunk.window_hash, buckets) // span, replies)
            which, at = chunk.window_which, chunk.window_at
            gone = at[later[which] | (chunk.ids[chunk.row[at]] > chunk.ids[chunk.window_least[which]])]
            np.add.at(covered, gone, 1)
            np.add.at(covered, gone + window, -1)
        drop = np.cumsum(covered)[:-1] > 0
        found, kept = [], []
        for text, first, n in zip(chunk.text, chunk.first.tolist(), chunk.words.tolist()):
            words, own = text.as_py().encode().split(), drop[first : first + n]
            if own.any():
                edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
                found.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                words = compress(words, ~own)
            else:
                found.append([])
            kept.append(b" ".join(words).decode())
        passages = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": chunk.rows["doc_id"],
                "n_words": pa.array(chunk.words, pa.int64()),
                "spans": pa.array(found, passages),
                "kept_text": pa.array(kept, pa.string()),
                "n": chunk.rows["n"],
            }
        )

    def answered(messages: DataFrame, relay, answer) -> DataFrame:
        """The bits of every message, from its bucket, or by the relays to it and back."""
        if not relayed:
            return messages.groupBy("bucket").applyInArrow(answer, BITS)
        relays = messages.groupBy(F.col("bucket").alias("range"), F.expr(f"chunk div {group}").cast("int").alias("of"))
        replies = relays.applyInArrow(relay, HASHES).groupBy("bucket").applyInArrow(answer, BITS)
        back = replies.groupBy(F.expr(f"bucket div {span}").cast("int").alias("range"), F.col("chunk").alias("of"))
        return relays.cogroup(back).applyInArrow(relay_back, BITS)

    anchors = chunked.groupBy("chunk").applyInArrow(send_anchors, HASHES)
    live = answered(anchors, relay_anchors, answer_anchors)
    windows = chunked.groupBy("chunk").cogroup(live.groupBy("chunk")).applyInArrow(send_windows, HASHES)
    later = answered(windows, relay_windows, answer_windows)
    found = (
        chunked.groupBy("chunk")
        .cogroup(later.groupBy("chunk"))
        .applyInArrow(remove, f"doc_id {kind}, n_words long, spans array<struct<start: long, end: long>>, kept_text string, n long")
    )
    # as often as the row is repeated
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    return found.withColumn("n", copies).drop("n")
