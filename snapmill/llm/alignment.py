"""Alignment of two tokenizers' tokens over the same bytes.

Every text is encoded by both. pandas ``merge_asof``, keyed by document, finds for each token start
the token of the other side that covers it; both directions together are all overlaps, as of two
tokens that overlap one begins within the other. Byte offsets where tokens of both sides end cut
the text into groups.

How often two ids are linked in the whole corpus is counted by chunk: a chunk of texts lists its
distinct id pairs once, with how often it has them. Those lists are summed by pair, joined with the
sums again, and go back to their chunk, whose documents refer to the list by position.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import bound_batches, shared_table
from snapmill.llm.packing import default_vocabulary, encoder
from snapmill.llm.windows import text_slices

#: Bytes of text of a chunk, and of the slices of it that are aligned at a time. One text is taken whole.
CHUNK, SLICE = 4 << 20, 1 << 20
SPACE_MARK = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """Both tokenizers, the bytes of their tokens and the text of their ids with the mark after them."""

    def __init__(self, vocabulary: str, pieces: str):
        self.a = encoder(vocabulary).fast
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b_ids = self.b.get_piece_size()
        a_bytes = [self._a_bytes(i) for i in range(self.a.max_token_value + 1)]
        self.b_bytes = [self._b_bytes(i) for i in range(self.b_ids)]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (a_bytes, self.b_bytes))
        # Twice the id, plus one for the last token of its side in a group.
        marks = [f"{i}{m}" for i in range(len(a_bytes)) for m in ",|"]
        self.b_marks = len(marks)
        self.marks = marks + [f"{i}{m}" for i in range(self.b_ids) for m in ",;"]

    def _a_bytes(self, i: int) -> bytes:
        try:
            return self.a.decode_single_token_bytes(i)
        except KeyError:  # an id that the vocabulary leaves out or keeps for a special token
            return b""

    def _b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; none if the text is empty or a side does not spell it."""
        if not text:
            return None
        whole = f" {text}"
        spelled = whole.encode()
        a = self.a.encode_ordinary(whole)
        if self.a.decode_bytes(a) != spelled:
            return None
        b = self.b.encode(text)
        if b"".join([self.b_bytes[i] for i in b]) != spelled:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Counts (n_a, n_b, n_groups, n_links) and group text of each row; links as row, pair and times.

        A pair is one number, A's id times the size of B's vocabulary plus B's id. Rows and pairs are in order.
        """
        encoded = [self.encode(t or "") for t in texts]
        rows = [i for i, e in enumerate(encoded) if e is not None]
        counts, groups = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
        if not rows:
            return counts, groups, *(np.empty(0, np.int64),) * 3
        a, b = (np.concatenate([encoded[i][side] for i in rows]) for side in (0, 1))
        n_a, n_b = (np.array([len(encoded[i][side]) for i in rows]) for side in (0, 1))
        # Byte places run on over the rows; both sides of a row have equally many bytes.
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_start, b_start = a_end - self.a_size[a], b_end - self.b_size[b]
        left = pd.DataFrame({"at": a_start, "row": np.repeat(rows, n_a), "a": np.arange(len(a))})
        right = pd.DataFrame({"at": b_start, "row": np.repeat(rows, n_b), "b": np.arange(len(b))})
        under = pd.merge_asof(left, right, on="at", by="row")
        over = pd.merge_asof(right, left, on="at", by="row")
        over = over[a_start[over["a"].to_numpy()] != over["at"].to_numpy()]  # equal starts are in both
        link_row, link_a, link_b = (np.concatenate([under[c].to_numpy(), over[c].to_numpy()]) for c in ("row", "a", "b"))

        ends = np.zeros((2, int(a_end[-1]) + 1), bool)
        ends[0, a_end], ends[1, b_end] = True, True
        a_last, b_last = ends[1, a_end], ends[0, b_end]  # the last of their side in a group
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        # Tokens in the order of the group text: a group's A ids, then its B ids.
        marks = np.empty(len(a) + len(b), np.int64)
        marks[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = 2 * a + a_last
        marks[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = self.b_marks + 2 * b + b_last
        edges = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        for i, start, end in zip(rows, edges, edges[1:]):
            groups[i] = "".join([self.marks[m] for m in marks[start:end].tolist()])[:-1]

        links = np.bincount(link_row, minlength=len(texts))
        counts[rows, 0], counts[rows, 1], counts[:, 3] = n_a, n_b, links
        counts[:, 2] = np.bincount(left["row"].to_numpy()[a_last], minlength=len(texts))
        pair_bits = int(len(self.a_size) * self.b_ids - 1).bit_length()
        found, times = np.unique((link_row << pair_bits) | (a[link_a] * self.b_ids + b[link_b]), return_counts=True)
        return counts, groups, found >> pair_bits, found & ((1 << pair_bits) - 1), times


@lru_cache(maxsize=1)
def aligner(vocabulary: str, pieces: str) -> Aligner:
    """One per Python worker, which many tasks use."""
    return Aligner(vocabulary, pieces)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, compressed: four bytes each, all first bytes before all second bytes."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def align(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None) -> DataFrame:
    """Tokens of both sides of every document, aligned; rows of chunks between them.

    A document's row has doc_id, n_a, n_b, n_groups, n_links, ``groups`` (ids like
    ``a1,a2|b1;a3|b2,b3``), chunk, and in ``places`` and ``times`` the pairs it links, as compressed
    positions in the list of its chunk. A chunk's row has only chunk, ``pairs`` and ``pair_times``;
    ``pairs`` is null in documents' rows. A text that is null, empty, or not spelled by both sides
    has no tokens: zeros and an empty ``groups``. Special tokens' strings in a text are plain text.
    Repeated rows and null ids are rows like others. Only doc_id and text are read, whatever else
    the table has. No documents give no rows.
    """
    files = vocabulary or default_vocabulary(), pieces or default_pieces()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*files)
        made = 0
        for batch in batches:
            for part in text_slices(batch, CHUNK):
                chunk = (part.column(2)[0].as_py() << 32) + made
                made += 1
                parts = [own.align(p.column(1).to_pylist()) for p in text_slices(part, SLICE)]
                listed, place = np.unique(np.concatenate([p[3] for p in parts]), return_inverse=True)
                totals = np.bincount(place, weights=np.concatenate([p[4] for p in parts]), minlength=len(listed)).astype(np.int64)
                places, times, done = [], [], 0
                for counts, _, rows, found, n in parts:
                    edges = np.searchsorted(rows, np.arange(len(counts) + 1)).tolist()
                    for start, end in zip(edges, edges[1:]):
                        at = place[done + start : done + end]
                        places.append(_packed(np.diff(at, prepend=0)))
                        times.append(_packed(n[start:end]))
                    done += len(found)
                counts = np.concatenate([p[0] for p in parts])
                size = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        *(pa.array(counts[:, i]) for i in range(4)),
                        pa.array([g for p in parts for g in p[1]], pa.string()),
                        pa.array(np.full(size, chunk)),
                        pa.array(places, pa.binary()),
                        pa.array(times, pa.binary()),
                        pa.nulls(size, pa.list_(pa.int64())),
                        pa.nulls(size, pa.list_(pa.int64())),
                    ],
                    names,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(1, part.column(0).type),
                        *(pa.nulls(1, pa.int64()) for _ in range(4)),
                        pa.nulls(1, pa.string()),
                        pa.array([chunk]),
                        pa.nulls(1, pa.binary()),
                        pa.nulls(1, pa.binary()),
                        pa.array([listed], pa.list_(pa.int64())),
                        pa.array([totals], pa.list_(pa.int64())),
                    ],
                    names,
                )

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "chunk", "places", "times", "pairs", "pair_times"]
    schema = (
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, chunk long, "
        "places binary, times binary, pairs array<long>, pair_times array<long>"
    )
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(run, schema)


def link_counts(aligned: DataFrame, pieces: str | None = None) -> DataFrame:
    """Documents' rows of ``align`` with n_best and count_sum, without the columns that carry pairs.

    A pair's count is how many links of the corpus hold it. ``count_sum`` adds it over a document's
    links; ``n_best`` counts the links whose pair has the highest count of its B id, ties included.
    Both are 0 without links. ``aligned`` is written once; columns added to it, or ``groups`` taken
    out, are no matter. Only the highest counts are broadcast, one row per id of B's vocabulary.
    """
    pieces = pieces or default_pieces()
    b_ids = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    table = shared_table(aligned, "aligned")
    lists = table.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "pair_times")).alias("place", "entry"))
    lists = lists.select("chunk", "place", F.col("entry.pairs").alias("pair"), F.col("entry.pair_times").alias("n"))
    totals = shared_table(lists.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    best = totals.groupBy((F.col("pair") % b_ids).alias("b")).agg(F.max("total").alias("most"))
    told = totals.join(F.broadcast(best), F.col("pair") % b_ids == F.col("b"))  # at most b_ids rows
    told = told.select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    answers = lists.select("chunk", "place", "pair").join(told, "pair").select(F.col("chunk").alias("to_chunk"), "place", "total", "best")

    kept = [f for f in table.schema.names if f not in ("chunk", "places", "times", "pairs", "pair_times")]

    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        total, best = np.zeros((2, told.num_rows), np.int64)
        place = told.column("place").to_numpy()
        total[place], best[place] = told.column("total").to_numpy(), told.column("best").to_numpy()
        sums, hits = [], []
        for places, times in zip(own.column("places"), own.column("times")):
            at, n = np.cumsum(_unpacked(places.as_py())), _unpacked(times.as_py())
            sums.append(int(n @ total[at]))
            hits.append(int(n @ best[at]))
        out = own.select(kept)
        return out.append_column("n_best", pa.array(hits, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema if f.name in kept)
    own = table.where("pairs IS NULL").select(*kept, "chunk", "places", "times")
    return own.groupBy("chunk").cogroup(answers.groupBy("to_chunk")).applyInArrow(run, f"{fields}, n_best long, count_sum long")
