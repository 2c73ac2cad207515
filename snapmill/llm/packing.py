"""Best-fit packing of tokenised documents by the sum-of-squares rule.

A piece goes where the sum over all gaps of the squared number of open sequences with that gap
becomes smallest. The rule needs the counts by gap alone, 2047 numbers. Pieces are dealt into
groups of bounded size by a hash; each group packs its own sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapmill.llm.common import bound_batches, cut

#: Pieces a group holds on average; a task packs one group at a time. A group leaves a few
#: sequences open, so larger groups waste less.
GROUP_PIECES = 50_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids by a byte-level BPE vocabulary file of ``tokenizers``.

    Merging is done by tiktoken from the vocabulary in that file, several times faster and with
    the same ids; texts that hold one of the file's special tokens go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import public_tokenizers

        self.whole = Tokenizer.from_file(path)
        byte_of = self._byte_alphabet()
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in self.whole.get_vocab(False).items() if t not in special}
        self.special = sorted(special)
        self.fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _byte_alphabet() -> dict[str, int]:
        """The characters that stand for bytes: printable Latin-1 for itself, the others from U+0100 on."""
        shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        hidden = [b for b in range(256) if b not in shown]
        return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4")


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker, which many tasks use."""
    return Encoder(path)


def pieces(docs: DataFrame, capacity: int, vocabulary: str) -> DataFrame:
    """One row per piece: doc_id, row, piece, start, length, ids_crc32; id 0 ends each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for at, text in enumerate(batch.column(2)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(0)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(at, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
            at, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.empty(0, np.int64)] * 5
            where = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(where), batch.column(1).take(where), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                ["doc_id", "row", "piece", "start", "length", "ids_crc32"],
            )

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, row long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, dealt in the given order.

    Moving a sequence from gap g to g - s changes the sum of squares by 2 (n[g - s] - n[g] + 1);
    gaps 0 (full) and ``capacity`` (not yet opened) do not count. Of equal changes the tightest
    gap is taken.
    """
    n = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened, never = 0, np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        change = np.where(n[s:] > 0, 2 * (n[: capacity + 1 - s] - n[s:] + 1), never)
        if n[s]:
            change[0] = 1 - 2 * n[s]
        change[-1] = 2 * n[capacity - s] + 1 if s < capacity else 0
        gap = s + int(change.argmin())
        if gap == capacity:
            at, opened = opened, opened + 1
        else:
            at = open_at[gap].pop()
            n[gap] -= 1
        sequence[i], offset[i] = at, capacity - gap
        if gap > s:
            open_at[gap - s].append(at)
            n[gap - s] += 1
    return sequence, offset


def pack(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and an id 0; null text counts as empty, so it is a single id 0.
    Documents longer than ``capacity`` are cut into pieces of that length, the first of which may
    be shorter. Offsets within a sequence are gapless from 0. Repeated rows are packed as often as
    they occur; a null doc_id is packed like any other; ties go to the tighter gap. Only doc_id
    and text are read. No documents give no rows.
    """
    rows = cut(pieces(docs, capacity, vocabulary or default_vocabulary()))
    groups = max(1, -(-rows.count() // group_pieces))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        sequence, offset = sum_of_squares(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=(np.int64(key[0]) << 32) + sequence, offset=offset)[names]

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return rows.groupBy("group").applyInPandas(run, schema)
