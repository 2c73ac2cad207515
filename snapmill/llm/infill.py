"""Fill-in-the-middle documents by rotating blocks in place.

A text is cut into prefix, middle and suffix at two of its unit borders. The sentinels are
inserted into a bytearray of the text, which gives prefix, middle, suffix in text order; the form
wanted is reached by exchanging two neighbouring blocks, and two blocks are exchanged by three
reversals: each by itself, then both together. Undoing the same exchange and taking the sentinels
out gives the text back, byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import bound_batches
from snapmill.llm.windows import text_bytes, text_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Percent of texts that are transformed, and of these, percent with the suffix first.
RATE, SPM_RATE = 90, 20
#: Bytes of text whose unit borders are looked for at a time, and bytes a reversal swaps at a time.
SLICE, BLOCK = 1 << 20, 1 << 16

LETTER = np.zeros(256, bool)
LETTER[[b for b in range(256) if chr(b).isascii() and chr(b).isalpha()]] = True


def reverse(data: np.ndarray, start: int, end: int) -> None:
    """Reverse ``data[start:end]`` in place, with BLOCK bytes of room."""
    half = (end - start) // 2
    for at in range(0, half, BLOCK):
        size = min(BLOCK, half - at)
        low, high = data[start + at : start + at + size], data[end - at - size : end - at]
        turned = low[::-1].copy()
        low[:] = high[::-1]
        high[:] = turned


def exchange(text: bytearray, start: int, border: int, end: int) -> None:
    """Exchange the blocks ``[start, border)`` and ``[border, end)`` in place."""
    data = np.frombuffer(text, np.uint8)
    reverse(data, start, border)
    reverse(data, border, end)
    reverse(data, start, end)


def transform(text: bytes, first: int, second: int, form: str) -> bytes:
    """The text in the given form, cut at the two byte positions."""
    if form == PLAIN:
        return text
    out = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        out[at:at] = sentinel
    suffix = second + len(PREFIX) + len(MIDDLE)
    exchange(out, first + len(PREFIX) if form == PSM else 0, suffix, len(out))
    return bytes(out)


def invert(output: bytes, form: str) -> bytes:
    """The text of which ``transform`` made the output. A sentinel occurs nowhere else in it."""
    if form == PLAIN:
        return output
    text = bytearray(output)
    if form == PSM:
        exchange(text, text.index(SUFFIX), text.index(MIDDLE), len(text))
    else:
        exchange(text, 0, text.index(PREFIX), len(text))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = text.index(sentinel)
        del text[at : at + len(sentinel)]
    return bytes(text)


def _random_numbers(seed: int) -> list[Column]:
    """Four numbers below 2^32 from the seed and the decimal id; a null id is the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = 1) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output.

    Units are runs of ASCII letters and all other single characters; ``n`` counts them. Both cuts
    and the form follow from ``seed`` and ``doc_id`` alone, so repeated rows give equal rows and
    rows that share a doc_id, null ids included, share their random numbers. Null text counts as
    empty. Empty texts and texts that hold a sentinel stay plain; a plain row has null
    ``prefix_chars`` and ``middle_chars``. Where both cuts fall together, the middle is empty.
    Only doc_id and text are read, whatever else the table has. No documents give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, SLICE):
                yield _transformed(part, rate, spm_rate)

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *_random_numbers(seed))
    return rows.mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def _transformed(batch: pa.RecordBatch, rate: int, spm_rate: int) -> pa.RecordBatch:
    data, edges = text_bytes(batch.column(1))
    h1, h2, h3, h4 = (batch.column(i).to_numpy() for i in range(2, 6))
    starts, ends = edges[:-1], edges[1:]

    char = (data & 0xC0) != 0x80
    letter = LETTER[data]
    opens = char.copy()
    opens[1:] &= ~(letter[1:] & letter[:-1])
    opens[starts[starts < len(data)]] = True
    # Borders of all units of all rows, and how many characters begin before each byte.
    borders = np.flatnonzero(opens)
    first_unit, last_unit = np.searchsorted(borders, starts), np.searchsorted(borders, ends)
    n = last_unit - first_unit
    chars = np.concatenate([[0], np.cumsum(char, dtype=np.int64)])

    def position(units: np.ndarray) -> np.ndarray:
        """Byte position of the border after so many units of each row."""
        at = np.concatenate([borders, [len(data)]])[np.minimum(first_unit + units, len(borders))]
        return np.where(units == n, ends, at)

    cut1, cut2 = h1 % (n + 1), h2 % (n + 1)
    low, high = position(np.minimum(cut1, cut2)), position(np.maximum(cut1, cut2))
    texts = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    forms = [
        PLAIN if skip or not t or any(s in t for s in (PREFIX, SUFFIX, MIDDLE)) else SPM if spm else PSM
        for t, skip, spm in zip(texts, h3 % 100 >= rate, h4 % 100 < spm_rate)
    ]
    cut = pa.array([f == PLAIN for f in forms], pa.bool_())
    output = [transform(t, a, b, f) for t, a, b, f in zip(texts, (low - starts).tolist(), (high - starts).tolist(), forms)]
    nothing = pa.scalar(None, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(n.astype(np.int64)),
            pa.array(forms, pa.string()),
            pa.compute.if_else(cut, nothing, pa.array(chars[low] - chars[starts])),
            pa.compute.if_else(cut, nothing, pa.array(chars[high] - chars[low])),
            pa.array(output, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def restored(output: Column, form: Column) -> Column:
    """The text behind an output and its form; null where the output is null."""

    @F.pandas_udf("string")
    def run(outputs, forms):
        import pandas as pd

        return pd.Series(
            [None if o is None else invert(o.encode(), f).decode() for o, f in zip(outputs, forms)], dtype=object
        )

    return run(output, form)
