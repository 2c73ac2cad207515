"""Words and word windows of many texts at once, as hashes in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
#: Bytes that are hashed at a time; longer words are taken whole.
BLOCK = 1 << 20
#: A random number for each byte value, fixed by the seed.
BYTE_VALUES = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the finaliser of SplitMix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, as many as were asked for."""

    def __init__(self, base: int = BASE):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                row = np.full(2 * n, base, np.uint64)
                row[0] = 1
                setattr(self, name, np.cumprod(row, dtype=np.uint64))
        return self.up, self.down


def rolling(hashes: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """A hash of every run of ``width`` values: sum of h[i + j] * base^j modulo 2^64, mixed."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[:n])


def spans(inside: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; a run also ends at an edge."""
    step = np.zeros(len(inside) + 1, bool)
    step[1:-1] = inside[1:] != inside[:-1]
    step[0] = step[-1] = True
    step[edges] = True
    at = np.flatnonzero(step)
    kept = inside[at[:-1]] if len(inside) else np.empty(0, bool)
    return at[:-1][kept], at[1:][kept]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A hash of the bytes of every span; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = powers(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data[low:high]] * up[: high - low], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[b] - sums[a]) * down[a])
        i = j
    return out


def text_slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of text (column ``text``) each."""
    text = batch.column(batch.schema.get_field_index("text"))
    at = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1 + text.offset)[text.offset :].astype(np.int64)
    start = 0
    while start < len(text):
        end = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows one after the other, and the rows' edges; a null row is empty."""
    text = text.fill_null("")
    edges = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1 + text.offset)[text.offset :].astype(np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[edges[0] : edges[-1]], edges - edges[0]
