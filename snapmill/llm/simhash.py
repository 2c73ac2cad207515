"""SimHash near-duplicates found by the generalised pigeonhole principle.

Fingerprints within distance t agree, on at least one of m partitions of the bits, to within
that partition's threshold, whenever the thresholds t_i satisfy sum(t_i + 1) = t + 1; t_i = -1
leaves a partition out. Correlated bits are put into one partition. Each fingerprint gets its own
thresholds: dynamic programming over the partitions finds those with the fewest expected probes
and candidates, estimated from histograms over all fingerprints. It then probes the index with
all values within its thresholds, and candidates are verified on all 64 bits in the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import bound_batches, cut, take_out
from snapmill.llm.components import components

BITS = 64
SEED = 42
#: Bits of a histogram block; 2^BLOCK_BITS counts each are collected, however large the input.
BLOCK_BITS = 16
#: What a probe that is shuffled costs, in candidates verified.
PROBE_COST = 4.0
#: Rows a task expands at a time.
CHUNK = 2048


# Fingerprints


def fingerprint(text: str | None, shingle: int) -> int:
    """Bitwise majority over the XXH64 values of the shingles; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED)
        for i in range(max(1, len(words) - shingle + 1))
    ]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash (XXH64 of the text) and fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"]
            )

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


# Partitions and thresholds


def ball(width: int, radius: int) -> list[int]:
    """All patterns of ``width`` bits with at most ``radius`` ones."""
    return [sum(1 << b for b in on) for r in range(radius + 1) for on in combinations(range(width), r)]


def ball_size(width: int, radius: int) -> int:
    size, term = 0, 1
    for r in range(radius + 1):
        size, term = size + term, term * (width - r) // (r + 1)
    return size


def widths(parts: int) -> list[int]:
    return [BITS // parts + (i < BITS % parts) for i in range(parts)]


def choose_parts(n: int, distance: int) -> int:
    """Number of partitions with the least expected work for ``n`` fingerprints of even spread."""

    def cost(parts: int) -> float:
        best = [0.0] + [float("inf")] * (distance + 1)  # by the sum of t + 1 so far
        for width in widths(parts):
            spend = [0.0] + [ball_size(width, t) * (PROBE_COST + n / 2.0**width) for t in range(distance + 1)]
            best = [min(best[used - s] + spend[s] for s in range(used + 1)) for used in range(distance + 2)]
        return best[distance + 1]

    return min(range(max(1, min(2, distance + 1)), distance + 2), key=cost)


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of near-equal width; each starts with the closest free pair and grows by the closest bit."""
    strength = np.abs(correlation).astype(float)
    np.fill_diagonal(strength, -1)
    free, grouped = set(range(BITS)), []
    for width in widths(parts):
        rest = sorted(free)
        if width == 1:
            own = rest[:1]
        else:
            i, j = divmod(int(np.argmax(strength[np.ix_(rest, rest)])), len(rest))
            own = [rest[i], rest[j]]
        while len(own) < width:
            rest = sorted(free - set(own))
            own.append(rest[int(np.argmax(strength[np.ix_(rest, own)].sum(1)))])
        grouped.append(sorted(own))
        free -= set(own)
    return grouped


def bit_correlation(fps: DataFrame) -> np.ndarray:
    """Correlation of all pairs of bits over all fingerprints; 64 x 64 sums reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            raw = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint8)
            bits = np.unpackbits(raw.reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array([*range(BITS * BITS), -1], pa.int32()), "n": pa.array([*total.ravel().astype(np.int64), n], pa.int64())}
        )

    rows = fps.select("fp").mapInArrow(sums, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = {r.cell: r.n for r in rows}
    n = max(1, found.get(-1, 0))
    both = np.array([found.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS) / n
    mean = np.diag(both)
    spread = np.sqrt(np.outer(mean * (1 - mean), mean * (1 - mean)))
    return np.where(spread > 0, (both - np.outer(mean, mean)) / np.where(spread > 0, spread, 1), 0.0)


def pick(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each value, packed from bit 0 on."""
    out = np.zeros(len(values), np.uint64)
    for to, bit in enumerate(bits):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(to)
    return out


def blocks_of(bits: list[int]) -> list[list[int]]:
    n = -(-len(bits) // BLOCK_BITS)
    return [bits[len(bits) * i // n : len(bits) * (i + 1) // n] for i in range(n)]


def shells(counts: np.ndarray, width: int, radius: int) -> np.ndarray:
    """Share of fingerprints at distance exactly 0 .. radius from every value of a block."""
    out = np.zeros((radius + 1, 1 << width))
    out[0] = counts
    values = np.arange(1 << width)
    for bit in range(width):
        flipped = out[:, values ^ (1 << bit)]
        out[1:] += flipped[:-1]
    return out


def block_histograms(fps: DataFrame, blocks: list[list[int]]) -> list[np.ndarray]:
    """How often each value of each block occurs: 2^BLOCK_BITS numbers a block at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << len(b), np.int64) for b in blocks]
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
            for total, bits in zip(totals, blocks):
                total += np.bincount(pick(values, bits).astype(np.int64), minlength=len(total))
        for k, total in enumerate(totals):
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array(np.full(len(seen), k), pa.int32()), "value": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())}
            )

    rows = fps.select("fp").mapInArrow(count, "block int, value int, n long").groupBy("block", "value").agg(F.sum("n").alias("n"))
    found = rows.toArrow().to_pydict()
    out = [np.zeros(1 << len(b)) for b in blocks]
    for k, value, n in zip(found["block"], found["value"], found["n"]):
        out[k][value] = n
    return out


class Allocation:
    """Partitions with their histograms; allots thresholds and lists the probes of fingerprints."""

    def __init__(self, parts: list[list[int]], histograms: list[list[np.ndarray]], n: int, distance: int):
        self.parts, self.n, self.distance = parts, n, distance
        self.blocks = [blocks_of(p) for p in parts]
        self.shells = [
            [shells(h / max(1, n), len(b), distance) for h, b in zip(hs, bs)] for hs, bs in zip(histograms, self.blocks)
        ]
        self.probes = np.array([[0.0] + [float(ball_size(len(p), t)) for t in range(distance + 1)] for p in parts])

    def candidates(self, values: np.ndarray, part: int) -> np.ndarray:
        """Expected fingerprints within 0 .. distance on a partition; blocks count as independent."""
        by_shell = np.zeros((self.distance + 1, len(values)))
        by_shell[0] = 1
        for bits, share in zip(self.blocks[part], self.shells[part]):
            own = share[:, pick(values, bits).astype(np.int64)]
            by_shell = np.array(
                [sum(by_shell[i] * own[r - i] for i in range(r + 1)) for r in range(self.distance + 1)]
            )
        return np.cumsum(by_shell, axis=0) * self.n

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """For each fingerprint the thresholds (-1 .. distance) of the partitions that cost least."""
        need = self.distance + 1
        best = np.full((need + 1, len(values)), np.inf)
        best[0] = 0
        choice = []
        for part in range(len(self.parts)):
            cost = np.vstack([np.zeros(len(values)), self.candidates(values, part)])
            cost += self.probes[part][:, None] * PROBE_COST
            options = np.full((need + 1, need + 1, len(values)), np.inf)  # [used after, spent here]
            for used in range(need + 1):
                for spent in range(used + 1):
                    options[used, spent] = best[used - spent] + cost[spent]
            choice.append(options.argmin(1))
            best = options.min(1)
        out = np.empty((len(self.parts), len(values)), np.int64)
        used = np.full(len(values), need)
        for part in reversed(range(len(self.parts))):
            spent = choice[part][used, np.arange(len(values))]
            out[part] = spent - 1
            used = used - spent
        return out

    def keys(self, values: np.ndarray, part: int) -> np.ndarray:
        """What a fingerprint is indexed under; the low bits tell partitions apart."""
        own = pick(values, self.parts[part])
        return own * np.uint64(len(self.parts)) + np.uint64(part)

    def probe_rows(self, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(key, place of the fingerprint in ``values``) of all probes."""
        allotted = self.thresholds(values)
        for part, bits in enumerate(self.parts):
            own = pick(values, bits)
            for t in range(self.distance + 1):
                at = np.flatnonzero(allotted[part] == t)
                masks = np.array(ball(len(bits), t), np.uint64) if len(at) else None
                step = max(1, (1 << 20) // ball_size(len(bits), t))
                for start in range(0, len(at), step):
                    some = at[start : start + step]
                    near = (own[some][:, None] ^ masks[None, :]).ravel()
                    yield near * np.uint64(len(self.parts)) + np.uint64(part), np.repeat(some, len(masks))


def allocate(fps: DataFrame, n: int, distance: int, correlation: np.ndarray) -> Allocation:
    parts = group_bits(correlation, choose_parts(n, distance))
    blocks = [blocks_of(p) for p in parts]
    flat = iter(block_histograms(fps, [b for own in blocks for b in own]))
    return Allocation(parts, [[next(flat) for _ in own] for own in blocks], n, distance)


def links(fps: DataFrame, plan: Allocation) -> DataFrame:
    """(u, v) of differing roots of fingerprints within the plan's distance; ``fps`` has distinct fp, root."""
    distance = plan.distance
    plan = fps.sparkSession.sparkContext.broadcast(plan)

    def expand(probing: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, CHUNK):
                    batch = whole.slice(start, CHUNK)
                    fp, root = (np.ascontiguousarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in (0, 1))
                    values = fp.view(np.uint64)
                    if probing:
                        found = plan.value.probe_rows(values)
                    else:
                        found = ((plan.value.keys(values, p), np.arange(len(values))) for p in range(len(plan.value.parts)))
                    for key, at in found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.view(np.int64)), pa.array(fp[at]), pa.array(root[at])], ["k", "fp", "root"]
                        )

        return run

    probes = fps.select("fp", "root").mapInArrow(expand(True), "k long, fp long, root long").alias("a")
    index = fps.select("fp", "root").mapInArrow(expand(False), "k long, fp long, root long").alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    met = probes.join(index, (F.col("a.k") == F.col("b.k")) & (F.col("a.root") != F.col("b.root")) & near)
    return met.select(F.greatest("a.root", "b.root").alias("u"), F.least("a.root", "b.root").alias("v")).distinct()


# Operator


def _grouped(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, fp), and for each distinct fp the smallest doc_id and the root of its group."""
    rows = cut(fingerprints(docs, shingle))
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("root", F.col("fp")))
    n = nodes.count()
    correlation = bit_correlation(nodes)
    for radius in dict.fromkeys((distance // 2, distance)):
        if n > 1 and radius:
            moved = components(links(nodes, allocate(nodes, n, radius, correlation)))
            moved = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
            nodes = cut(nodes.join(moved, "root", "left").select("fp", "least", F.coalesce("to", "root").alias("root")))
    return rows, nodes


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Words are runs of anything but ASCII white space after lower-casing A-Z; shingles count as
    often as they occur. A text without words, null included, has fingerprint zero. Documents are
    linked when their fingerprints differ in ``distance`` bits or fewer, and component_id is the
    smallest doc_id that links reach; it is null where no reached doc_id is known. Repeated rows
    get a row each. Only doc_id and text are read. No documents give no rows.

    Equal fingerprints are one node, so groups of copies emit no pairs. Links within half the
    distance are joined up first, and the full distance is only looked for between what is then
    still apart; a node of a dense group has few links that way.
    """
    rows, nodes = _grouped(docs, shingle, distance)
    of_root = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    # A fingerprint may have a third of all rows: the lookup is a plain join that is split at it.
    by_fp = nodes.join(of_root, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents that stay, with all their columns: of each group the row with the smallest doc_id.

    A null doc_id comes last. Of a group's rows with that doc_id the one whose text hashes lowest
    stays, and of rows that repeat it the first by the JSON of all columns. Texts without words, null
    and empty ones, are one group, with all that is near a fingerprint of zero. Extra columns may
    have any name and type. No documents give no rows. Keys of what goes are listed in the shared
    folder; see ``take_out``.
    """
    rows, nodes = _grouped(docs, shingle, distance)
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("text_hash"))
    keyed = rows.join(nodes.select("fp", "root"), "fp").select("root", key.alias("key"))
    first = keyed.groupBy("root").agg(F.min("key").alias("first"))
    keys = keyed.groupBy("root", "key").agg(F.count("*").alias("n")).join(first, "root")
    listed = keys.select(
        F.struct("key.doc_id", "key.text_hash").alias("key"), (F.col("key") == F.col("first")).alias("stays"), "n"
    )
    return take_out(docs, listed.where("NOT stays OR n > 1"))
