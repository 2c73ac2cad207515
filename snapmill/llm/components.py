"""Connected components of a table of links, by contraction within partitions and between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import cut

#: Links of a partition when links are contracted locally; a task holds about that many.
PARTITION_LINKS = 500_000


def forest(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, root) of every node that is not the smallest of its component."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (above := up.get(top, top)) != top:
            top = above
        while x != top:
            up[x], x = top, up.get(x, top)
        return top

    for u, v in links:
        a, b = root(u), root(v)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in list(up)]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int]] = []
    for batch in batches:
        found = forest([*found, *zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["u", "v"])


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One contraction: link the larger (or the not larger) neighbours of a node to its smallest.

    ``links`` has u > v. The smallest neighbour is a partial aggregate; the join that hands it to
    all links of a node is a plain one, which adaptive execution splits at hubs.
    """
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        moved = links.join(least, "u").select(F.inline(ends))
    return moved.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``links`` (u, v: long, any order) that are not their own root.

    The root is the smallest node of a component. Links of a node to itself and repeated ones do
    no harm; none give no rows. Partitions of bounded size are contracted to stars first. One
    partition is then done; several go on with alternating star contraction until nothing moves.
    """
    links = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v"))
    parts = max(1, -(-links.count() // PARTITION_LINKS))
    links = cut(links.repartition(parts).mapInArrow(_contract, "u long, v long"))
    if parts > 1:
        state = F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        before = None
        while (now := tuple(links.agg(*state).first())) != before:
            before = now
            links = cut(_stars(_stars(links, large=True), large=False))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
