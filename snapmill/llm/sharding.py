"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard has the same number of points on a ring of 2^32 places, every row one place. A row
goes to the shard of the next point clockwise; a shard takes rows up to its capacity, and what
overflows continues clockwise to the next shard with room. Row counts per arc decide everything:
the driver walks the ring once over those counts, at most ``shards * points`` numbers however
many rows there are, and says for each arc which ranks go to which shard at which slots. The
rows themselves are only ranked within their arc and looked up; rows that are alike are ranked as one.
DataFrame functions throughout.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Points of a shard on the ring.
POINTS = 256
#: The ring is looked up in this many equal cells, each with the points in it and the next one.
CELL_BITS = 12
PLACES = 1 << 32
#: Copies of a row that one task deals out.
COPIES = 100_000


def _place(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 32)


def ring(spark: SparkSession, shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(place, shard) of all points in ring order; of points at one place the smallest shard counts."""
    rows = (
        spark.range(shards * points)
        .select((F.col("id") / points).cast("int").alias("shard"), (F.col("id") % points).alias("point"))
        .select(_place(F.lit("point"), "shard", "point").alias("place"), "shard")
        .groupBy("place")
        .agg(F.min("shard").alias("shard"))
        .orderBy("place")
        .collect()
    )
    return [(r.place, r.shard) for r in rows]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard takes at most: a fair share, and ``slack`` of it more.

    Without slack the shares differ by one at most and add up to ``rows``: all shards get full.
    """
    if slack == 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [-int(-rows * (1 + slack) // shards)] * shards


def walk(arcs: list[tuple[int, int]], shards: list[int], room: list[int]) -> list[dict]:
    """Deal the rows of the arcs out.

    ``arcs``: (arc, rows) in ring order; ``shards``: the shard of each arc; ``room``: by shard.
    Every arc first gives its own shard what that shard has room for, in ring order; what is left
    continues clockwise. Returns pieces: rows ``first`` .. ``first + n - 1`` of the arc, by rank,
    get slots from ``slot`` in ``shard``.
    """
    room, used, pieces = list(room), [0] * len(room), []

    def give(arc: int, first: int, n: int, shard: int) -> int:
        n = min(n, room[shard])
        if n:
            pieces.append({"arc": arc, "first": first, "n": n, "shard": shard, "slot": used[shard]})
            room[shard] -= n
            used[shard] += n
        return n

    over = []
    for arc, n in arcs:
        given = give(arc, 0, n, shards[arc])
        if given < n:
            over.append((arc, given, n - given))
    # Next arc whose shard has room; full ones are skipped for good.
    following = list(range(1, len(shards))) + [0]

    def next_open(arc: int) -> int:
        at, seen = following[arc], []
        while not room[shards[at]]:
            seen.append(at)
            at = following[at]
        for s in seen:
            following[s] = at
        following[arc] = at
        return at

    for arc, first, n in over:
        at = arc
        while n:
            at = next_open(at)
            given = give(arc, first, n, shards[at])
            first, n = first + given, n - given
    return pieces


def _table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table from the driver, as one literal that the JVM reads."""
    text = F.lit(json.dumps(rows, separators=(",", ":")))
    return spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{schema}>>")))


def _dealt_out(alike: DataFrame) -> DataFrame:
    """Each row ``n`` times, numbered by ``copy`` from 0; very many copies are spread over tasks."""
    zero, last = F.lit(0).cast("long"), F.col("n") - 1
    few = alike.where(F.col("n") <= COPIES).withColumn("copy", F.explode(F.sequence(zero, last)))
    blocks = alike.where(F.col("n") > COPIES).withColumn("block", F.explode(F.sequence(zero, last, F.lit(COPIES).cast("long"))))
    spread = blocks.repartition("place", "doc_id", "block")
    many = spread.withColumn("copy", F.explode(F.sequence("block", F.least(F.col("block") + COPIES - 1, last)))).drop("block")
    return few.unionByName(many)


def shard_rows(
    docs: DataFrame, shards: int, points: int = POINTS, slack: float = 0.0, law: str = "rows"
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The place of a row comes from its doc_id and text, so rows of one doc_id with different
    texts spread; rows that repeat both follow one another. ``slack`` is the share by which a
    shard may exceed the fair share of rows; 0 gives counts that differ by one at most. Null
    doc_id and text count as such: a null text has size 16 and the CRC-32 of nothing. Slots are
    gapless from 0 in every shard. Empty tables give no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    points_at = ring(spark, shards, points)
    width = PLACES >> CELL_BITS
    cells, at = [], 0
    for cell in range(1 << CELL_BITS):
        inside = []
        while at < len(points_at) and points_at[at][0] < (cell + 1) * width:
            inside.append({"place": points_at[at][0], "arc": at})
            at += 1
        inside.append({"place": PLACES, "arc": at % len(points_at)})
        cells.append({"cell": cell, "inside": inside})
    looked_up = _table(spark, cells, "cell: int, inside: array<struct<place: long, arc: int>>")

    placed = (
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            _place(F.lit("row"), F.col("doc_id"), F.xxhash64(text)).alias("place"),
        )
        .withColumn("cell", F.shiftright("place", 32 - CELL_BITS).cast("int"))
        .join(F.broadcast(looked_up), "cell")  # as many rows as cells, as many points as the ring has
        .withColumn("arc", F.expr("filter(inside, p -> p.place >= place)[0].arc"))
        .drop("cell", "inside")
    )
    # Rows that are alike are one until they are dealt out, so that an arc is no more than its different rows.
    alike = placed.groupBy("arc", "place", "doc_id", "text_crc32", "size").agg(F.count("*").alias("n"))
    counts = {r.arc: r["n"] for r in alike.groupBy("arc").agg(F.sum("n").alias("n")).collect()}  # one number per arc
    arcs = sorted(counts.items())
    pieces = walk(arcs, [s for _, s in points_at], capacities(sum(counts.values()), shards, slack))
    by_arc: dict[int, list] = {}
    for p in pieces:
        by_arc.setdefault(p["arc"], []).append({k: p[k] for k in ("first", "n", "shard", "slot")})
    plan = _table(
        spark,
        [{"arc": a, "pieces": p} for a, p in by_arc.items()],
        "arc: int, pieces: array<struct<first: long, n: long, shard: int, slot: long>>",
    )
    order = Window.partitionBy("arc").orderBy("place", F.col("doc_id").asc_nulls_last(), "text_crc32", "size")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = alike.withColumn("first_rank", F.sum("n").over(before) - F.col("n"))
    return (
        _dealt_out(first)
        .withColumn("rank", F.col("first_rank") + F.col("copy"))
        .join(F.broadcast(plan), "arc")  # arcs with rows, and a piece more for each overflow
        .withColumn("piece", F.expr("filter(pieces, p -> rank >= p.first AND rank < p.first + p.n)[0]"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit(law).alias("law"),
            F.col("piece.shard").alias("shard"),
            (F.col("piece.slot") + F.col("rank") - F.col("piece.first")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
