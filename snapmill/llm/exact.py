"""Exact deduplication that splits off heavy hitters.

Texts are compared by the SHA-256 of what is left without ASCII white space. Misra-Gries
summaries, one per partition, find the digests that may hold a large share of the rows; the rows
of those candidates are counted exactly with map-side aggregation, and the verified winners go
to every task, which decides on the hot groups without moving a row. All other digests are
shuffled as usual.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmill.llm.common import WHITE_SPACE, cut, take_out

#: Counters of a summary. At most this many candidates reach the driver and are broadcast, and
#: every digest with 2 / COUNTERS of the rows or more is among them.
COUNTERS = 1024


def normal_text(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for space in WHITE_SPACE:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def digest(text: Column) -> Column:
    return F.sha2(normal_text(text), 256)


def shrink(counts: Counter, counters: int) -> Counter:
    """Keep ``counters`` counts at most: take the next largest one off all, as Misra-Gries does."""
    if len(counts) <= counters:
        return counts
    taken = sorted(counts.values(), reverse=True)[counters]
    return Counter({k: n - taken for k, n in counts.items() if n > taken})


def frequent_values(df: DataFrame, column: str, counters: int = COUNTERS) -> list:
    """At most ``counters`` values of ``column``, with every one that 2 / counters of the rows have.

    A summary holds of each value a count that is too low by its rows / counters at most. The
    summaries are added up by value in a shuffle, so a value with 2 n / counters of n rows keeps
    n / counters or more, and at most ``counters`` values can. Values seen once are not frequent.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            found = pc.value_counts(batch.column(0))
            counts.update(dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist())))
            counts = shrink(counts, counters)
        yield pa.RecordBatch.from_pydict(
            {"value": [None, *counts], "n": [rows, *counts.values()]}, schema=schema
        )

    schema = pa.schema([("value", pa.string()), ("n", pa.int64())])
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value"))
    summaries = values.mapInArrow(summarise, "value string, n long").groupBy("value").agg(F.sum("n").alias("n"))
    summaries = cut(summaries)
    total = summaries.where("value IS NULL").agg(F.sum("n")).first()[0] or 0
    heavy = summaries.where(F.col("value").isNotNull() & (F.col("n") >= max(2, total / counters)))
    return [r.value for r in heavy.select("value").collect()]


def _with_group(rows: DataFrame) -> DataFrame:
    return rows.select(
        "key",
        F.col("key.doc_id").alias("doc_id"),
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("key") == F.col("winner")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Only ``doc_id`` and ``text`` are read, whatever else the table has. Null text counts as
    empty. In a group the row with the most code points in its original text stays, then the one
    with the smallest doc_id; a null doc_id comes last, and of equal ones the text that hashes lowest
    comes first. Of rows that repeat doc_id and text exactly one is kept. No documents give no rows.
    """
    return _grouped(docs, counters).drop("key")


def _grouped(docs: DataFrame, counters: int) -> DataFrame:
    """``exact_groups`` with the key that rows of a group are ordered by."""
    table = cut(
        docs.select(
            digest(F.col("text")).alias("digest"),
            F.struct(
                (-F.char_length(F.coalesce("text", F.lit("")))).alias("fewer"),
                F.col("doc_id").isNull().alias("unknown"),
                F.col("doc_id"),
                F.xxhash64("text").alias("text_hash"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("key"),
        )
    )
    spark = docs.sparkSession
    heavy = spark.createDataFrame([(v,) for v in frequent_values(table, "digest", counters)], "digest string")
    winners = cut(
        table.join(F.broadcast(heavy), "digest")  # at most `counters` rows
        .groupBy("digest")
        .agg(F.min("key").alias("winner"), F.count("*").alias("group_size"))
    )
    split = table.join(F.broadcast(winners), "digest", "left")
    same = Window.partitionBy("digest")
    others = split.where("winner IS NULL").select(
        "digest", "key", F.min("key").over(same).alias("winner"), F.count("*").over(same).alias("group_size")
    )
    return _with_group(split.where("winner IS NOT NULL").select("digest", "key", "winner", "group_size").unionByName(others))


def drop_exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns: of each group of equal texts the row that
    ``exact_groups`` keeps.

    Null, empty and blank texts are equal, so one of all of them stays. Of rows that repeat doc_id
    and text one stays, the first by the JSON of all its columns. Extra columns may have any name and
    type. No documents give no rows. Keys of what goes are listed in the shared folder; see
    ``take_out``.
    """
    groups = _grouped(docs, counters)
    key = F.struct("key.doc_id", "key.text_hash").alias("key")
    by_key = groups.groupBy(key).agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    return take_out(docs, by_key.where("NOT stays OR n > 1"))
