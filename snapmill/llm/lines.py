"""Line deduplication over a range-partitioned order of line hashes.

Every line long enough becomes two 64-bit hashes of its key with the document and position it
comes from. Rows are range-partitioned and sorted by hash, then document, then position, so a line
that fills a third of the corpus is spread over many ranges. Each task streams its range: the first
document of a hash owns it, all its other rows go. A hash that spans ranges is settled by the first
and last hash each range reports, two rows a range. What comes out is one compressed keep bitmap per
document, and no text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import WHITE_SPACE, bound_batches, shared_table

#: Code points a key needs.
LEAST = 10
#: Bytes of text whose lines make up a range, on average.
RANGE_BYTES = 64 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What a range reports: a line that goes; a line of the owner of its first hash, which goes if an
#: earlier range knows a smaller owner; an owner of its first or last hash.
GONE, OPEN, EDGE = 0, 1, 2


def line_keys(text: Column) -> Column:
    """The key of every line: without ASCII white space at its ends, A to Z in lower case."""
    lines = F.split(F.translate(_whole(text), UPPER, UPPER.lower()), "\n", -1)
    return F.transform(lines, lambda line: F.btrim(line, F.lit(WHITE_SPACE)))


def _whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _text_hash() -> Column:
    """Tells rows of one doc_id apart; rows equal in both have equal lines and share their bitmap."""
    return F.xxhash64(_whole(F.col("text"))).alias("text_hash")


def _long_lines(docs: DataFrame, least: int) -> DataFrame:
    # Keys are made before the lines are rows: an expression of a row is evaluated again by each that uses it.
    keys = docs.select("doc_id", _text_hash(), F.posexplode(line_keys(F.col("text"))).alias("position", "line_key"))
    return keys.where(F.char_length("line_key") >= least).select(
        F.xxhash64("line_key").alias("hash"),
        F.xxhash64(F.lit(1), "line_key").alias("hash2"),
        "doc_id",
        "text_hash",
        "position",
        F.monotonically_increasing_id().alias("spread"),  # only to split rows equal in all else
    )


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one sorted range; see GONE, OPEN and EDGE."""
    names = ["kind", "hash", "hash2", "doc_id", "text_hash", "position"]

    def report(kind: int, batch: pa.RecordBatch, at: np.ndarray) -> pa.RecordBatch:
        rows = batch.take(pa.array(at))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), *rows.columns], names)

    owner = last = None  # the first row of the hash that goes on, as a batch of one row
    in_first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        if last is not None:
            batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        elif owner is None:
            yield report(EDGE, batch, np.array([0]))
        hashes = [batch.column(i).to_numpy() for i in (0, 1)]
        begins = np.zeros(batch.num_rows, bool)
        begins[0] = True
        begins[1:] = (hashes[0][1:] != hashes[0][:-1]) | (hashes[1][1:] != hashes[1][:-1])
        run = np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))
        doc = batch.column(2)
        first = doc.take(pa.array(run))
        same = pc.or_(pc.fill_null(pc.equal(doc, first), False), pc.and_(pc.is_null(doc), pc.is_null(first)))
        same = same.to_numpy(zero_copy_only=False)
        # The carried row was reported with its own batch.
        new = np.arange(len(begins)) >= (0 if last is None else 1)
        yield report(GONE, batch, np.flatnonzero(new & ~same))
        if in_first:
            open_rows = run == 0
            yield report(OPEN, batch, np.flatnonzero(new & same & open_rows))
            in_first = bool(open_rows[-1])
        owner = last = batch.slice(int(run[-1]), 1)
    if last is not None:
        yield report(EDGE, last, np.array([0]))


def _dropped(docs: DataFrame, least: int) -> DataFrame:
    """The positions to drop: one row per doc_id and text that loses any, with them as an array."""
    spark = docs.sparkSession
    bound_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    order = ["hash", "hash2", F.col("doc_id").asc_nulls_last()]
    rows = (
        _long_lines(docs, least)
        .repartitionByRange(ranges, *order, "text_hash", "position", "spread")
        .sortWithinPartitions(*order, "position")
        .drop("spread")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = shared_table(
        rows.mapInArrow(_reports, f"kind int, hash long, hash2 long, doc_id {kind}, text_hash long, position int"),
        "line-reports",
    )
    owners = found.where(F.col("kind") == EDGE).groupBy("hash", "hash2").agg(F.min("doc_id").alias("owner"))
    late = found.where(F.col("kind") == OPEN).join(owners, ["hash", "hash2"]).where(~F.col("owner").eqNullSafe(F.col("doc_id")))
    place = [_key("doc_id", "text_hash"), "position"]
    gone = found.where(F.col("kind") == GONE).select(*place).unionByName(late.select(*place))
    return gone.groupBy("key").agg(F.collect_set("position").alias("positions"))


def _key(*columns: str) -> Column:
    """One struct, so that null ids meet and all joins share a partitioning."""
    return F.struct(*columns).alias("key")


def keep_bitmaps(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, text_hash, n_lines, n_dropped, keep_bitmap.

    Lines end at a line feed. A line whose key, see ``line_keys``, has ``least`` code points and
    occurs in several documents stays in that with the smallest doc_id, as often as it is there,
    and goes from all others. ``keep_bitmap`` has one bit per line, the first as the highest of its
    byte, 1 for a line that stays, compressed by zlib. Null and empty texts are one empty line,
    which stays. Rows of one doc_id are one document, whatever their texts; null ids are one
    document that comes after all others. Repeated rows give repeated rows. Only doc_id and text
    are read, whatever else the table has. No documents give no rows. ``text_hash`` (64 bits)
    tells texts of one doc_id apart; lines are equal when 128 bits of hashes are.
    """
    text = _whole(F.col("text"))
    n_lines = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    sizes = docs.select("doc_id", _text_hash(), n_lines.alias("n_lines"))
    found = sizes.withColumn("key", _key("doc_id", "text_hash")).join(_dropped(docs, least), "key", "left").drop("key")
    return found.select(
        "doc_id",
        "text_hash",
        "n_lines",
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_dropped"),
        _bitmap(F.col("n_lines"), F.col("positions")).alias("keep_bitmap"),
    )


def _bitmap(n_lines: Column, positions: Column) -> Column:
    @F.pandas_udf("binary")
    def run(sizes, dropped):
        import pandas as pd

        def one(size, gone):
            bits = np.ones(size, np.uint8)
            if gone is not None:
                bits[gone] = 0
            return zlib.compress(np.packbits(bits).tobytes())

        return pd.Series(map(one, sizes, dropped), dtype=object)

    return run(n_lines, positions)


def kept_text(text: Column, bitmap: Column) -> Column:
    """The lines that a bitmap keeps, joined by line feeds; all of them where it is null."""

    @F.pandas_udf("string")
    def run(texts, bitmaps):
        import pandas as pd

        def one(text, bitmap):
            if text is None or bitmap is None:
                return text
            lines = text.split("\n")
            bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
            return "\n".join([lines[i] for i in np.flatnonzero(bits).tolist()])

        return pd.Series(map(one, texts, bitmaps), dtype=object)

    return run(text, bitmap)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Each document, as the struct ``document``, with n_lines, n_dropped and keep_bitmap of its text."""
    own = docs.select(F.struct("*").alias("document"), _key("doc_id", _text_hash()))
    found = bitmaps.select(_key("doc_id", "text_hash"), "n_lines", "n_dropped", "keep_bitmap").dropDuplicates(["key"])
    return own.join(found, "key").drop("key")


def drop_repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The documents with all their columns, ``text`` without the lines that ``keep_bitmaps`` drops.

    A null text stays null; a text that loses all lines becomes empty. Extra columns may have any
    name and type.
    """
    found = with_bitmaps(docs, keep_bitmaps(docs, least))
    bitmap = F.when(F.col("n_dropped") > 0, F.col("keep_bitmap"))
    kept = found.select("document", kept_text(F.col("document.text"), bitmap).alias("kept"))
    return kept.select(*[(F.col("kept") if c == "text" else F.col(f"document.`{c}`")).alias(c) for c in docs.columns])
