"""Helpers the corpus operators share."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.sources.shared import remove_folder

#: Punctuation and spaces beyond ASCII, read as a space where words are runs of letters.
OTHER_MARKS = re.compile(
    "[\u0085\u00a0-\u00a2\u00a4-\u00a9\u00ab-\u00af\u00b1-\u00b4\u00b6-\u00b8\u00bb-\u00bf\u00d7\u00f7"
    "\u2000-\u206f\u2e00-\u2e7f\u3000-\u303f\ufeff]"
)

#: ASCII white space, the characters that separate words in every contract.
WHITE_SPACE = " \t\n\x0b\x0c\r"


ROOT = Path(__file__).resolve().parents[2]


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, unless Python finds it there by the path they inherit."""
    if str(ROOT) in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
        return
    if any("snapmill-code" in file for file in spark.sparkContext.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="snapmill-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/snapmill-code", "zip", ROOT, "snapmill"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; make one only in a local session without it."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="snapmill-llm-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)


#: Bytes of an Arrow batch. Rows of long texts come in small batches, whatever their number.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Have Arrow batches hold ``size`` bytes at most, or what the session says if that is less."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= size:
        spark.conf.set(key, str(size))


def cut(df: DataFrame) -> DataFrame:
    """Run ``df`` now and go on from its rows in the shared folder, so that lost executors cost no rerun."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when Python exits."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove_folder, spark, path)
    return path


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and go on from there."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(name: str, of: str | None = None) -> Column:
    """A column, or a field of the struct column ``of``, whatever its name holds."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(quoted if of is None else f"{of}.{quoted}")


def free_name(name: str, df: DataFrame) -> str:
    """A name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Keys of documents that are broadcast at most; with more the documents are shuffled by key.
BROADCAST_KEYS = 1_000_000


def document_key() -> Column:
    """What tells documents apart: doc_id and a hash of the text. Null ids and null texts are values like others."""
    return F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"))


def take_out(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """``docs`` without the documents listed by key (column ``key``, see ``document_key``).

    Where ``stays`` is true one row of the key is left, the first by its JSON; elsewhere none. The
    list is broadcast if it has BROADCAST_KEYS rows or fewer; the texts stay where they are then.
    """
    listed = shared_table(listed.select("key", "stays"), "keys")
    numbers = {r["stays"]: r["count"] for r in listed.groupBy("stays").count().collect()}  # two rows
    key, columns = free_name("key", docs), [column(c) for c in docs.columns]
    listed = listed.withColumnRenamed("key", key)
    if sum(numbers.values()) <= BROADCAST_KEYS:
        listed = F.broadcast(listed)
    keyed = docs.withColumn(key, document_key())
    once = keyed.join(listed, key, "left_anti").select(*columns)
    if not numbers.get(True):
        return once
    again = keyed.join(listed.where("stays"), key, "left_semi").select(key, F.struct(*columns).alias("document"))
    # combined where the rows are, so a row that is repeated very often is no burden
    first = again.groupBy(key).agg(F.min_by("document", F.to_json("document")).alias("document"))
    return once.unionByName(first.select(*[column(c, "document").alias(c) for c in docs.columns]))


def collapsed(docs: DataFrame) -> DataFrame:
    """doc_id and text of rows that repeat both as one row, with their number ``n``.

    Repeated rows are listed by key first and combined where they are, so one that fills much of the
    table is no burden for a task; rows that are alone are not moved.
    """
    keyed = docs.select("doc_id", "text", document_key().alias("key"))
    listed = shared_table(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated-rows")
    several = listed.count()
    alone = F.lit(1).cast("long").alias("n")
    if not several:
        return keyed.select("doc_id", "text", alone)
    if several <= BROADCAST_KEYS:
        listed = F.broadcast(listed)
    once = keyed.join(listed, "key", "left_anti").select("doc_id", "text", alone)
    first = keyed.join(listed.select("key"), "key").groupBy("key").agg(F.min("text").alias("text"), F.count("*").alias("n"))
    return once.unionByName(first.select("key.doc_id", "text", "n"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows nothing is learned from: those whose id has a CRC-32 divisible by five."""
    return crc_of_id(doc_id) % 5 == 0
