"""From raw documents to packed training sequences, in stages that each write a table.

All stages but the last return the columns they got, whatever their names and types, and read only
doc_id and text (the first also lang). Empty tables give empty tables. The tables between stages lie in
the shared folder and are removed when Python exits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapmill.llm.common import bound_batches, shared_table, ship_code
from snapmill.llm.decontam import drop_contaminated
from snapmill.llm.exact import drop_exact_copies
from snapmill.llm.langid import drop_unknown_languages
from snapmill.llm.packing import pack
from snapmill.llm.simhash import drop_near_duplicates


#: Bytes of an Arrow batch: all stages run in the same executors and Python workers, whose memory adds up.
BATCH_BYTES = 2 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, null texts included, or far from every language of the corpus.

    Rows that are repeated stay or go together.
    """
    bound_batches(spark, BATCH_BYTES)
    return drop_unknown_languages(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts: the longest as written, then the smallest doc_id.

    A null doc_id comes last, null text counts as empty, and of rows that repeat both one stays.
    """
    bound_batches(spark, BATCH_BYTES)
    return drop_exact_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by fingerprints of 4-word shingles within 4 bits.

    That with the smallest doc_id stays, null coming last, then the text that hashes lowest; of rows that
    repeat both one stays. Texts without words are one group.
    """
    bound_batches(spark, BATCH_BYTES)
    return drop_near_duplicates(docs, shingle=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item, re-parameterised or not.

    Null and empty texts stay; rows that are repeated stay or go together.
    """
    bound_batches(spark, BATCH_BYTES)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens, repeated rows as often as they are there.

    A null text is a single id 0; of gaps that are equally good the tighter is filled.
    """
    bound_batches(spark, BATCH_BYTES)
    return pack(docs, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame | None, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written table of the one before."""
    ship_code(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
