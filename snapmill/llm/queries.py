"""The corpus operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.llm.alignment import align, link_counts
from snapmill.llm.common import documents, pages, shared_path, ship_code
from snapmill.llm.decontam import contaminations
from snapmill.llm.exact import exact_groups
from snapmill.llm.htmltext import extract
from snapmill.llm.infill import fill_in_middle, restored
from snapmill.llm.langid import identify
from snapmill.llm.lines import keep_bitmaps, kept_text, with_bitmaps
from snapmill.llm.packing import pack
from snapmill.llm.sharding import shard_rows
from snapmill.llm.simhash import near_duplicates
from snapmill.llm.substrings import repeats
from snapmill.llm.toxicity import toxicity
from snapmill.llm.warc import read_archives, write_archives


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=4, distance=4)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(pages(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats(documents(spark, sf_dir), window=13)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    table = pages(spark, sf_dir)
    write_archives(table, path, least_bytes=0)
    kind = table.schema["page_id"].dataType
    return read_archives(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), capacity=2048)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir), shards=40)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(documents(spark, sf_dir))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = with_bitmaps(docs, keep_bitmaps(docs))
    kept = kept_text(F.coalesce("document.text", F.lit("")), F.col("keep_bitmap"))
    return found.select("document.doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(documents(spark, sf_dir))
    groups = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return link_counts(aligned.withColumn("groups_sha256", groups).drop("groups"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _shipped(query)
    for query in (
        op1_language_id,
        op2_simhash,
        op3_html_text,
        op4_substring_dedup,
        op5_warc,
        op6_exact_dedup,
        op7_decontamination,
        op8_packing,
        op9_sharding,
        op10_toxicity,
        op11_fill_in_middle,
        op12_line_dedup,
        op13_token_alignment,
    )
}
