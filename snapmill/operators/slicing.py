"""Picking rows by snapshot month, and the month spine itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill import fixed_values as V
from snapmill.functions.calendar import DateLike, day, month_start, on_spine


def snapshot_slice(df: DataFrame, snapshot: DateLike, column: str = V.SNAPSHOT) -> DataFrame:
    """Rows of one snapshot. On a partitioned table this prunes to one directory."""
    return df.where(F.col(column) == F.lit(day(snapshot)))


def spine_slice(df: DataFrame, start: DateLike, end: DateLike, column: str = V.SNAPSHOT) -> DataFrame:
    """Rows whose snapshot is on the month spine; null and mid-month dates are left out.

    The spine is a regular grid, so membership is a predicate and needs no join.
    """
    return df.where(on_spine(F.col(column), start, end))


def month_spine(spark: SparkSession, start: DateLike, end: DateLike) -> DataFrame:
    """First days of months from the month of ``start`` up to ``end``, one per row."""
    bounds = spark.range(1).select(
        F.lit(month_start(start)).alias("first"), F.lit(day(end)).alias("last")
    )
    return spine_between(bounds)


def spine_between(bounds: DataFrame, *carried: str) -> DataFrame:
    """Month spine of a one-row ``first, last`` frame; ``carried`` columns go to every month."""
    first, last = F.trunc("first", "month"), F.col("last")
    # a sequence must not run backwards, not even in a row that is filtered out
    grid = F.sequence(first, F.greatest(first, last), F.expr("interval 1 month"))
    return bounds.where(first <= last).select(F.explode(grid).alias(V.SNAPSHOT), *carried)


def spine_of(df: DataFrame, column: str = V.SNAPSHOT) -> DataFrame:
    """Month spine from the first to the last date in the data."""
    return spine_between(df.agg(F.min(column).alias("first"), F.max(column).alias("last")))


def month_counts(df: DataFrame, column: str = V.SNAPSHOT) -> DataFrame:
    """Rows of every month of the data's own spine, months without any included.

    One scan: the counts, one entry per month, travel along with the spine's bounds.
    """
    month = F.trunc(F.col(column).cast("date"), "month").alias("month")
    per_month = df.where(F.col(column).isNotNull()).groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    bounds = per_month.agg(
        F.min("month").alias("first"),
        F.max("month").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("month", "n"))).alias("counts"),
    )
    found = F.try_element_at("counts", F.col(V.SNAPSHOT))
    return spine_between(bounds, "counts").select(
        V.SNAPSHOT, F.coalesce(found, F.lit(0)).alias("row_count")
    )
