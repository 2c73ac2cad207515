"""Table profiles. Each is one pass with partial aggregation in the map tasks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill import fixed_values as V
from snapmill.functions.casts import WIDE, as_type


def _per_column(df: DataFrame, columns: Iterable[str], measures) -> DataFrame:
    """Long profile: one row per column. ``measures(name)`` gives named aggregates.

    All aggregates are computed side by side in a single pass; turning the one result row
    into one row per column costs nothing.
    """
    columns = list(columns)
    wide = df.agg(*[F.struct(*measures(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}.*")) for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*cells)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def value_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value. With a limit this is a top-k."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.desc("count"), F.asc(column))
    return ordered if limit is None else ordered.limit(limit)


def distinct_values(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct values, null included. A limit keeps the first values in order."""
    values = df.select(column).distinct()
    return values if limit is None else values.orderBy(column).limit(limit)


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """How many distinct values there are; null counts as one."""
    return distinct_values(df, column).agg(F.count(F.lit(1)).alias("distinct_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls in every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def is_missing(field: T.StructField) -> Column:
    """Null; for text also empty or nothing but underscores."""
    value = F.col(field.name)
    if not isinstance(field.dataType, T.StringType):
        return value.isNull()
    # the first byte decides for nearly all texts, so long ones are not decoded for the pattern
    blank = (value == "") | (value.startswith("_") & value.rlike(V.MISSING_TEXT_PATTERN))
    return value.isNull() | blank


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, one row per column."""
    fields = {f.name: f for f in df.schema.fields}
    return _per_column(
        df, fields, lambda name: [F.count_if(is_missing(fields[name])).alias("missing")]
    )


def activity_columns(df: DataFrame, prefix: str = V.ACTIVITY_PREFIX) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``min_<column>`` and ``max_<column>`` for every column."""
    lows = [F.min(c).alias(f"min_{c}") for c in columns]
    highs = [F.max(c).alias(f"max_{c}") for c in columns]
    return df.agg(*lows, *highs)


def describe_numeric(df: DataFrame, columns: Sequence[str] = V.DESCRIBED_FINANCIALS) -> DataFrame:
    """Count, mean, spread and range of the numeric readings, and how many values have none."""

    raw, parsed = "raw_{}".format, "parsed_{}".format

    def reading(name: str) -> Column:
        return as_type(F.col(name), WIDE, isinstance(df.schema[name].dataType, T.StringType))

    def measures(name: str) -> list[Column]:
        number = F.col(parsed(name))
        return [
            F.count(number).alias("count"),
            F.avg(number).alias("mean"),
            F.stddev_samp(number).alias("stddev"),
            F.min(number).alias("min"),
            F.max(number).alias("max"),
            (F.count(raw(name)) - F.count(number)).alias("unparsed"),
        ]

    # parsed in a projection of its own, once for all measures
    readings = df.select(
        *[F.col(c).alias(raw(c)) for c in columns], *[reading(c).alias(parsed(c)) for c in columns]
    )
    return _per_column(readings, columns, measures)


def numeric_check(df: DataFrame, column: str) -> DataFrame:
    """How many texts are all digits and how many are not; null is neither."""
    digits = F.col(column).rlike(V.DIGITS_PATTERN)
    return df.agg(
        F.count_if(digits).alias("numeric_count"),
        F.count_if(~digits).alias("non_numeric_count"),
    )


def non_numeric_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(~F.col(column).rlike(V.DIGITS_PATTERN)).select(column).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str] = V.FEATURE_KEYS) -> DataFrame:
    """How much a left join onto these rows would fan out: repeated keys and surplus rows."""
    complete = df.dropna(subset=list(keys))
    per_key = complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.where("n > 1").agg(
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.max("n"), F.lit(0)).alias("rows_of_largest_key"),
    )
