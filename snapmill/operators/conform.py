"""Apply a table's column rules: one projection that types, one that nulls bad values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill.functions import casts, clean
from snapmill.schemas import ColumnRule, SnapshotTable


def typed(rule: ColumnRule, source: T.DataType) -> Column:
    value = F.col(rule.name)
    is_text = rule.strip or isinstance(source, T.StringType)
    if rule.strip:
        value = clean.strip_underscores(value)
    cast = casts.as_measured if rule.measured else casts.as_type
    return cast(value, rule.type, is_text).alias(rule.name)


def cleaned(rule: ColumnRule) -> Column:
    value = F.col(rule.name)
    if rule.placeholders:
        value = clean.null_if_placeholder(value, rule.placeholders, rule.placeholder_regex)
    if rule.allowed:
        value = clean.keep_listed(value, rule.allowed)
    if rule.non_negative and rule.bounds is None:
        value = clean.keep_non_negative(value)
    if rule.bounds is not None:
        low, high = rule.bounds
        if rule.non_negative:  # one range instead of two nested tests
            low = max(low, 0)
        measure = casts.parse(value, casts.COUNT) if rule.type == casts.TEXT else None
        value = clean.keep_between(value, (low, high), measure)
    return value.alias(rule.name)


def type_columns(df: DataFrame, table: SnapshotTable) -> DataFrame:
    """Schema enforcement alone: every column gets its type, misfits become null."""
    return df.select(*[typed(rule, df.schema[rule.name].dataType) for rule in table.rules])


def conform(df: DataFrame, table: SnapshotTable) -> DataFrame:
    """Typed and cleaned columns of the table, in its column order."""
    return type_columns(df, table).select(*map(cleaned, table.rules))
