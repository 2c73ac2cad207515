"""Cleaning rules. All of them keep a value or replace it by null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_underscores(text: Column) -> Column:
    """Delete every underscore, wherever it stands."""
    return F.replace(text, F.lit("_"), F.lit(""))


def null_if_placeholder(
    text: Column, placeholders: Sequence[str], placeholder_regex: str | None = None
) -> Column:
    """Null for the listed literals and, only if asked for, for a whole-pattern match."""
    hit = text.isin(*placeholders)
    if placeholder_regex is not None:
        hit = hit | text.rlike(placeholder_regex)
    return F.when(hit, None).otherwise(text)


def keep_listed(text: Column, allowed: Sequence[str]) -> Column:
    return F.when(text.isin(*allowed), text)


def keep_non_negative(number: Column) -> Column:
    return F.when(number >= 0, number)


def keep_between(value: Column, bounds: tuple[float, float], measure: Column | None = None) -> Column:
    """Keep ``value`` when it (or ``measure``, its numeric reading) is within both bounds."""
    reading = value if measure is None else measure
    return F.when(reading.between(*bounds), value)


def matches(text: Column, pattern: str) -> Column:
    """Validity flag; null stays null."""
    return text.rlike(pattern)


def keep_valid(value: Column, flag: Column) -> Column:
    return F.when(flag, value)
