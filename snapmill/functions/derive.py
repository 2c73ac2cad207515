"""Derived columns.

Null handling is part of each definition: band functions send null to their ``otherwise``
branch, row-wise sums are null as soon as one term is, and counts treat null as zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmill.functions.casts import captured_number, fits_int

# The first date whose day number fits Spark's 32-bit date: 23 June of this year.
FIRST_YEAR, FIRST_MONTH, FIRST_DAY = -5_877_641, 6, 23


def _bands(value: Column, edges: Sequence[tuple], fallback, below: bool) -> Column:
    branches = None
    for edge, name in edges:
        test = value < edge if below else value > edge
        branches = F.when(test, name) if branches is None else branches.when(test, name)
    return branches.otherwise(fallback)


def band_below(value: Column, edges: Sequence[tuple], fallback) -> Column:
    """First edge the value is strictly below; null and the rest get ``fallback``."""
    return _bands(value, edges, fallback, below=True)


def band_above(value: Column, edges: Sequence[tuple], fallback) -> Column:
    """First edge the value is strictly above; null and the rest get ``fallback``."""
    return _bands(value, edges, fallback, below=False)


def categorise(text: Column, groups: Mapping[str, Sequence[str]], missing: str, fallback: str) -> Column:
    """Name of the group that lists the value."""
    branches = F.when(text.isNull(), missing)
    for name, members in groups.items():
        branches = branches.when(text.isin(*members), name)
    return branches.otherwise(fallback)


def _row_sum(columns: Sequence[str], term: str) -> Column:
    """Sum of a SQL term over the columns; as text it is one expression to send, not hundreds."""
    return F.expr(" + ".join(term.format(f"`{c}`") for c in columns))


def activity_total(columns: Sequence[str]) -> Column:
    """Row-wise sum of int columns. Added up as bigint, so only the result can overflow."""
    return fits_int(_row_sum(columns, "bigint({})"))


def activity_intensity(columns: Sequence[str]) -> Column:
    """Row-wise sum of absolute values of int columns."""
    return fits_int(_row_sum(columns, "abs(bigint({}))"))


def active_count(columns: Sequence[str]) -> Column:
    """How many columns are neither null nor zero."""
    return _row_sum(columns, "CASE WHEN {} <> 0 THEN 1 ELSE 0 END")


def history_months(text: Column, years_pattern: str, months_pattern: str) -> Column:
    """Duration text to months. Both parts must be there."""
    return fits_int(captured_number(text, years_pattern) * 12 + captured_number(text, months_pattern))


def ratio_when_positive(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, F.try_divide(numerator, denominator))


def missed_installments(overdue: Column, due: Column) -> Column:
    """Overdue amount in started installments; nothing due gives null."""
    return fits_int(F.ceil(F.try_divide(overdue, due)))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Snapshot minus the missed months, clamped to month end; null before the first date there is."""
    months_left = (F.year(snapshot) - FIRST_YEAR) * 12 + F.month(snapshot) - FIRST_MONTH
    months_left = months_left - F.when(F.day(snapshot) < FIRST_DAY, 1).otherwise(0)
    return F.when((missed >= 1) & (missed <= months_left), F.add_months(snapshot, F.negative(missed)))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    """Days from the first missed date to the snapshot; null where 32 bits do not hold them."""
    days = F.unix_date(snapshot).cast("bigint") - F.unix_date(first_missed)
    return F.when(overdue > 0, fits_int(days)).otherwise(0)


def reached(value: Column, threshold: int) -> Column:
    """1 when the value is at or over the threshold, else (and for null) 0."""
    return F.when(value >= threshold, 1).otherwise(0)


def share_present(columns: Sequence[str]) -> Column:
    """Share of the columns that are not null."""
    return reduce(add, (F.col(c).isNotNull().cast("int") for c in columns)) / len(columns)
