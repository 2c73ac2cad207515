"""Month arithmetic for snapshot dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | date


def day(value: DateLike) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def month_start(value: DateLike) -> date:
    return day(value).replace(day=1)


def next_month(value: DateLike) -> date:
    first = month_start(value)
    return date(first.year + first.month // 12, first.month % 12 + 1, 1)


def month_list(start: DateLike, end: DateLike) -> list[date]:
    """First days of the months from the month of ``start`` up to ``end`` inclusive."""
    span = range(month_start(start).toordinal(), day(end).toordinal() + 1)
    return [d for d in map(date.fromordinal, span) if d.day == 1]


def on_spine(snapshot: Column, start: DateLike, end: DateLike) -> Column:
    """True for the first days of months within the range: the spine as a plain predicate."""
    return snapshot.between(F.lit(month_start(start)), F.lit(day(end))) & (
        snapshot == F.trunc(snapshot, "month")
    )
