"""Small tables for tests."""

from __future__ import annotations

from snapmill.schemas import TABLES


def raw(spark, name: str, *rows: dict, **defaults):
    """Raw rows of a table, all text; columns not given are null."""
    columns = TABLES[name].columns
    data = [tuple({**defaults, **r}.get(c) for c in columns) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def column(df, name: str) -> list:
    return [r[name] for r in df.select(name).collect()]


def one(df) -> dict:
    (row,) = df.collect()
    return row.asDict()


def in_order(df) -> list[str]:
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
