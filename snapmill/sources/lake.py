"""The lake: bronze, silver and gold tables as Parquet, one partition per snapshot month."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill import fixed_values as V
from snapmill.functions.calendar import DateLike, month_list
from snapmill.operators.slicing import snapshot_slice, spine_slice
from snapmill.session import compile_wide_stages, join_on_buckets
from snapmill.sources.shared import exists, remove_folder

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
QUARANTINE, MARKS = "quarantine", "marks"
FEATURE_STORE, LABEL_STORE = "feature_store", "label_store"
#: The label store's outer partitions: one per label definition.
LABEL_DEF = "label_def"

QUARANTINE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("reason", "line", "file", "source")])

MARKS_SCHEMA = T.StructType([T.StructField("mark", T.StringType()), T.StructField("month", T.DateType())])

#: Columns named like this help to tell what is left out and are not written.
HELPER = "__"

_REASON, _KEPT = f"{HELPER}reason", "kept"


def months_between(start: DateLike | None, end: DateLike | None) -> list[date] | None:
    """The months of a range, which must have some; None without a range."""
    if start is None and end is None:
        return None
    if start is None or end is None:
        raise ValueError("a range has both a start and an end")
    months = month_list(start, end)
    if not months:
        raise ValueError(f"no month starts between {start} and {end}")
    return months


class Written(dict):
    """Rows written per month; ``reasons`` has the rows left out by reason, ``dropped`` all of them."""

    def __init__(self, months: Mapping[date, int], reasons: Mapping[str, int] | None = None):
        super().__init__(months)
        self.reasons = dict(reasons or {})

    @property
    def dropped(self) -> int:
        return sum(self.reasons.values())


class Lake:
    """Tables below one root folder, which may be any path Spark can read and write.

    With ``buckets`` the silver tables are bucketed and sorted by customer, so that joins on
    customer and snapshot need no shuffle. That costs one shuffle when they are written and pays
    as soon as they are joined more than once. The number is kept beside the tables; whoever
    opens the lake later need not give it and cannot change it.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = compile_wide_stages(spark)
        self.root = root.rstrip("/")
        self._spec = f"{self.root}/{SILVER}_buckets"
        self.buckets = self._stored_buckets(buckets)

    def _stored_buckets(self, asked: int | None) -> int | None:
        if exists(self.spark, self._spec):
            (stored,) = self.spark.read.schema("buckets int").parquet(self._spec).first()
        else:
            if asked and exists(self.spark, f"{self.root}/{SILVER}"):
                raise ValueError(f"{self.root}: the silver tables are there already, without buckets")
            stored = asked
            if asked:
                self.spark.createDataFrame([(asked,)], "buckets int").coalesce(1).write.parquet(self._spec)
        if asked and asked != stored:
            raise ValueError(f"{self.root}: the silver tables have {stored} buckets, not {asked}")
        if stored:
            join_on_buckets(self.spark)
        return stored

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str, schema: T.StructType, by_bucket: bool = True) -> DataFrame:
        """All snapshots of a table. The schema is declared, so no file is opened for it.

        A bucketed table is read by one task per bucket where a join or aggregate makes use of that.
        ``by_bucket=False`` reads its files like any, split by size.
        """
        if by_bucket and self._is_bucketed(layer):
            return self.spark.table(self._registered(layer, table, schema))
        return self.spark.read.schema(schema).parquet(self.path(layer, table))

    def _is_bucketed(self, layer: str) -> bool:
        return layer == SILVER and self.buckets is not None

    def _registered(self, layer: str, table: str, schema: T.StructType) -> str:
        """The session's name of a bucketed table, with the months that are stored now.

        Spark knows buckets by the catalog only. The files belong to the lake, so the entry can
        be made in any session.
        """
        path = self.path(layer, table)
        name = f"snapmill_{layer}_{table}_{zlib.crc32(path.encode()):08x}"
        if not self.spark.catalog.tableExists(name):
            months_last = [f for f in schema if f.name != V.SNAPSHOT] + [schema[V.SNAPSHOT]]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in months_last)
            location = path.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({V.SNAPSHOT}) "
                f"CLUSTERED BY ({V.ENTITY}) SORTED BY ({V.ENTITY}) INTO {self.buckets} BUCKETS LOCATION '{location}'"
            )
        if exists(self.spark, path):
            self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        return name

    def read_month(self, layer: str, table: str, schema: T.StructType, month: DateLike) -> DataFrame:
        return snapshot_slice(self.read(layer, table, schema), month)

    def read_months(
        self,
        layer: str,
        table: str,
        schema: T.StructType,
        start: DateLike | None,
        end: DateLike | None,
        by_bucket: bool = True,
    ) -> DataFrame:
        """The months of a range, or all without one."""
        rows = self.read(layer, table, schema, by_bucket)
        return rows if months_between(start, end) is None else spine_slice(rows, start, end)

    def write_months(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        start: DateLike | None,
        end: DateLike | None,
        gather: bool,
        left_out: Mapping[str, Column] | None = None,
    ) -> Written:
        """``replace_months`` for all months of a range, or for all there are without one."""
        return self.replace_months(df, layer, table, months_between(start, end), gather, left_out)

    def replace_months(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        months: Sequence[date] | None,
        gather: bool,
        left_out: Mapping[str, Column] | None = None,
    ) -> Written:
        """Replace the snapshots of these months by the rows of ``df``, in one job.

        Without ``months`` the whole table is replaced; which months there are is seen while writing.
        Returns the rows written per month and how many were left out. Other months are left
        alone; months without rows end up empty, so a re-run gives the same table.
        ``left_out`` maps reasons to conditions; a row counts for the first that holds and is not
        written. Such rows travel empty, so they are counted where tasks count once even when run
        again. Columns whose name begins with HELPER are there for the conditions only.

        While writing, only the months seen are gathered, whatever the length of the range. Rows
        per month are counted afterwards; the files say in their footers how many they hold.

        ``gather`` brings the rows of a month together first, in pieces of the advisory
        partition size. Use it when tasks hold rows of many months, else every task writes a
        small file for each. Large months are cut into many pieces, so no task gets a whole
        one; that is done by adaptive execution and without it rows stay where they are.
        """
        self._forget(layer, table, months)
        parts = None if months is None else [(m,) for m in months]
        counts, reasons = self._replace(df, layer, table, parts, [V.SNAPSHOT], gather, left_out)
        return Written({m: n for (m,), n in counts.items()}, reasons)

    def replace_definitions(
        self, df: DataFrame, table: str, definitions: Iterable[str], months: Sequence[date], gather: bool
    ) -> dict[str, Written]:
        """Replace these months of these definitions in a gold table that is kept by definition.

        Months of other definitions are left alone, as are other months of these. One job for all
        definitions; see ``replace_months``.
        """
        definitions = list(dict.fromkeys(definitions))
        for d in definitions:
            self._forget(GOLD, definition_name(table, d), months)
        counts, _ = self._replace(df, GOLD, table, [(d, m) for d in definitions for m in months], [LABEL_DEF, V.SNAPSHOT], gather)
        return {d: Written({m: counts[d, m] for m in months}) for d in definitions}

    def _replace(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        parts: Sequence[tuple] | None,
        keys: Sequence[str],
        gather: bool,
        left_out: Mapping[str, Column] | None = None,
    ) -> tuple[dict[tuple, int], dict[str, int]]:
        """Replace the given partitions, tuples of values of ``keys``, or all without any given.

        Returns rows per partition and rows left out by reason.
        """
        target = self.path(layer, table)
        data = [f for f in df.schema if f.name not in keys and not f.name.startswith(HELPER)]
        schema = T.StructType(data + [df.schema[k] for k in keys])
        left_out = left_out or {}
        reason = F.lit(_KEPT)
        for name, condition in reversed(left_out.items()):
            reason = F.when(condition, F.lit(name)).otherwise(reason)
        out = df.select(reason.alias(_REASON), *schema.names)
        kept = F.col(_REASON) == _KEPT
        if left_out:
            out = out.select(_REASON, *[F.when(kept, F.col(c)).alias(c) for c in schema.names])
        bucketed = self._is_bucketed(layer)
        if bucketed:
            # a task holds whole buckets, which are a file a month then; a very large one is cut
            out = out.hint("rebalance", self.buckets, F.col(V.ENTITY))
        elif gather and self.spark.conf.get("spark.sql.adaptive.enabled") == "true":
            out = out.hint("rebalance", *[F.col(k) for k in keys])
        # observed after the shuffle: tasks of the last stage count once even when re-run
        seen = Observation(f"{layer}.{table}")
        place = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
        out = out.observe(
            seen,
            F.array_join(F.collect_set(F.when(kept, place)), ",").alias("parts"),
            *[F.count_if(F.col(_REASON) == name).alias(name) for name in left_out],
        )
        writer = out.where(kept).drop(_REASON).write
        if bucketed:
            with self._dynamic_overwrite():
                writer.insertInto(self._registered(layer, table, schema), overwrite=True)
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(target)
        found = seen.get
        written = {tuple(p.split("/")) for p in found["parts"].split(",") if p}
        stored = self.read(layer, table, schema)
        if parts is not None:
            stored = stored.where(_is_one_of(keys, parts))
        counts = dict.fromkeys(parts or [], 0)
        for r in stored.groupBy(*keys).count().collect():  # a row per partition
            part = tuple(r[k] for k in keys)
            if tuple(map(str, part)) in written:
                counts[part] = r["count"]
            else:  # left by an earlier run
                counts[part] = 0
                self._empty(layer, table, schema, dict(zip(keys, part)))
        return counts, {name: found[name] for name in left_out}

    @contextmanager
    def _dynamic_overwrite(self) -> Iterator[None]:
        """For inserts, which take this from the session alone."""
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def _empty(self, layer: str, table: str, schema: T.StructType, part: Mapping[str, object]) -> None:
        """Clear a partition that has no rows any more."""
        folder = f"{self.path(layer, table)}/" + "/".join(f"{k}={v}" for k, v in part.items())
        if self._is_bucketed(layer):  # an empty file would have no bucket
            remove_folder(self.spark, folder)
        else:
            nothing = self.spark.createDataFrame([], schema).drop(*part)
            nothing.write.mode("overwrite").parquet(folder)

    def _marks_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{MARKS}/{layer}/{table}"

    def marks(self, layer: str, table: str) -> dict[date, str]:
        """What the stored months were made from, as far as ``remember`` was told since they were last written."""
        path = self._marks_path(layer, table)
        if not exists(self.spark, path):
            return {}
        return {r["month"]: r["mark"] for r in self.spark.read.schema(MARKS_SCHEMA).parquet(path).collect()}  # a row per month

    def remember(self, layer: str, table: str, marks: Mapping[date, str]) -> None:
        """Keep a mark for each of these months until they are written again."""
        if marks:
            self._write_marks(layer, table, {**self.marks(layer, table), **marks})

    def _forget(self, layer: str, table: str, months: Iterable[date] | None) -> None:
        """Before months, or all, are written: whatever comes of it, their marks no longer hold."""
        known = self.marks(layer, table)
        gone = set(known if months is None else months)
        if not known.keys().isdisjoint(gone):
            self._write_marks(layer, table, {m: mark for m, mark in known.items() if m not in gone})

    def _write_marks(self, layer: str, table: str, marks: Mapping[date, str]) -> None:
        """One small file. Lost half-way it is as if nothing were known, so all is written again."""
        rows = self.spark.createDataFrame([(mark, m) for m, mark in marks.items()], MARKS_SCHEMA)
        rows.coalesce(1).write.mode("overwrite").parquet(self._marks_path(layer, table))

    def _quarantine_path(self, table: str, source: str) -> str:
        return f"{self.path(QUARANTINE, table)}/source={quote(source, safe='')}"

    def write_quarantine(self, lines: DataFrame | None, table: str, source: str) -> None:
        """Replace what is quarantined of a raw source: lines as reason, line, file; None for none."""
        path = self._quarantine_path(table, source)
        if lines is not None:
            lines.select("reason", "line", "file").write.mode("overwrite").parquet(path)
        elif exists(self.spark, path):
            remove_folder(self.spark, path)

    def read_quarantine(self, table: str) -> DataFrame:
        """Raw lines of a table that were put aside, as reason, line, file, source; maybe none."""
        path = self.path(QUARANTINE, table)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], QUARANTINE_SCHEMA)
        return self.spark.read.schema(QUARANTINE_SCHEMA).parquet(path)


def definition_name(table: str, definition: str) -> str:
    """A definition's part of a table, as the lake's marks name it."""
    return f"{table}/{LABEL_DEF}={definition}"


def _is_one_of(keys: Sequence[str], parts: Sequence[tuple]) -> Column:
    """Partition values among the given ones. They are a grid, so one list per key prunes folders."""
    return reduce(Column.__and__, (F.col(k).isin(*{p[i] for p in parts}) for i, k in enumerate(keys)))
