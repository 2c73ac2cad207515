"""Bronze, silver and gold jobs. Each handles any month range in one Spark job.

A single month is the range from that month to itself. Every job returns the rows it wrote
per month; what ingest left out is in ``reasons`` of its result.

``catch_up`` does what ``backfill`` does for months whose raw rows changed, and only for them.
"""

from __future__ import annotations

import zlib
from collections.abc import Collection, Iterable, Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill import fixed_values as V
from snapmill.functions.calendar import DateLike, day, month_start
from snapmill.operators.features import build_features
from snapmill.operators.joins import HEAVY_ROWS, find_heavy_keys
from snapmill.operators.labels import label_definition, labels_by_definition
from snapmill.operators.refine import REFINERS
from snapmill.schemas import ATTRIBUTES, CLICKSTREAM, FINANCIALS, LOANS, TABLES
from snapmill.sources.lake import (
    BRONZE,
    FEATURE_STORE,
    GOLD,
    LABEL_STORE,
    SILVER,
    Lake,
    Written,
    definition_name,
    months_between,
)
from snapmill.sources.raw import FAULT, FAULTS, FILE, LINE, dated, parse_raw, read_raw

UNDATED, OFF_SPINE, OUT_OF_RANGE = "undated", "off_spine", "out_of_range"
FEATURE_PARTS = (ATTRIBUTES, CLICKSTREAM, FINANCIALS)

#: The mark of a month without rows.
NOTHING = "0"
#: Stands for the lines in quarantine where months are keys: a day that begins none.
NO_MONTH = date(1970, 1, 2)


def _misplaced() -> dict[str, Column]:
    """Why a raw line belongs to no month at all, the first reason that holds."""
    snapshot = F.col(V.SNAPSHOT)
    return {
        **{fault: F.col(FAULT) == fault for fault in FAULTS},
        UNDATED: snapshot.isNull(),
        OFF_SPINE: snapshot != F.trunc(snapshot, "month"),
    }


def _reason() -> Column:
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in _misplaced().items()])


def _in_range(start: DateLike, end: DateLike) -> Column:
    return F.col(V.SNAPSHOT).between(F.lit(month_start(start)), F.lit(day(end)))


def ingest(
    lake: Lake,
    table: str,
    raw_path: str,
    start: DateLike | None = None,
    end: DateLike | None = None,
    gather: bool = True,
    line_breaks: bool = False,
    quarantine: Collection[str] = FAULTS,
) -> Written:
    """Raw CSV to bronze: one scan for all months, columns kept as text.

    Without a range the table becomes what the files hold, months of an earlier run included.
    What is not stored is counted by reason, in ``reasons`` of the result: lines with an open
    quote, too few or too many fields, rows without a date, between months or out of range.
    Lines left out for a reason in ``quarantine``, any but the last, are kept in a table of their own,
    by raw source, which takes a second scan of files that have any. ``line_breaks`` is that of
    ``parse_raw``.

    Raw files that mix months are gathered, which shuffles them once. Where every file holds
    few months already, ``gather=False`` saves that.
    """
    lines = dated(parse_raw(lake.spark, TABLES[table], raw_path, line_breaks, files=False))
    beyond = F.lit(False) if months_between(start, end) is None else ~_in_range(start, end)
    reasons = {**_misplaced(), OUT_OF_RANGE: beyond}
    written = lake.write_months(lines.drop(LINE), BRONZE, table, start, end, gather, reasons)
    _quarantine(lake, table, raw_path, line_breaks, quarantine, any(written.reasons[r] for r in quarantine))
    return written


def _quarantine(
    lake: Lake, table: str, raw_path: str, line_breaks: bool, reasons: Collection[str], any_stray: bool
) -> None:
    if not any_stray:
        lake.write_quarantine(None, table, raw_path)
        return
    lines = _may_be_stray(lake, table, raw_path, line_breaks, reasons)
    stray = lines.select(_reason().alias("reason"), F.col(LINE).alias("line"), F.col(FILE).alias("file"))
    lake.write_quarantine(stray.where(F.col("reason").isin(*reasons)), table, raw_path)


def _may_be_stray(lake: Lake, table: str, raw_path: str, line_breaks: bool, reasons: Collection[str]) -> DataFrame:
    """All raw lines that are left out for these reasons, and others."""
    return dated(parse_raw(lake.spark, TABLES[table], raw_path, line_breaks, suspects=set(reasons) <= set(FAULTS)))


def raw_range(lake: Lake, raw_paths: Mapping[str, str], line_breaks: bool = False) -> tuple[date, date] | None:
    """First and last date in the raw tables, for jobs over all there is; None without any."""
    ends = []
    for table, path in raw_paths.items():
        rows = dated(read_raw(lake.spark, TABLES[table], path, line_breaks))
        ends.append(rows.agg(F.min(V.SNAPSHOT).alias("first"), F.max(V.SNAPSHOT).alias("last")).first())
    ends = [e for e in ends if e["first"] is not None]
    return (min(e["first"] for e in ends), max(e["last"] for e in ends)) if ends else None


def refine(lake: Lake, table: str, start: DateLike | None = None, end: DateLike | None = None) -> Written:
    """Bronze to silver, of all months without a range. Tasks read few months each, so rows are written where they are, or by bucket."""
    bronze = lake.read_months(BRONZE, table, TABLES[table].bronze_schema, start, end)
    return lake.write_months(REFINERS[table](bronze), SILVER, table, start, end, gather=False)


def publish_features(
    lake: Lake, start: DateLike | None = None, end: DateLike | None = None, heavy_rows: int = HEAVY_ROWS
) -> Written:
    """Silver to the feature store, all months without a range. Bucketed silver tables are joined without a shuffle."""
    return _publish_features(lake, months_between(start, end), heavy_rows)


def _publish_features(lake: Lake, months: Sequence[date] | None, heavy_rows: int = HEAVY_ROWS) -> Written:
    def stored(by_bucket: bool) -> dict[str, DataFrame]:
        tables = {t.name: lake.read(SILVER, t.name, t.silver_schema, by_bucket) for t in FEATURE_PARTS}
        return {name: df.where(_of_months(months)) for name, df in tables.items()}

    heavy = find_heavy_keys(stored(by_bucket=False), heavy_rows=heavy_rows)
    # heavy keys are dealt out of their buckets, which then would only hold up the scan
    parts = stored(by_bucket=not heavy)
    features = build_features(*parts.values(), heavy=heavy)
    # the join leaves all months in every task
    return lake.replace_months(features, GOLD, FEATURE_STORE, months, gather=True)


def _of_months(months: Sequence[date] | None) -> Column:
    return F.lit(True) if months is None else F.col(V.SNAPSHOT).isin(*months)


def publish_label_definitions(
    lake: Lake, start: DateLike, end: DateLike, definitions: Iterable[tuple[int, int]]
) -> dict[str, Written]:
    """Silver loans to the label store, for several definitions (dpd, mob) in one scan.

    The store is partitioned by definition and month. Only the months of the range of the
    definitions given are replaced.
    """
    return _publish_labels(lake, months_between(start, end), definitions)


def _publish_labels(
    lake: Lake, months: Sequence[date], definitions: Iterable[tuple[int, int]]
) -> dict[str, Written]:
    definitions = list(dict.fromkeys(definitions))
    loans = lake.read(SILVER, LOANS.name, LOANS.silver_schema).where(_of_months(months))
    names = [label_definition(*d) for d in definitions]
    labels = labels_by_definition(loans, definitions)
    # a thin result: few rows per task, so gathering is cheap and avoids tiny files
    return lake.replace_definitions(labels, LABEL_STORE, names, months, gather=True)


def publish_labels(
    lake: Lake, start: DateLike, end: DateLike, dpd: int = V.LABEL_DPD, mob: int = V.LABEL_MOB
) -> Written:
    """Silver loans to the label store, by one definition; all others stay as they are."""
    (written,) = publish_label_definitions(lake, start, end, [(dpd, mob)]).values()
    return written


def backfill(
    lake: Lake,
    raw_paths: Mapping[str, str],
    start: DateLike | None = None,
    end: DateLike | None = None,
    dpd: int = V.LABEL_DPD,
    mob: int = V.LABEL_MOB,
    gather: bool = True,
    line_breaks: bool = False,
    quarantine: Collection[str] = FAULTS,
) -> dict[str, Written]:
    """All layers of the given raw tables over the range; stores whose inputs are there.

    Without a range all tables and the feature store become what the raw files hold; labels are
    published for the months the loans have.
    ``gather``, ``line_breaks`` and ``quarantine`` are those of ``ingest``. What it dropped is in the
    bronze entries of the report.
    """
    report: dict[str, Written] = {}
    for table, path in raw_paths.items():
        report[f"{BRONZE}.{table}"] = ingest(lake, table, path, start, end, gather, line_breaks, quarantine)
        report[f"{SILVER}.{table}"] = refine(lake, table, start, end)
    if {t.name for t in FEATURE_PARTS} <= raw_paths.keys():
        report[f"{GOLD}.{FEATURE_STORE}"] = publish_features(lake, start, end)
    if LOANS.name in raw_paths:
        months = list(report[f"{SILVER}.{LOANS.name}"])
        if months:
            (report[f"{GOLD}.{LABEL_STORE}"],) = _publish_labels(lake, months, [(dpd, mob)]).values()
    return report


# ------------------------------------------------------------------ only what changed
def _checksum(columns: Sequence[str]) -> Column:
    """Rows and two sums of their hashes: the same for equal rows in any order.

    A null hashes like nothing, so the numbers between the columns keep them apart. Hashes are summed
    in three parts of up to 22 bits, as longs, which costs a fraction of a sum of decimals.
    """
    cells = [c for i, name in enumerate(columns) for c in (F.col(name), F.lit(i))]

    def total(seed: int) -> Column:
        own, low = F.xxhash64(F.lit(seed), *cells), F.lit((1 << 21) - 1)
        parts = F.shiftright(own, 42), F.shiftright(own, 21).bitwiseAND(low), own.bitwiseAND(low)
        high, middle, rest = (F.sum(p).cast("decimal(20,0)") for p in parts)
        by = F.lit(1 << 21).cast("decimal(7,0)")
        return (high * by + middle) * by + rest

    return F.concat_ws(":", F.count(F.lit(1)), *[total(seed).cast("string") for seed in (1, 2)])


def raw_marks(
    lines: DataFrame, columns: Sequence[str], months: Sequence[date], quarantine: Collection[str] = FAULTS
) -> dict[date, str]:
    """A checksum of the rows of every month, and of the lines to quarantine, in one scan."""
    kept = F.col("reason").isNull() & _of_months(months)
    stray = F.col("reason").isin(*quarantine)
    # all other lines are a group of their own: as a condition on the scan this would be worked out twice
    keyed = lines.withColumn("reason", _reason()).select(
        F.when(stray, F.lit(NO_MONTH)).when(kept, F.col(V.SNAPSHOT)).alias("month"),
        *[F.when(kept, F.col(c)).alias(c) for c in columns],
        F.when(stray, F.col(LINE)).alias(LINE),
    )
    marks = keyed.groupBy("month").agg(_checksum([*columns, LINE]).alias("mark"))
    found = {r["month"]: r["mark"] for r in marks.collect() if r["month"]}  # a row per month of the range
    return dict.fromkeys([*months, NO_MONTH], NOTHING) | found


def _differing(source: Mapping[date, str], own: Mapping[date, str], months: Sequence[date]) -> list[date]:
    """Months that are not known to be made from the source as it is now."""
    return [m for m in months if m not in source or source[m] != own.get(m)]


def _catch_up_bronze(
    lake: Lake,
    table: str,
    raw_path: str,
    months: Sequence[date],
    gather: bool,
    line_breaks: bool,
    quarantine: Collection[str],
) -> Written:
    lines = dated(parse_raw(lake.spark, TABLES[table], raw_path, line_breaks, files=False))
    columns = TABLES[table].columns
    stored = lake.marks(BRONZE, table)
    # without a mark to compare with every month is written, whatever a scan would find
    compared = not stored.keys().isdisjoint(months)
    now = raw_marks(lines, columns, months, quarantine) if compared else {}
    changed = _differing(now, stored, months)
    written = Written({})
    if changed:
        # rows of unchanged months are neither stored nor left out: they are there already
        unchanged = F.coalesce(F.col(V.SNAPSHOT).isin(*(set(months) - set(changed))), F.lit(False))
        others = lines.where(F.col(FAULT).isNotNull() | ~unchanged).drop(LINE)
        reasons = {**_misplaced(), OUT_OF_RANGE: ~_of_months(months)}
        written = lake.replace_months(others, BRONZE, table, changed, gather, reasons)
        # from what was stored, should the files have changed meanwhile
        bronze = lake.read(BRONZE, table, TABLES[table].bronze_schema).where(_of_months(changed))
        marks = raw_marks(bronze.withColumns({FAULT: F.lit(None).cast("string"), LINE: F.lit(None).cast("string")}), columns, changed)
        lake.remember(BRONZE, table, {m: marks[m] for m in changed})
    if not compared:
        now = {NO_MONTH: NOTHING}
        if any(written.reasons[r] for r in quarantine):
            now = raw_marks(_may_be_stray(lake, table, raw_path, line_breaks, quarantine), columns, [], quarantine)
    if now[NO_MONTH] != stored.get(NO_MONTH, NOTHING):
        _quarantine(lake, table, raw_path, line_breaks, quarantine, now[NO_MONTH] != NOTHING)
        lake.remember(BRONZE, table, {NO_MONTH: now[NO_MONTH]})
    return written


def _marked_by_rules(lake: Lake, table: str) -> dict[date, str]:
    """Marks of bronze with a mark of the table's rules: silver changes with either."""
    rules = zlib.crc32(repr(TABLES[table]).encode())
    return {m: f"{mark}@{rules}" for m, mark in lake.marks(BRONZE, table).items() if m != NO_MONTH}


def catch_up(
    lake: Lake,
    raw_paths: Mapping[str, str],
    start: DateLike,
    end: DateLike,
    definitions: Sequence[tuple[int, int]] = ((V.LABEL_DPD, V.LABEL_MOB),),
    gather: bool = True,
    line_breaks: bool = False,
    quarantine: Collection[str] = FAULTS,
) -> dict[str, Written]:
    """``backfill`` for the months whose input changed since they were written.

    Every raw table is scanned once for checksums by month, which do not depend on the order of
    rows or files, unless no month has one to compare with. Beside the lake
    every stored month of every table has the mark of what it was made from: bronze the checksum of its rows, silver bronze's mark and the cleaning rules, gold the
    marks of the silver tables it reads. A month whose mark differs, or that was written by
    another job meanwhile, is written again, in one job for all of them; others are not touched.
    A mark is kept once its month is written, so a run that broke off is taken up where it ended.

    The report has the months written; tables without any have none. Several label ``definitions``
    are kept up.
    """
    months = months_between(start, end)
    report: dict[str, Written] = {}
    for table, path in raw_paths.items():
        report[f"{BRONZE}.{table}"] = _catch_up_bronze(lake, table, path, months, gather, line_breaks, quarantine)
        source = _marked_by_rules(lake, table)
        changed = _differing(source, lake.marks(SILVER, table), months)
        report[f"{SILVER}.{table}"] = Written({})
        if changed:
            bronze = lake.read(BRONZE, table, TABLES[table].bronze_schema).where(_of_months(changed))
            report[f"{SILVER}.{table}"] = lake.replace_months(REFINERS[table](bronze), SILVER, table, changed, gather=False)
            lake.remember(SILVER, table, {m: source[m] for m in changed})

    if {t.name for t in FEATURE_PARTS} <= raw_paths.keys():
        parts = [lake.marks(SILVER, t.name) for t in FEATURE_PARTS]
        source = {m: "|".join(p[m] for p in parts) for m in reduce(and_, (p.keys() for p in parts))}
        changed = _differing(source, lake.marks(GOLD, FEATURE_STORE), months)
        report[f"{GOLD}.{FEATURE_STORE}"] = _publish_features(lake, changed) if changed else Written({})
        lake.remember(GOLD, FEATURE_STORE, {m: source[m] for m in changed})

    if LOANS.name in raw_paths:
        source = lake.marks(SILVER, LOANS.name)
        names = {definition_name(LABEL_STORE, label_definition(*d)): d for d in definitions}
        behind = {name: _differing(source, lake.marks(GOLD, name), months) for name in names}
        # definitions with the same months to do share a scan
        for changed in sorted({tuple(c) for c in behind.values() if c}):
            together = [name for name in names if tuple(behind[name]) == changed]
            written = _publish_labels(lake, changed, [names[n] for n in together])
            for name, own in zip(together, written.values()):
                report[f"{GOLD}.{name}"] = own
                lake.remember(GOLD, name, {m: source[m] for m in changed})
        for name in names:
            report.setdefault(f"{GOLD}.{name}", Written({}))
    return report
