"""One query per operator group, over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill import fixed_values as V
from snapmill.functions import clean, derive
from snapmill.functions.calendar import DateLike
from snapmill.operators import features, joins, labels, profile, refine, slicing
from snapmill.operators.conform import conform, type_columns
from snapmill.plans import jobs
from snapmill.schemas import (
    ATTRIBUTES,
    CLICKSTREAM,
    FEATURE_STORE_SCHEMA,
    FINANCIALS,
    LABEL_STORE_SCHEMA,
    LOANS,
    TABLES,
)
from snapmill.sources.lake import BRONZE, FEATURE_STORE, GOLD, LABEL_STORE, QUARANTINE, SILVER, Lake
from snapmill.sources.raw import FAULTS, LINE, append_lines, read_lines, write_raw
from snapmill.sources.shared import remove_folder, shared_folder
from snapmill.workload.views import (
    LOAN_COLUMNS,
    RAW,
    dirty_lines,
    raw_attributes,
    raw_clicks,
    raw_financials,
    raw_loans,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters the checking SQL shares.
SLICE_MONTH = "1998-03-01"
COHORT_CUTOFF = "1999-01-01"
LAST_LINE = 7
LOAN_RANGE = ("1996-01-01", "1998-12-15")
SNAPSHOT_RANGE = ("2024-02-01", "2024-11-01")
STORED_MONTH = "2024-05-01"
THINNED_MONTH = "1997-05-01"
LATER_LABELS_FROM, LATER_LABELS = "1996-06-01", ((60, 3), (1, 6))
HOT_LEFT, HOT_RIGHT = ("11", "2024-12-01"), ("7", "2024-08-01")
STRIPPED = [r.name for r in FINANCIALS.rules if r.strip]
BOUNDED = [r for r in FINANCIALS.rules if r.bounds]
NON_NEGATIVE = [r.name for r in FINANCIALS.rules if r.non_negative]

_KEYS = list(V.FEATURE_KEYS)


# ------------------------------------------------------------------ slicing and spine
def snapshot_slice(spark: SparkSession, sf: str) -> DataFrame:
    return slicing.snapshot_slice(raw_loans(spark, sf), SLICE_MONTH)


def month_spine(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of every month from the first to the last."""
    return slicing.month_counts(table(spark, sf, "orders"), "o_orderdate")


def spine_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows whose date is itself on the spine."""
    dated = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias(V.SNAPSHOT)
    )
    return slicing.spine_slice(dated, *LOAN_RANGE)


# ------------------------------------------------------------------ cleaning
def strip_underscore(spark: SparkSession, sf: str) -> DataFrame:
    stripped = [clean.strip_underscores(F.col(c)).alias(c) for c in STRIPPED]
    return raw_financials(spark, sf).select(*_KEYS, *stripped)


def _enforce(name: str) -> Query:
    return lambda spark, sf: type_columns(RAW[name](spark, sf), TABLES[name])


def sentinel_to_null(spark: SparkSession, sf: str) -> DataFrame:
    occupation = clean.null_if_placeholder(F.col("Occupation"), V.OCCUPATION_PLACEHOLDERS)
    return raw_attributes(spark, sf).select(*_KEYS, occupation.alias("Occupation"))


def sentinel_pattern_to_null(spark: SparkSession, sf: str) -> DataFrame:
    """Same, with underscores-only texts nulled as well."""
    occupation = clean.null_if_placeholder(
        F.col("Occupation"), V.OCCUPATION_PLACEHOLDERS, placeholder_regex=V.MISSING_TEXT_PATTERN
    )
    return raw_attributes(spark, sf).select(*_KEYS, occupation.alias("Occupation"))


def sentinel_to_null_financials(spark: SparkSession, sf: str) -> DataFrame:
    return raw_financials(spark, sf).select(
        *_KEYS,
        clean.null_if_placeholder(F.col("Credit_Mix"), V.CREDIT_MIX_PLACEHOLDERS).alias("Credit_Mix"),
        clean.null_if_placeholder(F.col("Type_of_Loan"), V.LOAN_TYPE_PLACEHOLDERS).alias("Type_of_Loan"),
    )


def range_to_null(spark: SparkSession, sf: str) -> DataFrame:
    typed = type_columns(raw_financials(spark, sf), FINANCIALS)
    kept = [clean.keep_between(F.col(r.name), r.bounds).alias(r.name) for r in BOUNDED]
    return typed.select(*_KEYS, *kept)


def range_to_null_age(spark: SparkSession, sf: str) -> DataFrame:
    return conform(raw_attributes(spark, sf), ATTRIBUTES).select(*_KEYS, "Age")


def negative_to_null(spark: SparkSession, sf: str) -> DataFrame:
    typed = type_columns(raw_financials(spark, sf), FINANCIALS)
    return typed.select(*_KEYS, *[clean.keep_non_negative(F.col(c)).alias(c) for c in NON_NEGATIVE])


def whitelist_to_null(spark: SparkSession, sf: str) -> DataFrame:
    kept = clean.keep_listed(F.col("Payment_Behaviour"), V.PAYMENT_BEHAVIOURS)
    return raw_financials(spark, sf).select(*_KEYS, kept.alias("Payment_Behaviour"))


def pattern_flag_mask(spark: SparkSession, sf: str) -> DataFrame:
    valid = clean.matches(F.col("SSN"), V.SSN_PATTERN)
    return raw_attributes(spark, sf).select(
        *_KEYS,
        "SSN",
        valid.alias("SSN_is_valid"),
        clean.keep_valid(F.col("SSN"), valid).alias("SSN_clean"),
    )


def zero_fill(spark: SparkSession, sf: str) -> DataFrame:
    return type_columns(raw_loans(spark, sf), LOANS).fillna(0)


# ------------------------------------------------------------------ derivations
def age_group(spark: SparkSession, sf: str) -> DataFrame:
    people = conform(raw_attributes(spark, sf), ATTRIBUTES)
    return people.select(*_KEYS, "Age", refine.age_group(F.col("Age")).alias("age_group"))


def occupation_category(spark: SparkSession, sf: str) -> DataFrame:
    people = conform(raw_attributes(spark, sf), ATTRIBUTES)
    category = refine.occupation_category(F.col("Occupation"))
    return people.select(*_KEYS, "Occupation", category.alias("occupation_category"))


def row_activity(spark: SparkSession, sf: str) -> DataFrame:
    clicks = type_columns(raw_clicks(spark, sf), CLICKSTREAM)
    return clicks.select(
        *_KEYS,
        derive.activity_total(V.ACTIVITY_COLUMNS).alias("total_activity"),
        derive.activity_intensity(V.ACTIVITY_COLUMNS).alias("activity_intensity"),
        derive.active_count(V.ACTIVITY_COLUMNS).alias("active_features_count"),
    )


def _financial(*columns: str) -> Query:
    return lambda spark, sf: refine.refine_financials(raw_financials(spark, sf)).select(*_KEYS, *columns)


def days_past_due(spark: SparkSession, sf: str) -> DataFrame:
    return refine.refine_loans(raw_loans(spark, sf)).select(
        "loan_id", "mob", V.SNAPSHOT, "due_amt", "overdue_amt", "installments_missed", "first_missed_date", "dpd"
    )


# ------------------------------------------------------------------ features
def _feature_parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        t.name: refine.REFINERS[t.name](RAW[t.name](spark, sf))
        for t in (ATTRIBUTES, CLICKSTREAM, FINANCIALS)
    }


def feature_join(spark: SparkSession, sf: str) -> DataFrame:
    parts = _feature_parts(spark, sf)
    return features.join_features(*parts.values(), heavy=joins.find_heavy_keys(parts))


def feature_join_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The join with a third of the attributes on one key and a third of the clicks on another."""
    parts = _feature_parts(spark, sf)
    third = {
        ATTRIBUTES.name: (F.col(V.ENTITY).try_cast("bigint") % 3 == 0, HOT_LEFT),
        CLICKSTREAM.name: (F.col("fe_1") < -16, HOT_RIGHT),
    }
    for name, (chosen, (entity, snapshot)) in third.items():
        parts[name] = parts[name].withColumns(
            {
                V.ENTITY: F.when(chosen, entity).otherwise(F.col(V.ENTITY)),
                V.SNAPSHOT: F.when(chosen, F.lit(snapshot).cast("date")).otherwise(F.col(V.SNAPSHOT)),
            }
        )
    # a low mark for "heavy", so that the sliced path runs at test scale too
    heavy = joins.find_heavy_keys(parts, heavy_rows=200)
    return features.join_features(*parts.values(), heavy=heavy)


def gold_features(spark: SparkSession, sf: str) -> DataFrame:
    parts = _feature_parts(spark, sf)
    return features.build_features(*parts.values(), heavy=joins.find_heavy_keys(parts))


def feature_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return gold_features(spark, sf).select(*_KEYS, "feature_completeness")


def health_score(spark: SparkSession, sf: str) -> DataFrame:
    return gold_features(spark, sf).select(*_KEYS, "financial_health_score")


# ------------------------------------------------------------------ labels
def silver_loan(spark: SparkSession, sf: str) -> DataFrame:
    return refine.refine_loans(raw_loans(spark, sf))


def loan_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labels.default_labels(silver_loan(spark, sf))


def cohort_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Last installments of the closed cohort with their past-due flag."""
    flagged = labels.closed_cohort(silver_loan(spark, sf), COHORT_CUTOFF)
    return labels.final_installments(flagged, LAST_LINE).select(
        "loan_id", "installment_num", "loan_start_date", "dpd", "dpd_flag"
    )


def bad_rate_by_mob(spark: SparkSession, sf: str) -> DataFrame:
    return labels.bad_rate_by_mob(silver_loan(spark, sf), COHORT_CUTOFF)


# ------------------------------------------------------------------ profiles
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return profile.row_count(table(spark, sf, "lineitem"))


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(raw_attributes(spark, sf), "Occupation")


def value_counts_entities(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(raw_clicks(spark, sf), V.ENTITY)


def value_counts_top(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(raw_clicks(spark, sf), V.ENTITY, limit=20)


def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_values(raw_attributes(spark, sf), "Occupation")


def distinct_values_head(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_values(raw_clicks(spark, sf), V.ENTITY, limit=50)


def distinct_count(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_count(raw_clicks(spark, sf), V.ENTITY)


def distinct_count_occupations(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_count(raw_attributes(spark, sf), "Occupation")


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_counts(raw_clicks(spark, sf))


def missing_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missing_counts(raw_attributes(spark, sf))


def missing_counts_documents(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missing_counts(table(spark, sf, "documents"))


def min_max(spark: SparkSession, sf: str) -> DataFrame:
    clicks = type_columns(raw_clicks(spark, sf), CLICKSTREAM)
    return profile.value_ranges(clicks, profile.activity_columns(clicks))


def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    described = profile.describe_numeric(raw_financials(spark, sf))
    # engines add doubles in different orders; the last digits are not part of the answer
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


def numeric_check(spark: SparkSession, sf: str) -> DataFrame:
    return profile.numeric_check(raw_attributes(spark, sf), "Age")


def non_numeric_values(spark: SparkSession, sf: str) -> DataFrame:
    return profile.non_numeric_values(raw_attributes(spark, sf), "Age")


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return profile.duplicate_keys(raw_clicks(spark, sf))


# ------------------------------------------------------------------ jobs through the lake
@contextmanager
def _landed(
    spark: SparkSession,
    sf: str,
    names,
    *unneeded: str,
    dirty: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int | None = None,
) -> Iterator[tuple[Lake, dict[str, str]]]:
    """Raw CSV files of the named tables, and an empty lake beside them.

    The raw files go when the jobs are done, and so do the layers that the result does not read.
    ``dirty`` makes lines from a table's rows that are added to its files.
    """
    root = shared_folder(spark, "run")
    paths = {name: f"{root}/raw/{name}" for name in names}
    for name, path in paths.items():
        rows = RAW[name](spark, sf)
        write_raw(rows, path)
        if dirty:
            append_lines(dirty(rows), ",".join(rows.columns), path)
    yield Lake(spark, f"{root}/lake", buckets), paths
    for folder in ("raw", *(f"lake/{layer}" for layer in unneeded)):
        remove_folder(spark, f"{root}/{folder}")


def _range_of(name: str) -> tuple[DateLike, DateLike]:
    return LOAN_RANGE if name == LOANS.name else SNAPSHOT_RANGE


def _bronze(spark: SparkSession, sf: str, name: str) -> DataFrame:
    with _landed(spark, sf, [name]) as (lake, paths):
        jobs.ingest(lake, name, paths[name])
    return lake.read(BRONZE, name, TABLES[name].bronze_schema).select(*TABLES[name].columns)


def per_month(rows: DataFrame, name: str) -> DataFrame:
    """Rows, entities and filled-in cells of a table by month."""
    filled = reduce(lambda a, b: a + b, (F.col(c).isNotNull().cast("int") for c in rows.columns))
    # by entity first, with two numbers in a group whatever the columns
    by_entity = rows.groupBy(V.SNAPSHOT, V.ENTITY).agg(F.count(F.lit(1)).alias("n"), F.sum(filled).alias("cells"))
    return by_entity.groupBy(F.lit(name).alias("source"), V.SNAPSHOT).agg(
        F.sum("n").alias("row_count"), F.count(V.ENTITY).alias("entities"), F.sum("cells").alias("cells")
    )


def bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, entities and filled-in cells per bronze table and month."""
    return reduce(DataFrame.unionByName, [per_month(_bronze(spark, sf, name), name) for name in TABLES])


def bronze_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf, ATTRIBUTES.name)


def ingest_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows kept per table, and lines left out by reason, when a part of the months is ingested."""
    report, reasons = [], (*FAULTS, jobs.UNDATED, jobs.OFF_SPINE, jobs.OUT_OF_RANGE)
    with _landed(spark, sf, TABLES, BRONZE, QUARANTINE, dirty=partial(dirty_lines, line_breaks=False)) as (lake, paths):
        for name, path in paths.items():
            written = jobs.ingest(lake, name, path, *_range_of(name))
            report.append((name, sum(written.values()), written.dropped, *(written.reasons[r] for r in reasons)))
    counts = "".join(f", {r} long" for r in reasons)
    return spark.createDataFrame(report, f"source string, kept long, dropped long{counts}")


def quarantined_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The raw lines of all attributes that no month takes."""
    dirty = partial(dirty_lines, line_breaks=False)
    with _landed(spark, sf, [ATTRIBUTES.name], BRONZE, dirty=dirty) as (lake, paths):
        jobs.ingest(lake, ATTRIBUTES.name, paths[ATTRIBUTES.name], *SNAPSHOT_RANGE)
    return lake.read_quarantine(ATTRIBUTES.name).groupBy("reason", "line").agg(F.count(F.lit(1)).alias("n"))


def bronze_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze attributes from files whose values hold quoted line breaks."""
    dirty = partial(dirty_lines, line_breaks=True)
    with _landed(spark, sf, [ATTRIBUTES.name], QUARANTINE, dirty=dirty) as (lake, paths):
        jobs.ingest(lake, ATTRIBUTES.name, paths[ATTRIBUTES.name], line_breaks=True)
    return lake.read(BRONZE, ATTRIBUTES.name, ATTRIBUTES.bronze_schema)


def silver_month(spark: SparkSession, sf: str) -> DataFrame:
    """One month of a stored silver table, after that month alone was run a second time."""
    with _landed(spark, sf, [CLICKSTREAM.name], BRONZE) as (lake, paths):
        for bounds in (SNAPSHOT_RANGE, (STORED_MONTH, STORED_MONTH)):
            jobs.ingest(lake, CLICKSTREAM.name, paths[CLICKSTREAM.name], *bounds)
            jobs.refine(lake, CLICKSTREAM.name, *bounds)
    return lake.read_month(SILVER, CLICKSTREAM.name, CLICKSTREAM.silver_schema, STORED_MONTH)


def backfill_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Label store after raw to bronze to silver to gold."""
    with _landed(spark, sf, [LOANS.name], BRONZE, SILVER) as (lake, paths):
        jobs.backfill(lake, paths)
    return lake.read(GOLD, LABEL_STORE, LABEL_STORE_SCHEMA)


def label_definitions(spark: SparkSession, sf: str) -> DataFrame:
    """Label store with one definition over all months, and two more published over later months."""
    with _landed(spark, sf, [LOANS.name], BRONZE, SILVER) as (lake, paths):
        report = jobs.backfill(lake, paths)
        last = max(report[f"{SILVER}.{LOANS.name}"])
        jobs.publish_label_definitions(lake, LATER_LABELS_FROM, last, LATER_LABELS)
    return lake.read(GOLD, LABEL_STORE, LABEL_STORE_SCHEMA)


def _thinned(spark: SparkSession, path: str) -> str:
    """Moves landed raw loans to another folder, but for half the rows of one month.

    Lines stay as they are, and only those that hold the month's date are looked into: that is a fraction of
    what it costs to make all rows again.
    """
    line, header = F.col(LINE), list(LOAN_COLUMNS)
    row = F.from_csv(line, ", ".join(f"{c} string" for c in header), {"escape": '"'})
    gone = (row[V.SNAPSHOT] == THINNED_MONTH) & (row["loan_id"].cast("long") % 2 == 0)
    gone = F.when(line.contains(THINNED_MONTH), gone).otherwise(False)
    thinned = f"{path}_thinned"
    append_lines(read_lines(spark, path).where(~F.coalesce(gone, F.lit(False))), ",".join(header), thinned)
    remove_folder(spark, path)
    return thinned


def catch_up_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Label store after three runs over raw loans that lose rows of one month before the last, with the
    run that wrote each month."""
    with _landed(spark, sf, [LOANS.name], BRONZE, SILVER) as (lake, paths):
        months = jobs.raw_range(lake, paths)
        runs = [jobs.catch_up(lake, paths, *months) for _ in range(2)]
        thinned = _thinned(spark, paths[LOANS.name])
        runs.append(jobs.catch_up(lake, {LOANS.name: thinned}, *months))
    wrote = [(run, m) for run, report in enumerate(runs, 1) for name, w in report.items() if name.startswith(GOLD) for m in w]
    by_month = spark.createDataFrame(wrote, f"run int, {V.SNAPSHOT} date").groupBy(V.SNAPSHOT).agg(F.max("run").alias("run"))
    return lake.read(GOLD, LABEL_STORE, LABEL_STORE_SCHEMA).join(F.broadcast(by_month), V.SNAPSHOT)  # a row per month


def backfill_features(spark: SparkSession, sf: str) -> DataFrame:
    """Feature store after raw to bronze to silver to gold."""
    names = [ATTRIBUTES.name, CLICKSTREAM.name, FINANCIALS.name]
    with _landed(spark, sf, names, BRONZE, SILVER) as (lake, paths):
        jobs.backfill(lake, paths)
    return lake.read(GOLD, FEATURE_STORE, FEATURE_STORE_SCHEMA)


def backfill_features_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Feature store from silver tables bucketed by customer."""
    names = [ATTRIBUTES.name, CLICKSTREAM.name, FINANCIALS.name]
    with _landed(spark, sf, names, BRONZE, SILVER, buckets=8) as (lake, paths):
        jobs.backfill(lake, paths)
    return lake.read(GOLD, FEATURE_STORE, FEATURE_STORE_SCHEMA)


def _silver(name: str) -> Query:
    return lambda spark, sf: refine.REFINERS[name](RAW[name](spark, sf))


QUERIES: dict[str, Query] = {
    "snapshot_slice": snapshot_slice,
    "month_spine": month_spine,
    "spine_slice": spine_slice,
    "strip_underscore": strip_underscore,
    "enforce_schema": _enforce(CLICKSTREAM.name),
    "enforce_schema_attributes": _enforce(ATTRIBUTES.name),
    "enforce_schema_financials": _enforce(FINANCIALS.name),
    "enforce_schema_loans": _enforce(LOANS.name),
    "sentinel_to_null": sentinel_to_null,
    "sentinel_pattern_to_null": sentinel_pattern_to_null,
    "sentinel_to_null_financials": sentinel_to_null_financials,
    "range_to_null": range_to_null,
    "range_to_null_age": range_to_null_age,
    "negative_to_null": negative_to_null,
    "whitelist_to_null": whitelist_to_null,
    "pattern_flag_mask": pattern_flag_mask,
    "zero_fill": zero_fill,
    "age_group": age_group,
    "occupation_category": occupation_category,
    "row_activity": row_activity,
    "history_months": _financial("Credit_History_Age", "Credit_history_total_months"),
    "debt_to_income": _financial("Annual_Income", "Outstanding_Debt", "Debt_to_income_ratio"),
    "risk_level": _financial("Credit_Utilization_Ratio", "credit_risk_level"),
    "days_past_due": days_past_due,
    "feature_join": feature_join,
    "feature_join_hot_keys": feature_join_hot_keys,
    "feature_completeness": feature_completeness,
    "health_score": health_score,
    "loan_labels": loan_labels,
    "cohort_filter": cohort_filter,
    "bad_rate_by_mob": bad_rate_by_mob,
    "value_counts": value_counts,
    "value_counts_entities": value_counts_entities,
    "value_counts_top": value_counts_top,
    "distinct_values": distinct_values,
    "distinct_values_head": distinct_values_head,
    "distinct_count": distinct_count,
    "distinct_count_occupations": distinct_count_occupations,
    "null_counts": null_counts,
    "missing_counts": missing_counts,
    "missing_counts_documents": missing_counts_documents,
    "min_max": min_max,
    "describe_numeric": describe_numeric,
    "numeric_check": numeric_check,
    "non_numeric_values": non_numeric_values,
    "row_count": row_count,
    "duplicate_keys": duplicate_keys,
    "silver_attributes": _silver(ATTRIBUTES.name),
    "silver_clickstream": _silver(CLICKSTREAM.name),
    "silver_financials": _silver(FINANCIALS.name),
    "silver_loan": silver_loan,
    "gold_features": gold_features,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_attributes": bronze_attributes,
    "ingest_report": ingest_report,
    "quarantined_lines": quarantined_lines,
    "bronze_line_breaks": bronze_line_breaks,
    "silver_month": silver_month,
    "backfill_labels": backfill_labels,
    "label_definitions": label_definitions,
    "catch_up_labels": catch_up_labels,
    "backfill_features": backfill_features,
    "backfill_features_bucketed": backfill_features_bucketed,
}
