"""Backfills that write only the months whose input changed."""

import os
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmill.plans import jobs
from snapmill.schemas import ATTRIBUTES, CLICKSTREAM, FEATURE_STORE_SCHEMA, FINANCIALS, LABEL_STORE_SCHEMA, LOANS, TABLES
from snapmill.sources.lake import FEATURE_STORE, GOLD, LABEL_STORE, SILVER, Lake
from snapmill.sources.raw import FAULT, LINE, append_lines, read_lines, read_raw, write_raw
from snapmill.workload import queries
from tests.helpers import column, in_order, raw

JAN, FEB, MAR = (date(2023, m, 1) for m in (1, 2, 3))
LABELS = f"gold.{LABEL_STORE}/label_def=30dpd_6mob"


def months_of(rows):
    return [{**r, "snapshot_date": f"2023-0{m}-01"} for m in (1, 2) for r in rows]


ROWS = {
    "attributes": months_of([{"Customer_ID": c, "Age": "30"} for c in "abc"]),
    "clickstream": months_of([{"Customer_ID": c, "fe_1": "1"} for c in "abd"]),
    "financials": months_of([{"Customer_ID": c, "Annual_Income": "5"} for c in "ab"]),
    "loan_daily": months_of([{"loan_id": c, "Customer_ID": c, "installment_num": "6", "due_amt": "1"} for c in "xy"]),
}


def land(spark, tmp_path, *names, **changed):
    """Raw files of the named tables, or of all."""
    paths = {}
    for name, rows in {**ROWS, **changed}.items():
        if names and name not in names:
            continue
        paths[name] = str(tmp_path / "raw" / name)
        write_raw(raw(spark, name, *rows), paths[name])
    return paths


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def files(lake):
    """All data files with their time of writing."""
    found = {}
    for folder, _, names in os.walk(lake.root):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.join(folder, name)] = os.stat(os.path.join(folder, name)).st_mtime_ns
    return found


def written(report):
    return {name: dict(w) for name, w in report.items() if w}


def all_tables(lake):
    schemas = {(SILVER, t.name): t.silver_schema for t in TABLES.values()}
    schemas |= {(GOLD, FEATURE_STORE): FEATURE_STORE_SCHEMA, (GOLD, LABEL_STORE): LABEL_STORE_SCHEMA}
    return {k: in_order(lake.read(*k, schema)) for k, schema in schemas.items()}


def test_first_run_is_a_backfill_and_the_second_writes_nothing(spark, lake, tmp_path):
    paths = land(spark, tmp_path)
    first = jobs.catch_up(lake, paths, JAN, MAR)
    plain = Lake(spark, str(tmp_path / "plain"))
    want = jobs.backfill(plain, paths, JAN, MAR)
    assert first[LABELS] == want.pop(f"gold.{LABEL_STORE}")
    assert {k: v for k, v in first.items() if k != LABELS} == want
    assert all_tables(lake) == all_tables(plain)
    before = files(lake)
    again = jobs.catch_up(lake, paths, JAN, MAR)
    assert written(again) == {} and again.keys() == first.keys()
    assert files(lake) == before


def test_without_marks_there_is_nothing_to_compare_with(spark, lake, tmp_path, monkeypatch):
    calls, marks = [], jobs.raw_marks
    monkeypatch.setattr(jobs, "raw_marks", lambda lines, columns, months, *a: (calls.append(list(months)), marks(lines, columns, months, *a))[1])
    clean, stray = land(spark, tmp_path, "attributes"), land(spark, tmp_path, "clickstream")
    append_lines(spark.createDataFrame([("few,B",)], "line string"), ",".join(CLICKSTREAM.columns), stray["clickstream"])
    jobs.catch_up(lake, clean, JAN, MAR)
    assert calls == [[JAN, FEB, MAR]]  # of what was stored
    jobs.catch_up(lake, stray, JAN, MAR)
    assert calls[1:] == [[JAN, FEB, MAR], []]  # and of what may be at fault, for the quarantine
    assert column(lake.read_quarantine("clickstream"), "line") == ["few,B"]
    before = files(lake)
    assert written(jobs.catch_up(lake, {**clean, **stray}, JAN, MAR)) == {} and files(lake) == before
    assert calls[3:] == [[JAN, FEB, MAR]] * 2


def test_raw_loans_lose_rows_of_one_month_only(spark, tmp_path):
    month, other = queries.THINNED_MONTH, "1997-06-01"
    rows = [("2", month), ("3", month), ("4", other), ("5", None), ("6", "1997-05-02"), (None, month)]
    loans = [{"loan_id": i, "Customer_ID": f'"{i}", c', "loan_start_date": month, "snapshot_date": d} for i, d in rows]
    path = str(tmp_path / "raw" / LOANS.name)
    write_raw(raw(spark, LOANS.name, *loans), path)
    landed = sorted(column(read_lines(spark, path), LINE))
    thinned = queries._thinned(spark, path)
    assert sorted(column(read_lines(spark, thinned), LINE)) == [x for x in landed if not x.startswith("2,")]
    assert in_order(read_raw(spark, LOANS, thinned)) == in_order(raw(spark, LOANS.name, *loans[1:]))
    assert not os.path.exists(path)


def test_order_of_rows_and_files_does_not_matter(spark, lake, tmp_path):
    paths = land(spark, tmp_path, "financials")
    jobs.catch_up(lake, paths, JAN, MAR)
    write_raw(raw(spark, "financials", *reversed(ROWS["financials"])).repartition(3), paths["financials"])
    assert written(jobs.catch_up(lake, paths, JAN, MAR)) == {}


def test_one_changed_row_rewrites_its_month_in_all_layers(spark, lake, tmp_path):
    jobs.catch_up(lake, land(spark, tmp_path), JAN, MAR)
    before = files(lake)
    clicks = [dict(r) for r in ROWS["clickstream"]]
    clicks[-1]["fe_1"] = "9"
    paths = land(spark, tmp_path, clickstream=clicks)
    report = written(jobs.catch_up(lake, paths, JAN, MAR))
    assert report == {"bronze.clickstream": {FEB: 3}, "silver.clickstream": {FEB: 3}, f"gold.{FEATURE_STORE}": {FEB: 3}}
    touched = {f for f in {*before, *files(lake)} if before.get(f) != files(lake).get(f)}
    places = {os.path.dirname(os.path.relpath(f, lake.root)) for f in touched}
    tables = ("bronze/clickstream", "silver/clickstream", f"gold/{FEATURE_STORE}")
    assert places == {*(f"{t}/snapshot_date={FEB}" for t in tables), *(f"marks/{t}" for t in tables)}
    plain = Lake(spark, str(tmp_path / "plain"))
    jobs.backfill(plain, paths, JAN, MAR)
    assert all_tables(lake) == all_tables(plain)


@pytest.mark.parametrize(
    "change",
    [
        lambda rows: rows + rows[:1],  # a row twice
        lambda rows: rows[1:],  # a row less
        lambda rows: [{**rows[0], "Age": None, "Name": "30"}, *rows[1:]],  # a value in another column
        lambda rows: [{**rows[0], "Age": "31"}, {**rows[1], "Age": "29"}, *rows[2:]],
    ],
)
def test_every_change_is_seen(spark, lake, tmp_path, change):
    paths = land(spark, tmp_path, "attributes")
    jobs.catch_up(lake, paths, JAN, MAR)
    land(spark, tmp_path, "attributes", attributes=change(ROWS["attributes"]))
    report = jobs.catch_up(lake, paths, JAN, MAR)
    assert [list(w) for w in report.values()] == [[JAN], [JAN]]


def test_a_month_that_went_is_emptied(spark, lake, tmp_path):
    paths = land(spark, tmp_path, LOANS.name)
    jobs.catch_up(lake, paths, JAN, MAR)
    write_raw(raw(spark, LOANS.name, *ROWS[LOANS.name][:2]), paths[LOANS.name])
    report = written(jobs.catch_up(lake, paths, JAN, MAR))
    assert report == {f"bronze.{LOANS.name}": {FEB: 0}, f"silver.{LOANS.name}": {FEB: 0}, LABELS: {FEB: 0}}
    assert lake.read_month(GOLD, LABEL_STORE, LABEL_STORE_SCHEMA, FEB).count() == 0
    assert written(jobs.catch_up(lake, paths, JAN, MAR)) == {}


def test_months_written_by_other_jobs_are_not_trusted(spark, lake, tmp_path):
    paths = land(spark, tmp_path, "attributes")
    jobs.catch_up(lake, paths, JAN, MAR)
    other = str(tmp_path / "other")
    write_raw(raw(spark, "attributes", {"Customer_ID": "z", "snapshot_date": "2023-01-01"}), other)
    jobs.ingest(lake, "attributes", other, JAN, JAN)
    jobs.refine(lake, "attributes", JAN, JAN)
    assert [list(w) for w in jobs.catch_up(lake, paths, JAN, MAR).values()] == [[JAN], [JAN]]
    assert "z" not in column(lake.read(SILVER, "attributes", ATTRIBUTES.silver_schema), "Customer_ID")


def test_a_run_that_broke_off_is_taken_up(spark, lake, tmp_path, monkeypatch):
    paths = land(spark, tmp_path, "attributes", LOANS.name)
    refiners = dict(jobs.REFINERS)
    monkeypatch.setitem(jobs.REFINERS, LOANS.name, lambda df: df.select(F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="(?i)stop|cannot|snapshot"):
        jobs.catch_up(lake, paths, JAN, MAR)
    monkeypatch.setitem(jobs.REFINERS, LOANS.name, refiners[LOANS.name])
    report = written(jobs.catch_up(lake, paths, JAN, MAR))
    assert report.keys() == {f"silver.{LOANS.name}", LABELS}


def test_changed_rules_refine_again(spark, lake, tmp_path, monkeypatch):
    paths = land(spark, tmp_path, "attributes")
    jobs.catch_up(lake, paths, JAN, FEB)
    changed = type(ATTRIBUTES)("attributes", ATTRIBUTES.rules[::-1], ATTRIBUTES.derived)
    monkeypatch.setitem(jobs.TABLES, "attributes", changed)
    assert written(jobs.catch_up(lake, paths, JAN, FEB)).keys() == {"silver.attributes", "bronze.attributes"}


def test_another_definition_leaves_the_rest(spark, lake, tmp_path):
    paths = land(spark, tmp_path, LOANS.name)
    jobs.catch_up(lake, paths, JAN, FEB)
    report = jobs.catch_up(lake, paths, JAN, FEB, definitions=[(30, 6), (1, 6), (60, 6)])
    assert written(report) == {f"gold.{LABEL_STORE}/label_def={d}": {JAN: 2, FEB: 2} for d in ("1dpd_6mob", "60dpd_6mob")}
    assert lake.read(GOLD, LABEL_STORE, LABEL_STORE_SCHEMA).count() == 12


def test_stray_lines_alone_renew_the_quarantine(spark, lake, tmp_path):
    paths = land(spark, tmp_path, "attributes")
    jobs.catch_up(lake, paths, JAN, FEB)
    clean = f"{paths['attributes']}-clean"
    shutil.copytree(paths["attributes"], clean)
    append_lines(spark.createDataFrame([("few,B",)], "line string"), ",".join(ATTRIBUTES.columns), paths["attributes"])
    assert written(jobs.catch_up(lake, paths, JAN, FEB)) == {}
    assert column(lake.read_quarantine("attributes"), "line") == ["few,B"]
    shutil.rmtree(paths["attributes"])
    shutil.copytree(clean, paths["attributes"])
    assert written(jobs.catch_up(lake, paths, JAN, FEB)) == {}
    assert lake.read_quarantine("attributes").count() == 0


def test_bucketed_lakes_catch_up_too(spark, tmp_path):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    try:
        lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
        names = [t.name for t in (ATTRIBUTES, CLICKSTREAM, FINANCIALS)]
        paths = land(spark, tmp_path, *names)
        jobs.catch_up(lake, paths, JAN, MAR)
        land(spark, tmp_path, *names, attributes=ROWS["attributes"][:-1])
        report = written(jobs.catch_up(lake, paths, JAN, MAR))
        assert report == {"bronze.attributes": {FEB: 2}, "silver.attributes": {FEB: 2}, f"gold.{FEATURE_STORE}": {FEB: 2}}
    finally:
        spark.conf.set(key, before)


def test_marks_are_sums_of_hashes(spark):
    rows = raw(spark, "attributes", *[{"Customer_ID": str(i), "Age": "1" * (i % 7) or None, "snapshot_date": f"2023-0{1 + i % 3}-01"} for i in range(300)])
    lines = rows.withColumns({"snapshot_date": F.col("snapshot_date").cast("date"), FAULT: F.lit(None).cast("string"), LINE: F.lit("x")})
    cells = [c for i, name in enumerate([*rows.columns, None]) for c in (F.col(name) if name else F.lit(None).cast("string"), F.lit(i))]
    seen = lines.select("snapshot_date", *[F.xxhash64(F.lit(seed), *cells).alias(f"h{seed}") for seed in (1, 2)]).collect()
    want = {m: [r for r in seen if r.snapshot_date == m] for m in (JAN, FEB)}
    found = jobs.raw_marks(lines, rows.columns, [JAN, FEB])
    assert found.pop(jobs.NO_MONTH) == jobs.NOTHING
    assert found == {m: f"{len(some)}:{sum(r.h1 for r in some)}:{sum(r.h2 for r in some)}" for m, some in want.items()}
