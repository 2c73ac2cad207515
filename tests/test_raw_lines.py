"""Lines of raw files that are no rows: found, counted by reason, quarantined, never changed."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmill.plans import jobs
from snapmill.schemas import ATTRIBUTES
from snapmill.sources.lake import BRONZE, QUARANTINE, Lake
from snapmill.sources.raw import FAULT, FAULTS, FILE, LINE, append_lines, parse_raw, read_lines, read_raw
from tests.helpers import column, in_order

HEADER = "Customer_ID,Name,Age,SSN,Occupation,snapshot_date"
JAN = date(2023, 1, 1)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def file(tmp_path, *lines, header=HEADER, name="raw.csv"):
    path = tmp_path / name
    path.write_bytes("\n".join([header, *lines, ""]).encode())
    return str(path)


def faults(spark, path, **options):
    return {r.Customer_ID: r[FAULT] for r in parse_raw(spark, ATTRIBUTES, path, **options).collect()}


LINES = {
    "good": 'good,"Lee, ""Bo""",30,1,Doctor,2023-01-01',
    "quotes": 'quotes,a"b,30,1,"x""y",2023-01-01',
    "few": "few,B,30",
    "many": "many,B,30,1,Doctor,2023-01-01,EXTRA",
    "empties": "empties,,,,,",
    "commas": 'commas,"a,b","c,d",1,Doctor',
    "mixed": 'mixed,"a,b",30,1,"x, ""y""",2023-01-01,"z,z"',
    "open": 'open,"B,30,1,Doctor,2023-01-01',
    "last": 'last,B,30,1,Doctor,"2023-01-01',
}
REASONS = {
    "good": None, "quotes": "open_quote", "few": "too_few_fields", "many": "too_many_fields", "empties": None,
    "commas": "too_few_fields", "mixed": "too_many_fields", "open": "open_quote", "last": "open_quote",
}


def test_faults_of_single_lines(spark, tmp_path):
    assert faults(spark, file(tmp_path, *LINES.values())) == REASONS
    rows = parse_raw(spark, ATTRIBUTES, file(tmp_path, *LINES.values()))
    assert {r.Customer_ID: r[LINE] for r in rows.collect()} == LINES
    assert sorted(column(read_raw(spark, ATTRIBUTES, file(tmp_path, *LINES.values())), "Customer_ID")) == ["empties", "good"]


def test_long_fields_and_many_quotes(spark, tmp_path):
    long = '"' + '""'.join(["x" * 50] * 4000) + '"'
    path = file(tmp_path, f"a,{long},30,1,D,2023-01-01", f"b,{long},30")
    assert faults(spark, path) == {"a": None, "b": "too_few_fields"}


def test_quoted_line_breaks(spark, tmp_path):
    path = file(tmp_path, 'a,"one\ntwo",30,1,Doctor,2023-01-01', "b,B,30,1,Doctor,2023-01-01", 'c,"x\ny\n,z"')
    pieces = parse_raw(spark, ATTRIBUTES, path).where(F.col(FAULT).isNotNull()).select(LINE, FAULT).collect()
    assert sorted(map(tuple, pieces)) == [
        (',z"', "open_quote"), ('a,"one', "open_quote"), ('c,"x', "open_quote"), ('two",30,1,Doctor,2023-01-01', "open_quote"), ("y", "too_few_fields"),
    ]
    assert faults(spark, path, line_breaks=True) == {"a": None, "b": None, "c": "open_quote"}
    assert column(read_raw(spark, ATTRIBUTES, path, line_breaks=True).where("Customer_ID = 'a'"), "Name") == ["one\ntwo"]


def test_an_open_quote_that_takes_lines_along(spark, tmp_path):
    """Read with line breaks, a quote that is never closed swallows rows; the whole is at fault, with its text."""
    header = "Customer_ID,Age,SSN,Occupation,snapshot_date,Name"
    swallowed = 'b,30,1,Doctor,2023-01-01,"Bo\nc,30,1,Doctor,2023-01-01,C\nd,30,1,Doctor,2023-01-01,D'
    path = file(tmp_path, "a,30,1,Doctor,2023-01-01,A", swallowed, header=header)
    (bad,) = parse_raw(spark, ATTRIBUTES, path, line_breaks=True).where(F.col(FAULT).isNotNull()).collect()
    assert bad[FAULT] == "open_quote" and "c,30,1,Doctor,2023-01-01,C" in bad[LINE] and "D" in bad[LINE]
    assert faults(spark, path) == {"a": None, "b": "open_quote", "c": None, "d": None}


def test_windows_line_ends_and_empty_lines(spark, tmp_path):
    path = file(tmp_path, "a,B,30,1,Doctor,2023-01-01\r", "\r", "", "b,B,30\r", header=HEADER + "\r")
    for line_breaks in (False, True):
        found = parse_raw(spark, ATTRIBUTES, path, line_breaks).collect()
        assert sorted((r.Customer_ID, r[FAULT]) for r in found) == [("a", None), ("b", "too_few_fields")]
        assert {r.snapshot_date for r in found} == {"2023-01-01", None}


def test_ingest_counts_and_quarantines(spark, lake, tmp_path):
    path = file(
        tmp_path, *LINES.values(), "u,B,30,1,Doctor,soon", "m,B,30,1,Doctor,2023-01-15", "f,B,30,1,Doctor,2024-01-01", "x,B,30,1,Doctor,2024-01-15"
    )
    for gather in (True, False):
        every = (*FAULTS, jobs.UNDATED, jobs.OFF_SPINE)
        written = jobs.ingest(lake, "attributes", path, JAN, JAN, gather=gather, quarantine=every)
        assert written == {JAN: 1} and written.dropped == 12
        assert written.reasons == {
            "open_quote": 3, "too_few_fields": 2, "too_many_fields": 2, "undated": 2, "off_spine": 2, "out_of_range": 1,
        }
        held = lake.read_quarantine("attributes")
        want = [(REASONS[k], LINES[k]) for k in LINES if REASONS[k]]
        want += [("undated", LINES["empties"]), ("undated", "u,B,30,1,Doctor,soon"), ("off_spine", "m,B,30,1,Doctor,2023-01-15"), ("off_spine", "x,B,30,1,Doctor,2024-01-15")]
        assert sorted((r.reason, r.line) for r in held.collect()) == sorted(want)
        assert {r.source for r in held.collect()} == {path} and all("raw.csv" in r.file for r in held.collect())
    assert spark.read.parquet(lake.path(BRONZE, "attributes")).columns == ATTRIBUTES.bronze_schema.names
    again = jobs.ingest(lake, "attributes", path, JAN, JAN)  # by default only what is malformed is kept
    assert again.reasons == written.reasons
    assert sorted(column(lake.read_quarantine("attributes"), "reason")) == sorted(r for r in REASONS.values() if r)


def test_quarantine_follows_its_source(spark, lake, tmp_path):
    bad, good = file(tmp_path, "few,B", name="a b%=1.csv"), file(tmp_path, LINES["good"], name="good.csv")
    assert lake.read_quarantine("attributes").count() == 0
    jobs.ingest(lake, "attributes", bad, JAN, JAN)
    jobs.ingest(lake, "attributes", good, JAN, JAN)
    assert [(r.source, r.line) for r in lake.read_quarantine("attributes").collect()] == [(bad, "few,B")]
    file(tmp_path, LINES["good"], name="a b%=1.csv")
    jobs.ingest(lake, "attributes", bad, JAN, JAN)
    assert lake.read_quarantine("attributes").count() == 0


def test_only_clean_files_are_scanned_once(spark, lake, tmp_path, monkeypatch):
    calls = []
    write = Lake.write_quarantine
    monkeypatch.setattr(Lake, "write_quarantine", lambda self, lines, *a: (calls.append(lines is not None), write(self, lines, *a)))
    jobs.ingest(lake, "attributes", file(tmp_path, LINES["good"]), JAN, JAN)
    jobs.ingest(lake, "attributes", file(tmp_path, LINES["good"], LINES["empties"], "f,B,30,1,Doctor,2024-01-01"), JAN, JAN)
    jobs.ingest(lake, "attributes", file(tmp_path, LINES["few"]), JAN, JAN)
    assert calls == [False, False, True]


def test_line_breaks_through_the_jobs(spark, lake, tmp_path):
    path = {"attributes": file(tmp_path, 'a,"one\ntwo",30,1,Doctor,2023-01-01', "b,B,30")}
    assert jobs.raw_range(lake, path) is None and jobs.raw_range(lake, path, line_breaks=True) == (JAN, JAN)
    report = jobs.backfill(lake, path, JAN, JAN, line_breaks=True)
    assert report["bronze.attributes"] == {JAN: 1} == report["silver.attributes"]
    assert report["bronze.attributes"].reasons["too_few_fields"] == 1
    assert in_order(lake.read_quarantine("attributes").select("line")) == ["('b,B,30',)"]
    assert lake.path(QUARANTINE, "attributes").endswith("quarantine/attributes")


def test_lines_are_appended_as_they_are(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = ['a,"open', '  spaced "" ', "back\\slash\\"]
    append_lines(spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1), HEADER, path)
    assert sorted(r[LINE] for r in parse_raw(spark, ATTRIBUTES, path).collect()) == sorted(lines)


def test_conditions_do_not_parse_again(spark, tmp_path):
    lines = parse_raw(spark, ATTRIBUTES, file(tmp_path, *LINES.values()))
    kept = lines.where(F.col(FAULT).isin(*FAULTS) | F.col("Age").isNull())
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1


def test_suspects_are_all_lines_at_fault(spark, tmp_path):
    path = file(tmp_path, *LINES.values(), "plain,B,30,1,Doctor,2023-01-01", " ", ",,,,,", ",,,,,,")
    every, some = (parse_raw(spark, ATTRIBUTES, path, suspects=s).select(LINE, FAULT) for s in (False, True))
    at_fault = F.col(FAULT).isNotNull()
    assert in_order(some.where(at_fault)) == in_order(every.where(at_fault))
    assert {LINES["empties"], "plain,B,30,1,Doctor,2023-01-01"}.isdisjoint(column(some, LINE))


PIECES = [
    *[","] * 8, "a", "b c", " ", "\t", "\x00", "\x01", "\x0b", "\x1c", "\x7f", "\u0085", "\u2028", "\ufeff", "\\", "'", "#", "é",
    "日本", "😀", "x" * 50, "2023-01-01", '"', '""', '"a,b"', "|", ";",
]


def test_lines_are_read_as_the_parser_reads_them(spark, tmp_path):
    """Lines without a quote are split, not parsed; that must not show."""
    pick, columns = random.Random(3), HEADER.split(",")
    some = ["".join(pick.choices(PIECES, k=pick.randint(1, 16))) for _ in range(5000)]
    plain = [p for p in PIECES if p != "," and '"' not in p]
    some += [",".join("".join(pick.choices(plain, k=pick.randint(0, 3))) for _ in columns) for _ in range(2000)]
    lines = parse_raw(spark, ATTRIBUTES, file(tmp_path, *some))
    schema = ", ".join(f"{c} string" for c in [*columns, "bad"])
    parsed = F.from_csv(LINE, schema, {"escape": '"', "columnNameOfCorruptRecord": "bad"})
    both = lines.select("*", parsed.alias("p"), (F.length(F.regexp_replace(LINE, '[^"]', "")) % 2 == 1).alias("odd")).collect()
    assert len(both) > 6000 and {r[FAULT] for r in both} == {None, *FAULTS}
    for r in both:
        assert [r[c] for c in columns] == [r.p[c] for c in columns], r[LINE]
        assert (r[FAULT] == "open_quote") == r.odd and (r[FAULT] is None) == (not r.odd and r.p.bad is None), r[LINE]


def test_only_lines_with_quotes_need_the_parser(spark, tmp_path):
    """It holds 20,480 fields at most and then fails the job; commas alone are no matter for it."""
    path = file(tmp_path, "few,B", "many" + "," * 30_000, "good,B,30,1,Doctor,2023-01-01")
    assert faults(spark, path) == {"few": "too_few_fields", "many": "too_many_fields", "good": None}


def test_files_are_named_only_if_asked_for(spark, tmp_path):
    path = file(tmp_path, *LINES.values())
    for line_breaks in (False, True):
        with_files, without = (parse_raw(spark, ATTRIBUTES, path, line_breaks, files=f) for f in (True, False))
        assert in_order(with_files.drop(FILE)) == in_order(without)
        assert all(r[FILE].endswith("raw.csv") for r in with_files.collect())
        rows = read_raw(spark, ATTRIBUTES, path, line_breaks)
        assert "file_path" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(column(read_lines(spark, path), LINE)) == sorted(LINES.values())
