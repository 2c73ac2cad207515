"""Raw files to bronze, silver and gold on disk."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmill.operators.refine import refine_financials
from snapmill.plans import jobs
from snapmill.schemas import ATTRIBUTES, CLICKSTREAM, FEATURE_STORE_SCHEMA, LABEL_STORE_SCHEMA, LOANS, TABLES
from snapmill.sources.lake import BRONZE, FEATURE_STORE, GOLD, LABEL_STORE, SILVER, Lake
from snapmill.sources.raw import read_raw, write_raw
from snapmill.sources.shared import remove_folder, shared_folder
from tests.helpers import column, in_order, raw

RANGE = ("2023-01-01", "2023-03-31")
JAN, FEB, MAR = date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def people(spark, *pairs):
    return raw(spark, "attributes", *[{"Customer_ID": c, "snapshot_date": d} for c, d in pairs])


def land(df, tmp_path, name="raw"):
    path = str(tmp_path / name)
    write_raw(df, path)
    return path


def bronze(lake, table=ATTRIBUTES):
    return lake.read(BRONZE, table.name, table.bronze_schema)


PEOPLE = [("a", "2023-01-01"), ("b", "2023-01-01"), ("c", "2023-03-01")]
OFF_SPINE = [("d", "2023-01-15"), ("e", None), ("f", "2022-12-01"), ("g", "2023-04-01"), ("h", "soon")]


def test_ingest_keeps_the_spine_and_counts_months(spark, lake, tmp_path):
    path = land(people(spark, *PEOPLE, *OFF_SPINE), tmp_path)
    for gather in (True, False):
        written = jobs.ingest(lake, "attributes", path, *RANGE, gather=gather)
        assert (written, written.dropped) == ({JAN: 2, FEB: 0, MAR: 1}, 5)
        assert sorted(column(bronze(lake), "Customer_ID")) == ["a", "b", "c"]


def test_raw_range(spark, lake, tmp_path):
    path = land(people(spark, *PEOPLE, *OFF_SPINE), tmp_path)
    assert jobs.raw_range(lake, {"attributes": path}) == (date(2022, 12, 1), date(2023, 4, 1))
    assert jobs.raw_range(lake, {"attributes": land(people(spark, ("e", None)), tmp_path, "none")}) is None


def test_backfill_reports_drops_and_shuffles_only_to_gather(spark, lake, tmp_path):
    paths = {"attributes": land(people(spark, *PEOPLE, *OFF_SPINE), tmp_path)}
    for gather in (True, False):
        report = jobs.backfill(lake, paths, *RANGE, gather=gather)
        assert report[f"{BRONZE}.attributes"].dropped == 5 and report[f"{SILVER}.attributes"].dropped == 0
    plans = []
    write = Lake.write_months

    def spy(self, df, layer, table, start, end, gather, kept=None):
        plans.append((layer, gather))
        return write(self, df, layer, table, start, end, gather, kept)

    Lake.write_months = spy
    try:
        jobs.backfill(lake, paths, *RANGE, gather=False)
    finally:
        Lake.write_months = write
    assert plans == [(BRONZE, False), (SILVER, False)]


def test_rerun_changes_nothing(spark, lake, tmp_path):
    path = land(people(spark, *PEOPLE), tmp_path)
    runs = []
    for _ in range(2):
        jobs.ingest(lake, "attributes", path, *RANGE)
        jobs.refine(lake, "attributes", *RANGE)
        runs.append(in_order(lake.read(SILVER, "attributes", ATTRIBUTES.silver_schema)))
    assert runs[0] == runs[1] and len(runs[0]) == 3


def test_one_month_leaves_the_others_alone(spark, lake, tmp_path):
    jobs.ingest(lake, "attributes", land(people(spark, *PEOPLE), tmp_path), *RANGE)
    newer = land(people(spark, ("z", "2023-01-01"), ("y", "2023-03-01")), tmp_path, "newer")
    assert jobs.ingest(lake, "attributes", newer, JAN, JAN) == {JAN: 1}
    assert sorted(column(bronze(lake), "Customer_ID")) == ["c", "z"]


def test_month_without_rows_any_more_is_emptied(spark, lake, tmp_path):
    jobs.ingest(lake, "attributes", land(people(spark, *PEOPLE), tmp_path), *RANGE)
    newer = land(people(spark, ("z", "2023-01-01")), tmp_path, "newer")
    assert jobs.ingest(lake, "attributes", newer, *RANGE) == {JAN: 1, FEB: 0, MAR: 0}
    assert column(bronze(lake), "Customer_ID") == ["z"]
    assert lake.read_month(BRONZE, "attributes", ATTRIBUTES.bronze_schema, MAR).count() == 0


def test_header_only_month_has_the_full_schema(spark, lake, tmp_path):
    path = str(tmp_path / "empty.csv")
    with open(path, "w") as f:
        f.write(",".join(CLICKSTREAM.columns) + "\n")
    assert jobs.ingest(lake, "clickstream", path, JAN, JAN) == {JAN: 0}
    assert jobs.refine(lake, "clickstream", JAN, JAN) == {JAN: 0}
    silver = lake.read_month(SILVER, "clickstream", CLICKSTREAM.silver_schema, JAN)
    assert silver.count() == 0 and len(silver.columns) == 25


def test_columns_are_found_by_name(spark, lake, tmp_path):
    shuffled = people(spark, *PEOPLE).select(*reversed(ATTRIBUTES.columns))
    rows = read_raw(spark, ATTRIBUTES, land(shuffled, tmp_path))
    assert rows.columns == ATTRIBUTES.columns
    assert sorted(column(rows, "Customer_ID")) == ["a", "b", "c"]


def test_absent_column_is_refused(spark, tmp_path):
    path = land(people(spark, *PEOPLE).drop("Age"), tmp_path)
    with pytest.raises(ValueError, match="Age"):
        read_raw(spark, ATTRIBUTES, path)


def test_differing_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "mixed"
    os.makedirs(folder)
    names = ATTRIBUTES.columns
    for i, header in enumerate([names, names[::-1]]):
        with open(folder / f"{i}.csv", "w") as f:
            f.write(",".join(header) + "\n" + ",".join("x" * len(header)) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, ATTRIBUTES, str(folder)).collect()


def test_quotes_and_commas_in_names(spark, tmp_path):
    names = ['Ann "Bo" Lee', "Lee, Ann", 'Lee, "Bo"', "back\\slash"]
    df = raw(spark, "attributes", *[{"Name": n} for n in names])
    assert sorted(column(read_raw(spark, ATTRIBUTES, land(df, tmp_path)), "Name")) == sorted(names)


def test_empty_range_is_refused(spark, lake, tmp_path):
    with pytest.raises(ValueError, match="month"):
        jobs.ingest(lake, "attributes", land(people(spark, *PEOPLE), tmp_path), MAR, JAN)


def test_large_month_is_cut_into_pieces(spark, lake):
    """Gathered rows of a month are split by size: one hot month does not end in one task."""
    rows = spark.range(300_000, numPartitions=8).select(
        *[F.sha2(F.concat(F.lit(c), "id"), 256).alias(c) for c in ATTRIBUTES.columns[:-1]],
        F.lit("2023-01-01").cast("date").alias("snapshot_date"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4m")
    try:
        counts = lake.write_months(rows, BRONZE, "attributes", JAN, JAN, gather=True)
    finally:
        spark.conf.set(key, before)
    folder = f"{lake.path(BRONZE, 'attributes')}/snapshot_date={JAN}"
    assert counts == {JAN: 300_000}
    assert sum(f.endswith(".parquet") for f in os.listdir(folder)) > 4


def test_backfill_all_layers(spark, lake, tmp_path):
    snap = {"snapshot_date": "2023-01-01"}
    tables = {
        "attributes": [{"Customer_ID": "a", "Age": "30", **snap}, {"Customer_ID": "b", **snap}],
        "clickstream": [{"Customer_ID": "a", **{f"fe_{i}": "1" for i in range(1, 21)}, **snap}],
        "financials": [
            {"Customer_ID": "a", "Annual_Income": "100", "Outstanding_Debt": "40", **snap},
            {"Customer_ID": "a", "Credit_Utilization_Ratio": "20", **snap},
        ],
        "loan_daily": [
            {"loan_id": "l1", "Customer_ID": "a", "installment_num": "6", "due_amt": "10", "overdue_amt": "10", **snap},
            {"loan_id": "l2", "Customer_ID": "b", "installment_num": "5", **snap},
        ],
    }
    paths = {n: land(raw(spark, n, *rows), tmp_path, n) for n, rows in tables.items()}
    report = jobs.backfill(lake, paths, *RANGE)
    assert set(report) == {
        *(f"{layer}.{n}" for layer in (BRONZE, SILVER) for n in TABLES),
        f"{GOLD}.{FEATURE_STORE}",
        f"{GOLD}.{LABEL_STORE}",
    }
    for name, rows in tables.items():
        assert report[f"{BRONZE}.{name}"][JAN] == report[f"{SILVER}.{name}"][JAN] == len(rows)

    features = lake.read(GOLD, FEATURE_STORE, FEATURE_STORE_SCHEMA)
    got = features.select("Customer_ID", "feature_completeness", "financial_health_score").collect()
    # the repeated financial rows fan out; null ratios score like the worst band
    assert sorted(map(tuple, got)) == [("a", 0.75, 2), ("a", 0.75, 3), ("b", 0.0, 1)]

    labels = lake.read(GOLD, LABEL_STORE, LABEL_STORE_SCHEMA)
    assert [tuple(r) for r in labels.collect()] == [("l1", "a", 1, "30dpd_6mob", JAN)]


def test_stored_schemas_match_the_contract(spark, lake, tmp_path):
    paths = {n: land(raw(spark, n, {"Customer_ID": "a", "snapshot_date": "2023-01-01"}), tmp_path, n) for n in TABLES}
    jobs.backfill(lake, paths, JAN, JAN)
    for layer, name, schema in [
        *((SILVER, n, t.silver_schema) for n, t in TABLES.items()),
        (GOLD, FEATURE_STORE, FEATURE_STORE_SCHEMA),
    ]:
        stored = spark.read.parquet(lake.path(layer, name))
        assert {f.name: f.dataType for f in stored.schema} == {f.name: f.dataType for f in schema}
    assert len(FEATURE_STORE_SCHEMA) == 53


def test_any_session_compiles_wide_stages(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    try:
        refine_financials(raw(spark, "financials", {"Customer_ID": "a"})).collect()
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_folders_are_removed(spark):
    path = shared_folder(spark, "gone")
    spark.range(1).write.parquet(path)
    remove_folder(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_loans_bronze_stays_text(spark, lake, tmp_path):
    path = land(raw(spark, "loan_daily", {"loan_id": "1", "tenure": "x_", "snapshot_date": "2023-01-01"}), tmp_path)
    jobs.ingest(lake, "loan_daily", path, JAN, JAN)
    assert column(bronze(lake, LOANS), "tenure") == ["x_"]


def test_without_a_range_the_table_becomes_what_the_files_hold(spark, lake, tmp_path):
    jobs.ingest(lake, "attributes", land(people(spark, *PEOPLE, *OFF_SPINE), tmp_path), *RANGE)
    path = land(people(spark, ("z", "2023-01-01"), ("y", "2024-05-01"), *OFF_SPINE), tmp_path, "newer")
    written = jobs.ingest(lake, "attributes", path)
    assert written == {JAN: 1, MAR: 0, date(2022, 12, 1): 1, date(2023, 4, 1): 1, date(2024, 5, 1): 1}
    assert written.reasons["out_of_range"] == 0 and written.dropped == 3
    assert sorted(column(bronze(lake), "Customer_ID")) == ["f", "g", "y", "z"]
    assert sum(jobs.refine(lake, "attributes").values()) == 4


def test_backfill_without_a_range(spark, tmp_path):
    rows = [{"loan_id": f"{m}", "Customer_ID": "a", "installment_num": "6", "snapshot_date": f"2023-0{m}-01"} for m in (1, 3)]
    paths = {
        "loan_daily": land(raw(spark, "loan_daily", *rows), tmp_path, "loans"),
        **{n: land(raw(spark, n, {"Customer_ID": "a", "snapshot_date": "2023-03-01"}), tmp_path, n) for n in ("attributes", "clickstream", "financials")},
    }
    open_range, ranged = Lake(spark, str(tmp_path / "open")), Lake(spark, str(tmp_path / "ranged"))
    report, want = jobs.backfill(open_range, paths), jobs.backfill(ranged, paths, *RANGE)
    assert {k: {m: n for m, n in w.items() if n} for k, w in want.items()} == {k: dict(w) for k, w in report.items()}
    for layer, name, schema in ((GOLD, FEATURE_STORE, FEATURE_STORE_SCHEMA), (GOLD, LABEL_STORE, LABEL_STORE_SCHEMA)):
        assert in_order(open_range.read(layer, name, schema)) == in_order(ranged.read(layer, name, schema))


def test_half_a_range_is_refused(spark, lake, tmp_path):
    with pytest.raises(ValueError, match="both"):
        jobs.ingest(lake, "attributes", land(people(spark, *PEOPLE), tmp_path), JAN)
