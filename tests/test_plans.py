"""Plans stay the intended ones: pruned, pushed down, one pass, no surplus shuffles."""

import pytest

from snapmill.operators import labels, profile
from snapmill.plans import jobs
from snapmill.schemas import ATTRIBUTES, LOANS
from snapmill.sources.lake import SILVER, Lake
from snapmill.sources.raw import write_raw
from snapmill.workload.queries import per_month
from snapmill.workload.views import dirty_lines
from tests.helpers import plan_of, raw


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    months = [f"2023-0{m}-01" for m in range(1, 6)]
    for t in (LOANS, ATTRIBUTES):
        write_raw(raw(spark, t.name, *[{"Customer_ID": "a", "snapshot_date": m} for m in months]), f"{root}/{t.name}")
    lake = Lake(spark, f"{root}/lake")
    for t in (LOANS, ATTRIBUTES):
        jobs.ingest(lake, t.name, f"{root}/{t.name}", months[0], months[-1])
        jobs.refine(lake, t.name, months[0], months[-1])
    return lake


def test_label_scan_is_pruned_and_filtered(lake):
    plan = plan_of(labels.default_labels(lake.read_month(SILVER, LOANS.name, LOANS.silver_schema, "2023-02-01")))
    assert "PushedFilters: [IsNotNull(mob), EqualTo(mob,6)]" in plan
    assert "ReadSchema: struct<loan_id:string,Customer_ID:string,mob:int,dpd:int>" in plan
    assert "Exchange" not in plan


def test_month_reads_one_directory(lake):
    scan = lake.read_month(SILVER, LOANS.name, LOANS.silver_schema, "2023-02-01")
    node = scan._jdf.queryExecution().executedPlan()
    scan.collect()
    assert "PartitionFilters: [isnotnull(snapshot_date" in node.toString()
    ranged = lake.read_months(SILVER, LOANS.name, LOANS.silver_schema, "2023-02-01", "2023-03-15")
    assert ranged.count() == 2


def test_refining_does_not_shuffle(lake):
    from snapmill.operators.refine import refine_loans

    bronze = lake.read("bronze", LOANS.name, LOANS.bronze_schema)
    assert "Exchange" not in plan_of(refine_loans(bronze))


def test_profiles_are_one_scan(lake):
    people = lake.read(SILVER, ATTRIBUTES.name, ATTRIBUTES.silver_schema)
    for df in (profile.missing_counts(people), profile.null_counts(people), profile.describe_numeric(people, ["Age"])):
        physical = df._jdf.queryExecution().sparkPlan().toString()
        assert physical.count("FileScan") == 1


def test_value_counts_is_a_top_k(lake):
    people = lake.read(SILVER, ATTRIBUTES.name, ATTRIBUTES.silver_schema)
    plan = plan_of(profile.value_counts(people, "Occupation", limit=20))
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan
    assert "ReadSchema: struct<Occupation:string>" in plan


def test_dirty_lines_are_made_of_rows_that_have_any(spark):
    rows = raw(spark, ATTRIBUTES.name, *[{"Customer_ID": str(i), "Name": "a"} for i in (*range(6), 51, 53)], {"Name": "b"})
    lines = dirty_lines(rows, line_breaks=False)
    assert lines.count() == 2 + 1 + 2 + 2  # too many fields, too few, an open quote, a line break, which makes two
    conditions = [x for x in lines._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
    assert any(" IN (1,2,3,4)" in c for c in conditions)


def test_report_counts_in_two_steps(spark):
    rows = raw(spark, ATTRIBUTES.name, *[{"Customer_ID": c, "Age": a, "snapshot_date": m} for c, a, m in (
        ("a", "1", "2023-01-01"), ("a", None, "2023-01-01"), (None, "2", "2023-01-01"), ("b", None, "2023-02-01"), (None, None, "2023-03-01"), ("c", None, None),
    )])
    report = per_month(rows, "attributes")
    found = {r.snapshot_date: (r.source, r.row_count, r.entities, r.cells) for r in report.collect()}
    name = "attributes"
    assert found == {"2023-01-01": (name, 3, 1, 7), "2023-02-01": (name, 1, 1, 2), "2023-03-01": (name, 1, 0, 1), None: (name, 1, 1, 1)}
    assert "distinct" not in plan_of(report)
