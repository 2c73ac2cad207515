"""Labels by several definitions side by side in one store."""

from datetime import date

import pytest

from snapmill.operators.labels import default_labels, labels_by_definition
from snapmill.operators.refine import REFINERS
from snapmill.plans import jobs
from snapmill.schemas import LABEL_STORE_SCHEMA, LOANS
from snapmill.sources.lake import GOLD, LABEL_STORE, SILVER, Lake
from tests.helpers import in_order, raw

JAN, FEB, MAR = (date(2023, m, 1) for m in (1, 2, 3))
ALL = (JAN, MAR)


def loans(spark, *rows):
    """Raw loans from (loan_id, month on book, months missed, snapshot)."""
    return raw(
        spark,
        "loan_daily",
        *[
            {"loan_id": i, "Customer_ID": "c", "installment_num": str(mob), "due_amt": "10", "overdue_amt": str(10 * missed), "snapshot_date": d}
            for i, mob, missed, d in rows
        ],
    )


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = [(f"{m}{i}", i, i % 3, f"2023-0{m}-01") for m in (1, 2, 3) for i in range(8)]
    silver(lake, loans(spark, *rows))
    return lake


def silver(lake, raw_loans, months=ALL):
    df = REFINERS[LOANS.name](raw_loans.withColumn("snapshot_date", raw_loans.snapshot_date.cast("date")))
    lake.write_months(df, SILVER, LOANS.name, *months, gather=False)


def stored(lake):
    return lake.read(GOLD, LABEL_STORE, LABEL_STORE_SCHEMA)


def counts(lake):
    return {(r.label_def, r.snapshot_date): r["count"] for r in stored(lake).groupBy("label_def", "snapshot_date").count().collect()}


def test_a_second_definition_leaves_the_first(lake):
    jobs.publish_labels(lake, *ALL, dpd=30, mob=6)
    first = in_order(stored(lake))
    written = jobs.publish_labels(lake, FEB, MAR, dpd=60, mob=3)
    assert written == {FEB: 1, MAR: 1}
    assert in_order(stored(lake).where("label_def = '30dpd_6mob'")) == first
    assert counts(lake) == {("30dpd_6mob", m): 1 for m in (JAN, FEB, MAR)} | {("60dpd_3mob", m): 1 for m in (FEB, MAR)}


def test_publishing_again_replaces_only_its_definition_and_months(spark, lake):
    jobs.publish_label_definitions(lake, *ALL, [(30, 6), (60, 3)])
    silver(lake, loans(spark, ("n", 6, 9, "2023-02-01"), ("o", 6, 0, "2023-02-01")), (FEB, FEB))
    assert jobs.publish_labels(lake, FEB, FEB, dpd=30, mob=6) == {FEB: 2}
    assert counts(lake) == {
        **{("30dpd_6mob", m): n for m, n in ((JAN, 1), (FEB, 2), (MAR, 1))},
        **{("60dpd_3mob", m): 1 for m in (JAN, FEB, MAR)},
    }
    found = {r.loan_id: r.label for r in stored(lake).where("label_def = '30dpd_6mob' AND snapshot_date = DATE '2023-02-01'").collect()}
    assert found == {"n": 1, "o": 0}


def test_months_without_rows_are_emptied_for_their_definition_alone(spark, lake):
    jobs.publish_label_definitions(lake, *ALL, [(30, 6), (30, 5)])
    silver(lake, loans(spark, ("n", 5, 0, "2023-02-01")), (FEB, FEB))
    assert jobs.publish_labels(lake, *ALL, dpd=30, mob=6) == {JAN: 1, FEB: 0, MAR: 1}
    assert counts(lake) == {("30dpd_6mob", JAN): 1, ("30dpd_6mob", MAR): 1, **{("30dpd_5mob", m): 1 for m in (JAN, FEB, MAR)}}


def test_many_definitions_take_one_scan_and_equal_single_ones(spark, lake):
    definitions = [(30, 6), (60, 6), (1, 2), (30, 99), (30, 6)]
    table = lake.read(SILVER, LOANS.name, LOANS.silver_schema)
    together = labels_by_definition(table, definitions)
    single = [in_order(default_labels(table, *d)) for d in dict.fromkeys(definitions)]
    assert in_order(together.distinct()) == sorted(sum(single, []))
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "mob" in plan.split("PushedFilters")[1]
    written = jobs.publish_label_definitions(lake, *ALL, definitions)
    assert {d: sum(w.values()) for d, w in written.items()} == {"30dpd_6mob": 3, "60dpd_6mob": 3, "1dpd_2mob": 3, "30dpd_99mob": 0}


def test_no_definition_is_refused(lake):
    with pytest.raises(ValueError, match="definition"):
        jobs.publish_label_definitions(lake, *ALL, [])


def test_one_definition_is_read_alone(lake):
    jobs.publish_label_definitions(lake, *ALL, [(30, 6), (60, 3)])
    plan = stored(lake).where("label_def = '60dpd_3mob'")._jdf.queryExecution().executedPlan().toString()
    assert "label_def" in plan.split("PartitionFilters")[1].split("]")[0]
