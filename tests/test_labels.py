from pyspark.sql import functions as F

from snapmill.operators import labels
from tests.helpers import column


def loans(spark):
    rows = [
        ("l1", "a", 6, 6, 30, "2023-01-01", "2023-07-01"),
        ("l2", "a", 6, 6, 29, "2023-01-01", "2023-07-01"),
        ("l3", "b", 6, 6, None, "2024-01-01", "2023-07-01"),
        ("l4", "b", 10, 10, 61, "2023-12-31", "2023-07-01"),
        ("l5", "b", 10, 10, 0, None, "2023-07-01"),
    ]
    df = spark.createDataFrame(
        rows,
        "loan_id string, Customer_ID string, mob int, installment_num int, dpd int,"
        "loan_start_date string, snapshot_date string",
    )
    return df.withColumns({c: F.col(c).cast("date") for c in ("loan_start_date", "snapshot_date")})


def test_labels(spark):
    out = labels.default_labels(loans(spark))
    assert out.columns == ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]
    assert sorted((r.loan_id, r.label, r.label_def) for r in out.collect()) == [
        ("l1", 1, "30dpd_6mob"),
        ("l2", 0, "30dpd_6mob"),
        ("l3", 0, "30dpd_6mob"),
    ]


def test_label_parameters(spark):
    out = labels.default_labels(loans(spark), dpd=60, mob=10)
    assert sorted((r.loan_id, r.label, r.label_def) for r in out.collect()) == [
        ("l4", 1, "60dpd_10mob"),
        ("l5", 0, "60dpd_10mob"),
    ]


def test_cohort_is_cut_before_the_date(spark):
    out = labels.closed_cohort(loans(spark))
    assert sorted((r.loan_id, r.dpd_flag) for r in out.collect()) == [("l1", 1), ("l2", 0), ("l4", 1)]


def test_final_installments(spark):
    assert sorted(column(labels.final_installments(loans(spark)), "loan_id")) == ["l4", "l5"]


def test_bad_rate(spark):
    out = labels.bad_rate_by_mob(loans(spark))
    assert [tuple(r) for r in out.collect()] == [(6, 0.5), (10, 1.0)]
