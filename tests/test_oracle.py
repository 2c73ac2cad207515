"""Every registered query against its SQL, on whole tables of the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_point
from snapmill.workload.oracle import ORACLE
from snapmill.workload.queries import QUERIES
from tests.compare import connect, mismatch
from tests.helpers import plan_of

SF_DIR = os.environ.get("TEST_SF_DIR", entry_point.SMOKE_DIR)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, engine, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert mismatch(df, engine, entry_point.oracle_sql()[name]) is None
    assert "Python" not in plan_of(df), "rows must stay in the JVM"


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]
    assert df.count() > 0


def test_feature_invariants(spark):
    rows = entry_point.queries()["gold_features"](spark, SF_DIR)
    assert len(rows.columns) == 53
    assert rows.where("feature_completeness NOT IN (0, 0.25, 0.5, 0.75, 1)").count() == 0
    assert rows.where("financial_health_score NOT BETWEEN 1 AND 5").count() == 0
    people = entry_point.queries()["silver_attributes"](spark, SF_DIR)
    assert rows.count() >= people.count()


def test_dpd_is_null_only_without_a_missed_date(spark):
    loans = entry_point.queries()["silver_loan"](spark, SF_DIR)
    assert loans.where("dpd IS NULL AND NOT (overdue_amt > 0 AND first_missed_date IS NULL)").count() == 0
    assert loans.where("dpd IS NULL").count() > 0
