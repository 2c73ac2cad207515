import pytest

from snapmill.operators import profile
from tests.helpers import column, one


@pytest.fixture(scope="module")
def messy(spark):
    rows = [
        ("x", "41", 1, "2024-01-01"),
        ("x", "41_", 2, None),
        ("y", "-500", None, "2024-01-01"),
        (None, "", 4, "2024-01-01"),
        ("", "__", 4, "2024-01-01"),
        ("___", None, 5, "2024-01-01"),
    ]
    return spark.createDataFrame(rows, "t string, age string, n int, d string").selectExpr(
        "t", "age", "n", "CAST(d AS DATE) AS d"
    )


def test_value_counts(messy):
    rows = [tuple(r) for r in profile.value_counts(messy, "t").collect()]
    assert rows == [("x", 2), (None, 1), ("", 1), ("___", 1), ("y", 1)]
    assert [tuple(r) for r in profile.value_counts(messy, "t", limit=1).collect()] == [("x", 2)]
    many = messy.sparkSession.range(50).selectExpr("id AS v")
    assert profile.value_counts(many, "v").count() == 50


def test_distinct(messy):
    assert set(column(profile.distinct_values(messy, "t"), "t")) == {"x", "y", None, "", "___"}
    assert column(profile.distinct_values(messy, "t", limit=2), "t") == [None, ""]
    assert one(profile.distinct_count(messy, "t")) == {"distinct_count": 5}


def test_null_counts(messy):
    assert one(profile.null_counts(messy)) == {"t": 1, "age": 1, "n": 1, "d": 1}


def test_missing_counts(messy):
    rows = {r["column"]: r["missing"] for r in profile.missing_counts(messy).collect()}
    assert rows == {"t": 3, "age": 3, "n": 1, "d": 1}


def test_ranges(messy):
    assert one(profile.value_ranges(messy, ["n"])) == {"min_n": 1, "max_n": 5}


def test_prefix_selection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "fe_1 int, fe_2 int, other int")
    assert profile.activity_columns(df) == ["fe_1", "fe_2"]


def test_describe(messy):
    age, n = (r.asDict() for r in profile.describe_numeric(messy, ["age", "n"]).collect())
    assert age == {
        "column": "age", "count": 2, "mean": -229.5, "stddev": pytest.approx(382.5448),
        "min": -500.0, "max": 41.0, "unparsed": 3,
    }
    assert (n["count"], n["min"], n["max"], n["unparsed"]) == (5, 1.0, 5.0, 0)


def test_numeric_check(messy):
    assert one(profile.numeric_check(messy, "age")) == {"numeric_count": 1, "non_numeric_count": 4}
    assert set(column(profile.non_numeric_values(messy, "age"), "age")) == {"41_", "-500", "", "__"}


def test_row_count(messy):
    assert one(profile.row_count(messy)) == {"row_count": 6}


def test_duplicate_keys(messy):
    assert one(profile.duplicate_keys(messy, ["t"])) == {
        "repeated_keys": 1, "surplus_rows": 1, "rows_of_largest_key": 2,
    }
    assert one(profile.duplicate_keys(messy.limit(0), ["t"])) == {
        "repeated_keys": 0, "surplus_rows": 0, "rows_of_largest_key": 0,
    }
