from datetime import date

from pyspark.sql import functions as F

from snapmill.functions.calendar import month_list, next_month
from snapmill.operators import slicing
from tests.helpers import column


def test_spine_covers_the_range(spark):
    spine = column(slicing.month_spine(spark, "2023-01-01", "2025-01-01"), "snapshot_date")
    assert len(spine) == 25 and spine[0] == date(2023, 1, 1) and spine[-1] == date(2025, 1, 1)
    assert spine == month_list("2023-01-01", "2025-01-01")


def test_spine_starts_at_the_first_of_the_month(spark):
    spine = column(slicing.month_spine(spark, "2023-01-15", "2023-02-01"), "snapshot_date")
    assert spine == [date(2023, 1, 1), date(2023, 2, 1)] == month_list("2023-01-15", "2023-02-01")
    assert slicing.month_spine(spark, "2023-02-01", "2023-01-01").count() == 0
    assert month_list("2023-02-01", "2023-01-01") == []


def test_next_month():
    assert next_month("2023-12-31") == date(2024, 1, 1)
    assert next_month("2023-01-01") == date(2023, 2, 1)


def test_spine_slice_equals_a_join_with_the_spine(spark):
    days = spark.createDataFrame(
        [(d,) for d in ("2023-01-01", "2023-01-02", "2023-02-01", "2023-03-01", None)], "d string"
    ).select(F.col("d").cast("date").alias("snapshot_date"))
    spine = slicing.month_spine(spark, "2023-01-20", "2023-02-20")
    joined = days.join(spine, "snapshot_date", "left_semi")
    sliced = slicing.spine_slice(days, "2023-01-20", "2023-02-20")
    assert sorted(column(sliced, "snapshot_date")) == sorted(column(joined, "snapshot_date"))


def test_spine_of_data(spark):
    days = spark.createDataFrame([("2023-01-31",), ("2023-04-02",), (None,)], "d string")
    days = days.select(F.col("d").cast("date").alias("d"))
    assert len(column(slicing.spine_of(days, "d"), "snapshot_date")) == 4
    assert slicing.spine_of(days.where("false"), "d").count() == 0


def test_slice(spark):
    days = spark.createDataFrame([("2023-01-01",), ("2023-02-01",), (None,)], "d string")
    days = days.select(F.col("d").cast("date").alias("snapshot_date"))
    assert column(slicing.snapshot_slice(days, "2023-02-01"), "snapshot_date") == [date(2023, 2, 1)]


def test_month_counts_include_empty_months(spark):
    days = spark.createDataFrame([("2023-01-31",), ("2023-01-02",), ("2023-03-02",), (None,)], "d string")
    days = days.select(F.col("d").cast("date").alias("d"))
    got = [tuple(r) for r in slicing.month_counts(days, "d").collect()]
    assert got == [(date(2023, 1, 1), 2), (date(2023, 2, 1), 0), (date(2023, 3, 1), 1)]
    assert slicing.month_counts(days.where("false"), "d").count() == 0
