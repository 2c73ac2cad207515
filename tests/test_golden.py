"""Attribute files of several months, from CSV to silver: every rule of FIXTURES.md F1 on invented rows.

The rows are dealt by number, so that the expected counts follow from arithmetic.
"""

import csv
from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmill.operators import profile
from snapmill.plans import jobs
from snapmill.schemas import ATTRIBUTES
from snapmill.sources.lake import SILVER, Lake
from snapmill.sources.raw import read_raw
from tests.helpers import one

MONTHS = [date(2023, m, 1) for m in range(1, 6)]
ROWS = 600
OCCUPATIONS = [
    "Lawyer", "Doctor", "Engineer", "Teacher", "Journalist", "Manager", "Entrepreneur", "Mechanic", "Accountant",
    "Scientist", "Musician", "_______",
]
NAMES = ["Plain Name", 'With "Quote"', "With, Comma", 'Both, "of them"']


def age(i):
    """Of every ten: a trailing underscore, a negative, below 16, above 100, both bounds, the rest in bands."""
    return ["30_", "-500", "15", "101", "16", "100", "24", "25", "40", "3843_"][i % 10]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("attributes")
    for k, month in enumerate(MONTHS):
        with open(folder / f"attributes_{month}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(ATTRIBUTES.columns)
            for i in range(k, ROWS, len(MONTHS)):
                ssn = "#F%$D@*&8" if i % 8 == 3 else f"{100 + i:03}-{i % 100:02}-{1000 + i:04}"
                occupation = OCCUPATIONS[i % len(OCCUPATIONS)]
                out.writerow([f"CUS_{i}", NAMES[i % len(NAMES)], age(i), ssn, occupation, month])
    return f"{folder}/*.csv"


@pytest.fixture(scope="module")
def run(spark, files, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("golden")))
    counts = jobs.ingest(lake, "attributes", files, MONTHS[0], MONTHS[-1])
    jobs.refine(lake, "attributes", MONTHS[0], MONTHS[-1])
    return counts, lake.read(SILVER, "attributes", ATTRIBUTES.silver_schema)


def counted(df, column):
    return {r[column]: r["count"] for r in df.groupBy(column).count().collect()}


def test_rows_per_month(run):
    counts, silver = run
    assert counts == dict.fromkeys(MONTHS, ROWS // 5) and counts.dropped == 0
    assert silver.count() == silver.select("Customer_ID").distinct().count() == ROWS


def test_raw_ages(spark, files):
    raw = read_raw(spark, ATTRIBUTES, files)
    assert one(profile.numeric_check(raw, "Age")) == {"numeric_count": 420, "non_numeric_count": 180}
    odd = raw.where("NOT Age RLIKE '^[0-9]+$'")
    assert (odd.where("Age LIKE '%\\\\_'").count(), odd.where("Age LIKE '-%'").count()) == (120, 60)


def test_clean_ages(run):
    number = F.col("Age").cast("int")
    got = one(run[1].agg(F.count(number).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi"), F.sum(number).alias("s")))
    assert got == {"n": 360, "lo": 16, "hi": 100, "s": 60 * (30 + 16 + 100 + 24 + 25 + 40)}
    # 16 and 24; 30 and 25; 40; 100 and everything without an age
    assert counted(run[1], "age_group") == {"young": 120, "middle_25_40": 120, "mature_40_60": 60, "seniors": 300}


def test_ssn_and_occupation(run):
    silver = run[1]
    assert counted(silver, "SSN_is_valid") == {True: 525, False: 75}
    assert silver.where("Occupation = '_______'").count() == 50
    assert one(profile.distinct_count(silver, "Occupation")) == {"distinct_count": 12}
    assert counted(silver, "occupation_category") == {
        "professional": 150, "education_media": 100, "business": 100, "technical": 100, "other": 150,
    }


def test_names(run):
    quote, comma = F.col("Name").contains('"'), F.col("Name").contains(",")
    got = one(run[1].agg(*[F.count_if(c).alias(n) for n, c in {"q": quote, "c": comma, "b": quote & comma}.items()]))
    assert got == {"q": 300, "c": 300, "b": 150}
