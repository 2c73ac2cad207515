"""Silver tables bucketed by customer, which the feature join reads without a shuffle."""

import os
from datetime import date

import pytest

from snapmill.operators import features, joins
from snapmill.plans import jobs
from snapmill.schemas import ATTRIBUTES, CLICKSTREAM, FEATURE_STORE_SCHEMA, FINANCIALS
from snapmill.sources.lake import FEATURE_STORE, GOLD, SILVER, Lake
from snapmill.sources.raw import write_raw
from tests.helpers import column, in_order, raw

JAN, FEB, MAR = (date(2023, m, 1) for m in (1, 2, 3))
PARTS = (ATTRIBUTES, CLICKSTREAM, FINANCIALS)


def rows_of(spark, hot=0):
    """Customers over two months, repeated ones among them, some on one side only."""
    month = lambda i: f"2023-0{1 + i % 2}-01"
    who = lambda i, n: "hot" if i < hot else f"c{i % n}"
    return {
        "attributes": raw(spark, "attributes", *[{"Customer_ID": who(i, 40), "Age": str(20 + i % 30), "snapshot_date": month(i)} for i in range(60)]),
        "clickstream": raw(spark, "clickstream", *[{"Customer_ID": who(i, 50), "fe_1": str(i), "snapshot_date": month(i)} for i in range(90)]),
        "financials": raw(spark, "financials", *[{"Customer_ID": who(i, 45), "Annual_Income": str(i), "snapshot_date": month(i)} for i in range(70)]),
    }


def land(spark, tmp_path, hot=0):
    paths = {}
    for name, df in rows_of(spark, hot).items():
        paths[name] = str(tmp_path / f"raw-{hot}" / name)
        write_raw(df, paths[name])
    return paths


@pytest.fixture
def settings(spark):
    keys = ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def lake(spark, tmp_path, settings):
    return Lake(spark, str(tmp_path / "it's a lake"), buckets=4)


def silver(lake, schema=ATTRIBUTES):
    return lake.read(SILVER, schema.name, schema.silver_schema)


def stored_features(lake):
    return in_order(lake.read(GOLD, FEATURE_STORE, FEATURE_STORE_SCHEMA))


@pytest.mark.parametrize("hot", [0, 30])
def test_features_equal_those_of_plain_tables(spark, lake, tmp_path, hot):
    paths = land(spark, tmp_path, hot)
    plain = Lake(spark, str(tmp_path / "plain"))
    report, want = jobs.backfill(lake, paths, JAN, MAR), jobs.backfill(plain, paths, JAN, MAR)
    assert report == want
    for part in PARTS:
        assert in_order(silver(lake, part)) == in_order(silver(plain, part))
    assert stored_features(lake) == stored_features(plain)
    jobs.publish_features(lake, JAN, MAR, heavy_rows=4)
    assert stored_features(lake) == stored_features(plain)


def test_no_exchange_below_the_joins(spark, lake, tmp_path):
    jobs.backfill(lake, land(spark, tmp_path), JAN, MAR)
    parts = [lake.read_months(SILVER, p.name, p.silver_schema, JAN, MAR) for p in PARTS]
    joined = features.join_features(*parts, heavy=joins.find_heavy_keys(dict(zip("abc", parts))))
    joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("SortMergeJoin") == 2 and final.count("Bucketed: true") == 3
    assert "Exchange" not in final and "ShuffleQueryStage" not in final


def test_heavy_keys_are_dealt_out_of_their_bucket(spark, lake, tmp_path, monkeypatch):
    """They are read from files split by size: a hot bucket is no single task."""
    jobs.backfill(lake, land(spark, tmp_path, hot=30), JAN, MAR)
    reads, read = [], Lake.read
    monkeypatch.setattr(Lake, "read", lambda self, layer, table, schema, by_bucket=True: (reads.append((layer, by_bucket)), read(self, layer, table, schema, by_bucket))[1])
    for heavy_rows, by_bucket in ((4, False), (1000, True)):
        reads.clear()
        jobs.publish_features(lake, JAN, MAR, heavy_rows=heavy_rows)
        assert [r for r in reads if r[0] == SILVER] == [(SILVER, False)] * 3 + [(SILVER, by_bucket)] * 3
    plan = lake.read(SILVER, "attributes", ATTRIBUTES.silver_schema, by_bucket=False)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed" not in plan


def test_files_carry_their_bucket(spark, lake, tmp_path):
    jobs.backfill(lake, land(spark, tmp_path), JAN, MAR)
    folder = f"{lake.path(SILVER, 'attributes')}/snapshot_date={JAN}"
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert 0 < len(files) <= 4 and all("_0000" in f for f in files)


def test_one_month_again_and_months_without_rows(spark, lake, tmp_path):
    path = {"attributes": land(spark, tmp_path)["attributes"]}
    jobs.backfill(lake, path, JAN, MAR)
    everything = in_order(silver(lake))
    assert jobs.refine(lake, "attributes", FEB, FEB) == {FEB: 30}
    assert in_order(silver(lake)) == everything
    newer = str(tmp_path / "newer")
    write_raw(raw(spark, "attributes", {"Customer_ID": "z", "snapshot_date": "2023-01-01"}), newer)
    assert jobs.backfill(lake, {"attributes": newer}, JAN, MAR)["silver.attributes"] == {JAN: 1, FEB: 0, MAR: 0}
    assert column(silver(lake), "Customer_ID") == ["z"]
    assert lake.read_month(SILVER, "attributes", ATTRIBUTES.silver_schema, FEB).count() == 0


def test_a_lake_opened_again_knows_its_buckets(spark, lake, tmp_path):
    jobs.backfill(lake, {"attributes": land(spark, tmp_path)["attributes"]}, JAN, MAR)
    everything = in_order(silver(lake))
    for t in spark.catalog.listTables():  # as in a session that never saw the lake
        spark.sql(f"DROP TABLE {t.name}")
    again = Lake(spark, lake.root)
    assert again.buckets == 4 and in_order(silver(again)) == everything
    with pytest.raises(ValueError, match="4 buckets"):
        Lake(spark, lake.root, buckets=8)
    assert Lake(spark, lake.root, buckets=4).buckets == 4


def test_plain_tables_cannot_become_bucketed(spark, tmp_path, settings):
    plain = Lake(spark, str(tmp_path / "plain"))
    jobs.backfill(plain, {"attributes": land(spark, tmp_path)["attributes"]}, JAN, MAR)
    with pytest.raises(ValueError, match="without buckets"):
        Lake(spark, plain.root, buckets=4)
    assert Lake(spark, plain.root).buckets is None
