"""The sliced join must give the plain join's rows, whatever is heavy."""

import random

import pytest
from pyspark.sql import functions as F

from snapmill.operators import features, joins
from snapmill.operators.joins import HeavyKeys, find_heavy_keys, left_joins
from tests.helpers import in_order, plan_of

KEYS = ("k", "d")


def side(spark, name, hot, n=300, null_share=0.0, seed=1):
    """Rows where a third sits on the ``hot`` key, with exact copies among them."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        key = hot if i % 3 == 0 and hot else f"c{pick.randint(0, 60)}"
        rows.append((None if pick.random() < null_share else key, f"2024-0{pick.randint(1, 2)}-01", i // 4))
    if hot:
        rows = [(k, "2024-01-01" if k == hot else d, v) for k, d, v in rows]
    df = spark.createDataFrame(rows, f"k string, d string, {name} int")
    return df.withColumn("d", F.col("d").cast("date"))


@pytest.mark.parametrize("left_hot", [None, "hotL", "c7"])
@pytest.mark.parametrize("right_hot", [None, "hotR", "c7"])
def test_sliced_equals_plain(spark, left_hot, right_hot):
    left = side(spark, "a", left_hot, n=240, null_share=0.2, seed=3)
    right = side(spark, "b", right_hot, n=200, null_share=0.1, seed=4)
    heavy = find_heavy_keys({"l": left, "r": right}, KEYS, heavy_rows=5)
    got = left_joins(left, [right], KEYS, heavy)
    assert in_order(got) == in_order(left.join(right, list(KEYS), "left"))


def test_heavy_key_absent_on_the_other_side(spark):
    left, right = side(spark, "a", "only_left"), side(spark, "b", "only_right", seed=2)
    heavy = find_heavy_keys({"l": left, "r": right}, KEYS, heavy_rows=5)
    assert any("only_left" in k and n[0] and not n[1] for k, n in heavy.rows.items())
    assert any("only_right" in k and n[1] and not n[0] for k, n in heavy.rows.items())
    got = left_joins(left, [right], KEYS, heavy)
    assert in_order(got) == in_order(left.join(right, list(KEYS), "left"))


def test_heavy_keys_are_counted(spark):
    df = side(spark, "a", "hot", n=3000, null_share=0.1)
    truth = {(r.k, r.d): r["count"] for r in df.groupBy("k", "d").count().collect() if r.k}
    found = find_heavy_keys({"x": df}, KEYS, heavy_rows=200)
    assert dict(found.rows) == {k: (n,) for k, n in truth.items() if n > 200}
    assert found.null_rows == (df.where("k IS NULL").count() > 200)
    assert found.slices(next(iter(found.rows)))[0] > 1


def test_key_heavy_only_in_the_product(spark):
    """Few rows of a key on each side, many combinations of them."""
    sides = [spark.createDataFrame([("k", i) for i in range(30)] + [("x", 1)], f"k string, {c} int") for c in "abc"]
    names = dict(zip("abc", sides))
    heavy = find_heavy_keys(names, ["k"], heavy_rows=40)
    assert dict(heavy.rows) == {("k",): (30, 30, 30)}
    slices = heavy.slices(("k",))
    assert (30 / slices[0]) * (30 / slices[1]) * (30 / slices[2]) <= 25 * 40
    got = left_joins(sides[0], sides[1:], ["k"], heavy)
    plain = left_joins(sides[0], sides[1:], ["k"])
    assert in_order(got) == in_order(plain)
    assert min(slices) > 1


def test_light_inputs_stay_plain(spark):
    df = side(spark, "a", None)
    heavy = find_heavy_keys({"x": df, "y": df}, KEYS)
    assert not heavy.rows and not heavy.null_rows
    assert "Generate" not in plan_of(left_joins(df, [side(spark, "b", None)], KEYS, heavy))


def test_slices_bound_rows_and_combinations():
    keys = {("a",): (1000, 1, 0), ("b",): (50, 50, 50), ("c",): (10**9, 3, 2)}
    heavy = HeavyKeys(keys, False, 100)
    for key, counts in keys.items():
        sizes = [-(-max(1, n) // s) for n, s in zip(counts, heavy.slices(key))]
        assert max(sizes) <= 100 and sizes[0] * sizes[1] * sizes[2] <= 25 * 100
    assert heavy.slices(("a",)) == (10, 1, 1)


def test_many_rows_without_a_key_are_spread(spark):
    left, right = side(spark, "a", None, null_share=0.5), side(spark, "b", None, null_share=0.5, seed=2)
    heavy = find_heavy_keys({"l": left, "r": right}, KEYS, heavy_rows=50)
    assert heavy.null_rows
    got = left_joins(left, [right], KEYS, heavy)
    assert in_order(got) == in_order(left.join(right, list(KEYS), "left"))


def _parts(spark, hot):
    people = spark.createDataFrame(
        [("hotL" if hot and i % 3 == 0 else f"c{i % 40}", i % 2, f"p{i}") for i in range(60)],
        "Customer_ID string, m int, Age string",
    )
    clicks = spark.createDataFrame(
        [("c3" if hot and i % 3 else f"c{i % 50}", i % 2, i) for i in range(120)],
        "Customer_ID string, m int, total_activity int",
    )
    money = spark.createDataFrame(
        [("c3" if hot and i % 9 == 0 else f"c{i % 45}", i % 2, float(i)) for i in range(90)],
        "Customer_ID string, m int, Annual_Income double",
    )
    month = F.make_date(F.lit(2024), F.col("m") + 1, F.lit(1))
    return {
        n: df.withColumn("snapshot_date", month).drop("m")
        for n, df in {"attributes": people, "clickstream": clicks, "financials": money}.items()
    }


def test_key_heavy_on_all_three_sides(spark):
    parts = _parts(spark, True)
    one_key = {n: df.withColumn("Customer_ID", F.lit("c3")).limit(25) for n, df in parts.items()}
    heavy = find_heavy_keys(one_key, heavy_rows=4)
    assert all(min(n) > 4 for n in heavy.rows.values()) and heavy.rows
    sliced = features.join_features(*one_key.values(), heavy=heavy)
    assert in_order(sliced) == in_order(features.join_features(*one_key.values()))


@pytest.mark.parametrize("hot", [False, True])
def test_feature_join_with_heavy_keys(spark, hot):
    parts = _parts(spark, hot)
    heavy = find_heavy_keys(parts, heavy_rows=4)
    plain = features.join_features(*parts.values())
    sliced = features.join_features(*parts.values(), heavy=heavy)
    assert sliced.columns == plain.columns
    assert in_order(sliced) == in_order(plain)


def test_two_joins_take_three_exchanges(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features.join_features(*_parts(spark, False).values())._jdf.queryExecution().sparkPlan()
        executed = features.join_features(*_parts(spark, False).values())._jdf.queryExecution().executedPlan()
        assert plan.toString().count("SortMergeJoin") == 2
        assert executed.toString().count("Exchange hashpartitioning") == 3
        hot = _parts(spark, True)
        heavy = find_heavy_keys(hot, heavy_rows=4)
        assert heavy.rows
        executed = features.join_features(*hot.values(), heavy=heavy)._jdf.queryExecution().executedPlan().toString()
        assert executed.count("Exchange hashpartitioning") == 3 and "Union" not in executed
        assert executed.count("SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_thinly_spread_heavy_product_is_found(spark):
    """Few rows of a key among very many others, in every input: found by its combinations."""
    sides = {
        c: spark.range(30_000).select(F.when(F.col("id") < 30, F.lit(-1)).otherwise(F.col("id") + 1_000_000 * i).alias("k"), F.col("id").alias(c))
        for i, c in enumerate("abc")
    }
    heavy = find_heavy_keys(sides, ["k"], heavy_rows=40)
    assert dict(heavy.rows) == {(-1,): (30, 30, 30)} and min(heavy.slices((-1,))) > 1
    got = left_joins(sides["a"], [sides["b"], sides["c"]], ["k"], heavy)
    assert got.count() == 30**3 + 30_000 - 30
    assert got.where("k = -1").distinct().count() == 30**3


def test_more_heavy_keys_than_are_broadcast(spark, monkeypatch):
    left, right = side(spark, "a", "hot", null_share=0.1), side(spark, "b", "c7", seed=5)
    inputs = {"l": left, "r": right}
    few = find_heavy_keys(inputs, KEYS, heavy_rows=4)
    monkeypatch.setattr(joins, "MAX_HEAVY", 3)
    many = find_heavy_keys(inputs, KEYS, heavy_rows=4)
    assert many.table is not None and not many.rows and many.null_rows == few.null_rows
    assert {tuple(r)[:2]: tuple(r)[2:] for r in many.table.collect()} == dict(few.rows) and len(few.rows) > 3
    cells = {tuple(r)[:2]: tuple(r)[2:] for r in joins._cells(left, list(KEYS), many, 2).collect()}
    assert cells == {k: few.slices(k) for k in few.rows}
    got = left_joins(left, [right], KEYS, many)
    assert in_order(got) == in_order(left.join(right, list(KEYS), "left"))


def test_slices_as_columns(spark):
    counts = [(1000, 1, 0), (50, 50, 50), (10**9, 3, 2), (1, 1, 1), (10**12, 10**12, 10**12), (101, 100, 99), (0, 7, 2501)]
    for task_rows in (1, 7, 100, 2_000_000):
        heavy = HeavyKeys({(i,): n for i, n in enumerate(counts)}, False, task_rows)
        table = spark.createDataFrame([(i, *n) for i, n in enumerate(counts)], "k int, rows_0 long, rows_1 long, rows_2 long")
        got = {r[0]: tuple(r)[1:] for r in table.select("k", *joins._slices(3, task_rows)).collect()}
        assert got == {i: heavy.slices((i,)) for i in range(len(counts))}


def test_the_count_moves_hashes_only(spark, tmp_path):
    """One shuffle, of hashes and counts summed up before it."""
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("concat(id % 10, '') AS k", "current_date() AS d", "repeat('x', 100) AS wide").write.parquet(path)
    table = spark.read.parquet(path)
    thin = joins._tagged({"x": table, "y": table}, KEYS).groupBy("hash").agg(*joins._per_input(2))
    plan = thin._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan and "wide" not in plan
