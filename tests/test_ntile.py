import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from temblor.operators import ntile, rank_in_group


def _expected(df, k, order, by):
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(
        *[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("exp", F.ntile(k).over(w))


def _check(spark, rows, k, by, rows_per_range):
    df = spark.createDataFrame(rows, "id long, g string, v double")
    order = ["v", "id"]
    got = ntile(df, k, order, by=by, name="t", rows_per_range=rows_per_range)
    exp = _expected(df, k, order, by)
    joined = got.join(exp.select("id", "exp"), "id")
    assert joined.count() == len(rows)
    assert joined.filter(F.col("t") != F.col("exp")).count() == 0


@pytest.mark.parametrize("k,per_range", [(1, 50), (3, 50), (10, 50), (7, 5)])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_ntile_matches_window(spark, k, per_range, by):
    rnd = random.Random(k)
    rows = []
    for i in range(700):
        g = "hot" if i % 3 else rnd.choice(["a", "b", None])
        v = rnd.choice([None, float("nan"), 5.0, 5.0, rnd.uniform(-10, 10)])
        rows.append((i, g, v))
    # per_range=5 gives many more ranges than partitions
    _check(spark, rows, k, by, rows_per_range=per_range)


@settings(max_examples=8, deadline=None)
@given(st.integers(min_value=0, max_value=60), st.integers(min_value=1, max_value=12),
       st.integers(min_value=1, max_value=20))
def test_ntile_property(spark, n, k, per_range):
    rnd = random.Random(n * 31 + k)
    rows = [(i, rnd.choice(["x", "y"]), rnd.choice([None, 1.0, rnd.random()])) for i in range(n)]
    if not rows:
        return
    _check(spark, rows, k, ["g"], rows_per_range=per_range)


def test_rank_in_group_sizes(spark):
    rows = [(i, "a" if i < 40 else "b", float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    r = rank_in_group(df, ["v", "id"], by=["g"], rows_per_range=9)
    sizes = {row.g: row.s for row in r.groupBy("g").agg(F.max("__size").alias("s")).collect()}
    assert sizes == {"a": 40, "b": 60}
    ranks = sorted(x["__rank"] for x in r.filter(F.col("g") == "a").collect())
    assert ranks == list(range(1, 41))


def test_string_and_timestamp_keys(spark):
    import datetime as dt
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["b", "a", None, "é", "a'b"]),
             dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 50)))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, s string, t timestamp")
    got = ntile(df, 4, ["s", "t", "id"], name="x", rows_per_range=3)
    exp = _expected(df, 4, ["s", "t", "id"], [])
    bad = got.join(exp.select("id", "exp"), "id").filter(F.col("x") != F.col("exp")).count()
    assert bad == 0


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_wall_clock_order_in_other_zones(spark, zone):
    """Wall-clock times over a spring change keep their own order."""
    import datetime as dt
    start = dt.datetime(2024, 3, 10, 0, 0)
    rows = [(i, start + dt.timedelta(minutes=(i * 7) % 360)) for i in range(180)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame(rows, "id long, t timestamp_ntz")
        got = {r.id: r["__rank"] for r in rank_in_group(df, ["t", "id"],
                                                        rows_per_range=7).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = {i: n + 1 for n, (_, i) in enumerate(sorted((t, i) for i, t in rows))}
    assert got == want


def test_decimal_keys_and_many_ranges(spark):
    from decimal import Decimal
    rows = [(i, None if i % 11 == 0 else Decimal((i * 7919) % 500) / 100) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, v decimal(12,2)")
    got = ntile(df, 9, ["v", "id"], name="x", rows_per_range=6)
    exp = _expected(df, 9, ["v", "id"], [])
    assert got.join(exp.select("id", "exp"), "id").where("x <> exp").count() == 0


def test_hot_null_without_tiebreak_is_split(spark):
    df = spark.range(40_000).select(
        "id", F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("v"))
    r = rank_in_group(df, ["v"], rows_per_range=1000, keep_range=True)
    assert r.groupBy("__range").count().agg(F.max("count")).first()[0] <= 3000
    assert r.where("v is null").agg(F.max("__rank"), F.countDistinct("__rank")).first() == (
        20_000, 20_000)
    same = spark.range(20_000).select(F.lit("x").alias("g"), F.lit(None).cast("int").alias("v"))
    r = rank_in_group(same, ["v"], by=["g"], rows_per_range=500, keep_range=True)
    assert r.groupBy("__range").count().agg(F.max("count")).first()[0] <= 1500
