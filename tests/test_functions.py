import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from temblor.functions import (STRICT_UNSIGNED, bracketed_number, clean_numeric,
                               distance_band, gated_cast, haversine_km, split_triplet,
                               to_float, trend_label)


def _one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_numeric_sentinels(spark):
    rows = [("None",), ("nan",), ("NaN",), (None,), ("12.5",), ("-3.5",), ("1e-4",), ("abc",)]
    got = [r.r for r in spark.createDataFrame(rows, "x string")
           .select(clean_numeric("x", "double").alias("r")).collect()]
    assert got[:4] == [None, None, None, None]
    assert got[4:7] == [12.5, -3.5, 0.0001]
    assert got[7] is None


def test_brackets_and_trailing_dot(spark):
    assert _one(spark, bracketed_number("x", "double"), "[[1234.]]") == 1234.0
    assert _one(spark, bracketed_number("x", "double"), "[[555.6]]") == 555.6
    assert _one(spark, bracketed_number("x", "double"), None) is None
    assert _one(spark, to_float("x", "double"), "12.") == 12.0
    assert _one(spark, to_float("x", "double"), "None") is None


def test_gated_cast_patterns(spark):
    assert _one(spark, gated_cast("x", to="double"), "-33.2") == -33.2
    assert _one(spark, gated_cast("x", to="double"), "1e-4") == 0.0001
    assert _one(spark, gated_cast("x", STRICT_UNSIGNED, "double"), "-33.2") is None
    assert _one(spark, gated_cast("x", STRICT_UNSIGNED, "double"), "33.2") == 33.2
    assert _one(spark, gated_cast("x", to="double"), "None") is None


def test_split_triplet_trims(spark):
    row = (spark.createDataFrame([("[[  67.0 34.6   56.7 ]]",)], "x string")
           .select(*split_triplet("x", to="double")).first())
    assert (row.strike, row.dip, row.rake) == (67.0, 34.6, 56.7)


def test_distance_band_edges(spark):
    rows = [(49.999,), (50.0,), (100.0,), (100.001,), (None,)]
    got = [r.b for r in spark.createDataFrame(rows, "d double")
           .select(distance_band("d").alias("b")).collect()]
    assert got == ["Near", "Medium", "Medium", "Far", "Far"]


def test_trend_label(spark):
    rows = [(11,), (10,), (5,), (4,)]
    got = [r.t for r in spark.createDataFrame(rows, "c long")
           .select(trend_label("c").alias("t")).collect()]
    assert got == ["increase", "stable", "stable", "decrease"]


coord = st.tuples(st.floats(-90, 90), st.floats(-180, 180))


@settings(max_examples=15, deadline=None)
@given(coord, coord)
def test_haversine_properties(spark, a, b):
    df = spark.createDataFrame([(a[0], a[1], b[0], b[1])], "a double, b double, c double, d double")
    r = df.select(haversine_km("a", "b", "c", "d").alias("ab"),
                  haversine_km("c", "d", "a", "b").alias("ba"),
                  haversine_km("a", "b", "a", "b").alias("aa")).first()
    assert math.isclose(r.ab, r.ba, rel_tol=1e-9, abs_tol=1e-6)
    assert r.aa == 0.0
    assert 0.0 <= r.ab <= math.pi * 6371.0 + 1e-6


def test_haversine_known_value(spark):
    df = spark.createDataFrame([(0.0,)], "x double")
    km = df.select(haversine_km(0.0, 0.0, 0.0, 1.0).alias("k")).first().k
    assert abs(km - 111.19492664455873) < 1e-9
    assert df.select(F.lit(1)).count() == 1
