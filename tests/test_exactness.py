"""Means, map features and file identities that a plain oracle run does not reach."""

import os

import pytest
from pyspark.sql import functions as F

from temblor.operators.feed import map_feed
from temblor.operators.windowed import exact_avg
from temblor.sources.files import input_tag
from temblor.streaming.scoring import ALERT_THRESHOLD, alert_messages


def _mean(spark, values, scale=2):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(exact_avg("v", scale).alias("m")).first().m


def test_exact_avg_leaves_out_nan_and_null(spark):
    assert _mean(spark, [1.0, float("nan"), None, 2.0]) == 1.5
    assert _mean(spark, [None, float("nan")]) is None
    assert _mean(spark, [0.1, 0.2, 0.3]) == 0.6 / 3


def test_exact_avg_refuses_more_decimals(spark):
    with pytest.raises(Exception, match="decimals"):
        _mean(spark, [1.0, 1.006])
    with pytest.raises(Exception, match="decimals"):
        _mean(spark, [1e18])
    assert _mean(spark, [1.006, 2.0], 3) == 1.503


FEATURE = ("id string, properties struct<mag:double,place:string,time:bigint>, "
           "geometry struct<coordinates:array<double>>")


def test_map_feed_nested_features(spark):
    df = spark.createDataFrame([("a", (4.5, "LA", 5), ([-118.0, 34.0, 7.0],)),
                                ("b", (None, "", 6), ([1.0, 2.0],)), ("c", None, None)], FEATURE)
    got = {i: tuple(r) for i, r in enumerate(map_feed(df).collect())}
    assert got[0] == (34.0, -118.0, 4.5, 7.0, "LA", 5)
    assert got[1] == (2.0, 1.0, 0.0, 0.0, "Unknown", 6)
    assert got[2][:5] == (None, None, 0.0, 0.0, "Unknown") and got[2][5] > 1_700_000_000_000


def test_map_feed_nested_before_flat(spark):
    df = spark.createDataFrame([("a", (4.5, "LA", 5), ([-118.0, 34.0, 7.0],), 1.0, 2.0, 3.0, 9.9)],
                               FEATURE + ", latitude double, longitude double, depth double, "
                                         "magnitude double")
    assert tuple(map_feed(df).first()) == (34.0, -118.0, 4.5, 7.0, "LA", 5)


def test_input_tag_follows_the_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(5).write.parquet(path)
    first = input_tag(spark, [path])
    assert first == input_tag(spark, [path]) != input_tag(spark, [path], 1)
    spark.range(2).write.mode("append").parquet(path)
    assert input_tag(spark, [path]) != first


def test_alert_rows(spark):
    df = spark.createDataFrame(
        [("a", 3.9, 4.0, "x", 1.0, True), ("b", None, 5.25, None, None, True),
         ("c", 4.0, 3.9, "y", 1.0, False)],
        "id string, magnitude double, prediction double, place string, source_latitude double, "
        "alert boolean").withColumns({"source_longitude": F.lit(2.0),
                                      "source_depth_km": F.lit(3.0),
                                      "time": F.lit(None).cast("timestamp")})
    got = {r.id: r for r in alert_messages(df).collect()}
    assert set(got) == {"a", "b"} and ALERT_THRESHOLD == 4.0
    assert got["a"].subject == "M 4.0 expected near x" and "magnitude=3.9" in got["a"].body
    assert got["b"].subject.endswith("an unnamed place") and "magnitude=n/a" in got["b"].body
