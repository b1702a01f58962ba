"""The curated questions mapped onto the driver's tables.

``quakes_view`` derives seismic-shaped columns from ``events`` with plain
arithmetic (repeatable in any SQL engine); the TPC-H-like tables stand in
for the per-network questions. Each function takes ``(spark, sf_dir)`` and
returns a lazy DataFrame over the whole tables. ``ORACLE_SQL`` holds the
equivalent DuckDB SQL for every key that SQL can express.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import (STRICT_UNSIGNED, SIGNED_NUMBER, bracketed_number,
                               clean_numeric, gated_cast, to_float)
from ..functions.geo import distance_band, haversine_km
from ..functions.timefn import cutoff_date, quarter_label
from ..operators.feed import map_feed, replay_counts, time_slices
from ..operators.ntile import ntile_profile
from ..operators.pairs import proximity_pairs
from ..operators.share import share_of_total
from ..operators.sigma import sigma_label
from ..operators.topk import latest_n, top_per_group
from ..operators.trend import period_change
from ..operators.weighted import weighted_avg
from ..operators.windowed import exact_avg
from ..operators.windowed import (NEAR_POINT_LAT, NEAR_POINT_LON, feed_status,
                                  flatten_window, window_avg, window_avg_nst,
                                  window_count_above, window_energy,
                                  window_near_point_count, window_share_below,
                                  window_trend)
from ..sources.feed import flatten_geojson, to_feature_collections
from ..sources.files import read_parquet_cached

# Fixed "today" values so that period cut-offs are repeatable.
AS_OF_30Y = dt.date(2026, 1, 1)
AS_OF_10Y = dt.date(2006, 1, 1)
# Radius for the near-point count on the derived coordinates (300 km finds
# almost nothing there).
DRIVER_RADIUS_KM = 3000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_cached(spark, f"{sf_dir}/{name}.parquet")


def quakes_from_events(ev: DataFrame) -> DataFrame:
    """Seismic-shaped columns derived from ``events`` (static or streaming)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    lat = ((eid * 7919) % 18000).cast("double") / 100.0 - 90
    lon = ((eid * 104729) % 36000).cast("double") / 100.0 - 180
    return ev.select(
        eid.alias("id"), F.col("ts").alias("time"),
        (F.col("value") / 50.0).alias("magnitude"),
        F.col("event_type").alias("net"), uid.alias("user_id"),
        lat.alias("latitude"), lon.alias("longitude"),
        (((eid * 13) % 700).cast("double") / 10.0).alias("depth"),
        ((eid * 7) % 40).alias("nst"),
        ((eid * 11) % 360).cast("double").alias("gap"),
        (lat + ((uid * 31) % 300).cast("double") / 100.0 - 1.5).alias("rlat"),
        (lon + ((uid * 17) % 300).cast("double") / 100.0 - 1.5).alias("rlon"),
    )


def quakes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quakes_from_events(table(spark, sf_dir, "events"))


QUAKES_SQL = """quakes AS (
  SELECT event_id AS id, ts AS time, value / 50.0 AS magnitude, event_type AS net, user_id,
         CAST((event_id * 7919) % 18000 AS DOUBLE) / 100.0 - 90 AS latitude,
         CAST((event_id * 104729) % 36000 AS DOUBLE) / 100.0 - 180 AS longitude,
         CAST((event_id * 13) % 700 AS DOUBLE) / 10.0 AS depth,
         (event_id * 7) % 40 AS nst,
         CAST((event_id * 11) % 360 AS DOUBLE) AS gap,
         CAST((event_id * 7919) % 18000 AS DOUBLE) / 100.0 - 90
           + CAST((user_id * 31) % 300 AS DOUBLE) / 100.0 - 1.5 AS rlat,
         CAST((event_id * 104729) % 36000 AS DOUBLE) / 100.0 - 180
           + CAST((user_id * 17) % 300 AS DOUBLE) / 100.0 - 1.5 AS rlon
  FROM events)"""


def _hav_sql(lat1, lon1, lat2, lon2):
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)")
    return f"(CAST(6371.0 AS DOUBLE) * 2 * atan2(sqrt({a}), sqrt(1 - ({a}))))"


def _r(col, d=6):
    return F.round(col if not isinstance(col, str) else F.col(col), d)


# --------------------------------------------------------------------------- Q1
def top_per_year_group(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                              "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .filter(F.col("o_orderdate").isNotNull() & F.col("o_totalprice").isNotNull()
                  & (F.col("o_orderdate") >= cutoff_date(AS_OF_30Y, 30 * 365))))
    top = top_per_group(j, [F.year("o_orderdate"), F.col("c_nationkey")],
                        [F.col("o_totalprice").desc()])
    return top.select(F.year("o_orderdate").cast("long").alias("year"),
                      F.month("o_orderdate").cast("long").alias("month"),
                      F.dayofmonth("o_orderdate").cast("long").alias("day"),
                      F.col("c_nationkey").cast("long").alias("c_nationkey"),
                      "o_orderkey", "o_totalprice")


Q1_SQL = """
WITH j AS (
  SELECT o.o_orderkey, o.o_totalprice, o.o_orderdate, c.c_nationkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderdate IS NOT NULL AND o.o_totalprice IS NOT NULL
    AND o.o_orderdate >= DATE '2026-01-01' - 10950),
r AS (SELECT *, rank() OVER (PARTITION BY year(o_orderdate), c_nationkey
                             ORDER BY o_totalprice DESC) AS rnk FROM j)
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
       CAST(day(o_orderdate) AS BIGINT) AS day, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       o_orderkey, o_totalprice
FROM r WHERE rnk = 1"""


# --------------------------------------------------------------------------- Q2
def quarterly_trend(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    kept = o.filter((F.col("o_orderdate") >= cutoff_date(AS_OF_10Y, 10 * 365))
                    & F.col("o_totalprice").isNotNull())
    out = period_change(kept, quarter_label("o_orderdate"),
                        {"avg_totalprice": exact_avg("o_totalprice", 2)}, "avg_totalprice",
                        by=["o_orderpriority"], period_name="quarter",
                        prev_name="prev_quarter_avg", change_name="change_from_prev_quarter")
    return out.select("quarter", "o_orderpriority", "avg_totalprice", "prev_quarter_avg",
                      "change_from_prev_quarter")


Q2_SQL = """
WITH g AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
         o_orderpriority,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS a
  FROM orders
  WHERE o_orderdate >= DATE '2006-01-01' - 3650 AND o_totalprice IS NOT NULL
  GROUP BY 1, 2),
l AS (SELECT *, lag(a) OVER (PARTITION BY o_orderpriority ORDER BY quarter) AS p FROM g)
SELECT quarter, o_orderpriority, a AS avg_totalprice, p AS prev_quarter_avg,
       a - p AS change_from_prev_quarter
FROM l"""


# --------------------------------------------------------------------------- Q3
def sigma_label_global(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value").filter(
        F.col("value").isNotNull())
    out = sigma_label(ev, "value", mean_name="avg_value", std_name="std_dev_value",
                      label_name="value_category", mean_scale=2)
    return out.select("event_id", "value", "avg_value",
                      _r("std_dev_value").alias("std_dev_value"), "value_category")


Q3_SQL = """
WITH s AS (SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS m,
                  stddev_samp(value) AS sd FROM events WHERE value IS NOT NULL)
SELECT e.event_id, e.value, s.m AS avg_value, round(s.sd, 6) AS std_dev_value,
       CASE WHEN e.value > s.m + 2 * s.sd THEN 'Anomalous' ELSE 'Normal' END AS value_category
FROM events e CROSS JOIN s WHERE e.value IS NOT NULL"""


# --------------------------------------------------------------------------- Q4
def ntile_profile_by_group(spark, sf_dir):
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal").isNotNull())
    out = ntile_profile(c, 3, ["c_acctbal", "c_custkey"],
                        {"avg_acctbal": exact_avg("c_acctbal", 2),
                         "min_acctbal": F.min("c_acctbal"), "max_acctbal": F.max("c_acctbal")},
                        by=["c_nationkey"], tile_name="acctbal_tile")
    return out.select(F.col("c_nationkey").cast("long").alias("c_nationkey"),
                      F.col("acctbal_tile").cast("long").alias("acctbal_tile"),
                      "avg_acctbal", "min_acctbal", "max_acctbal")


Q4_SQL = """
WITH t AS (
  SELECT c_nationkey, c_acctbal,
         ntile(3) OVER (PARTITION BY c_nationkey
                        ORDER BY c_acctbal NULLS FIRST, c_custkey NULLS FIRST) AS tile
  FROM customer WHERE c_acctbal IS NOT NULL)
SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(tile AS BIGINT) AS acctbal_tile,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avg_acctbal,
       min(c_acctbal) AS min_acctbal,
       max(c_acctbal) AS max_acctbal
FROM t GROUP BY 1, 2"""


# --------------------------------------------------------------------------- Q5
def _ship_delay(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .filter(F.col("l_shipdate").isNotNull() & F.col("o_orderdate").isNotNull())
              .withColumn("delay", F.datediff(F.to_date("l_shipdate"),
                                              F.to_date("o_orderdate")).cast("long")))


def yearly_lag_change(spark, sf_dir):
    j = _ship_delay(spark, sf_dir)
    out = period_change(j, F.year("o_orderdate"),
                        {"avg_ship_delay": exact_avg("delay", 0), "max_ship_delay": F.max("delay")},
                        "avg_ship_delay", period_name="year",
                        change_name="change_from_prev_year")
    return out.select(F.col("year").cast("long").alias("year"),
                      "avg_ship_delay",
                      F.col("max_ship_delay").cast("long").alias("max_ship_delay"),
                      "change_from_prev_year")


Q5_SQL = """
WITH j AS (
  SELECT year(o.o_orderdate) AS y, datediff('day', o.o_orderdate, l.l_shipdate) AS d
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_shipdate IS NOT NULL AND o.o_orderdate IS NOT NULL),
g AS (SELECT y, CAST(sum(CAST(d AS DECIMAL(18,0))) AS DOUBLE) / count(d) AS a, max(d) AS mx
      FROM j GROUP BY y)
SELECT CAST(y AS BIGINT) AS year, a AS avg_ship_delay, CAST(mx AS BIGINT) AS max_ship_delay,
       a - lag(a) OVER (ORDER BY y) AS change_from_prev_year
FROM g"""


# --------------------------------------------------------------------------- Q6
def _station_km():
    return haversine_km("latitude", "longitude", "rlat", "rlon")


def distance_weighted_avg(spark, sf_dir):
    q = (quakes_view(spark, sf_dir).withColumn("station_km", _station_km())
         .withColumn("day", F.window("time", "1 day").start))
    out = weighted_avg(q, "magnitude", "station_km", ["day"], value_scale=MAGNITUDE_SCALE)
    return out.select("day", _r("avg_weighted_magnitude").alias("avg_weighted_magnitude"),
                      "avg_magnitude")


Q6_SQL = f"""
WITH {QUAKES_SQL},
d AS (SELECT time_bucket(INTERVAL '1 day', time) AS day, magnitude, {_hav_sql('latitude', 'longitude', 'rlat', 'rlon')} AS km
      FROM quakes)
SELECT day, round(avg(magnitude / (1 + km)), 6) AS avg_weighted_magnitude,
       CAST(sum(CAST(magnitude AS DECIMAL(18,4))) AS DOUBLE) / count(magnitude) AS avg_magnitude
FROM d WHERE magnitude IS NOT NULL AND km IS NOT NULL GROUP BY day"""


# --------------------------------------------------------------------------- Q7
def ntile_profile_global(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    out = ntile_profile(o, 10, ["o_totalprice", "o_orderkey"],
                        {"avg_totalprice": exact_avg("o_totalprice", 2),
                         "row_count": F.count(F.lit(1))},
                        tile_name="price_decile")
    return out.select(F.col("price_decile").cast("long").alias("price_decile"),
                      "avg_totalprice", "row_count")


Q7_SQL = """
WITH t AS (SELECT o_totalprice,
                  ntile(10) OVER (ORDER BY o_totalprice NULLS FIRST, o_orderkey NULLS FIRST) AS tile
           FROM orders)
SELECT CAST(tile AS BIGINT) AS price_decile,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_totalprice,
       count(*) AS row_count
FROM t GROUP BY 1"""


# --------------------------------------------------------------------------- Q8
def share_of_total_q(spark, sf_dir):
    out = share_of_total(table(spark, sf_dir, "events"), ["event_type"])
    return out.select("event_type", "event_count", "total_events",
                      _r("event_percentage").alias("event_percentage"))


Q8_SQL = """
WITH g AS (SELECT event_type, count(*) AS event_count FROM events GROUP BY 1)
SELECT event_type, event_count, CAST(sum(event_count) OVER () AS BIGINT) AS total_events,
       round(CAST(event_count AS DOUBLE) / CAST(sum(event_count) OVER () AS DOUBLE) * 100, 6)
         AS event_percentage
FROM g"""


# --------------------------------------------------------------------------- Q9
def sigma_label_by_group(spark, sf_dir):
    j = _ship_delay(spark, sf_dir).select("l_returnflag", "l_orderkey", "delay")
    out = sigma_label(j, "delay", by=["l_returnflag"], mean_name="avg_delay",
                      std_name="std_dev_delay", label_name="delay_status", mean_scale=0,
                      materialize=True)
    return out.select("l_returnflag", "l_orderkey", "delay", "avg_delay",
                      _r("std_dev_delay").alias("std_dev_delay"), "delay_status")


Q9_SQL = """
WITH j AS (
  SELECT l.l_returnflag, l.l_orderkey,
         CAST(datediff('day', o.o_orderdate, l.l_shipdate) AS BIGINT) AS delay
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_shipdate IS NOT NULL AND o.o_orderdate IS NOT NULL),
s AS (SELECT l_returnflag, CAST(sum(CAST(delay AS DECIMAL(18,0))) AS DOUBLE) / count(delay) AS m,
             stddev_samp(delay) AS sd FROM j GROUP BY 1)
SELECT j.l_returnflag, j.l_orderkey, j.delay, s.m AS avg_delay,
       round(s.sd, 6) AS std_dev_delay,
       CASE WHEN j.delay > s.m + 2 * s.sd THEN 'Anomalous' ELSE 'Normal' END AS delay_status
FROM j JOIN s ON j.l_returnflag IS NOT DISTINCT FROM s.l_returnflag"""


# --------------------------------------------------------------------------- Q10
def station_distance_band(spark, sf_dir):
    q = quakes_view(spark, sf_dir).filter(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        & F.col("rlat").isNotNull() & F.col("rlon").isNotNull())
    d = q.withColumn("km", _station_km())
    return d.select("net", "id", _r("km").alias("distance_km"),
                    distance_band("km").alias("distance_category"))


Q10_SQL = f"""
WITH {QUAKES_SQL},
d AS (SELECT net, id, {_hav_sql('latitude', 'longitude', 'rlat', 'rlon')} AS km FROM quakes
      WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND rlat IS NOT NULL AND rlon IS NOT NULL)
SELECT net, id, round(km, 6) AS distance_km,
       CASE WHEN km < 50 THEN 'Near' WHEN km >= 50 AND km <= 100 THEN 'Medium' ELSE 'Far' END
         AS distance_category
FROM d"""


# --------------------------------------------------------------- S0-S6 (static)
# Magnitudes here are value / 50 with value in cents: at most 4 decimals.
MAGNITUDE_SCALE = 4


def window_avg_q(spark, sf_dir):
    out = flatten_window(window_avg(quakes_view(spark, sf_dir), exact_scale=MAGNITUDE_SCALE))
    return out.select("window_start", "window_end", "avg_magnitude")


def _bucket_sql(minutes, body, extra_where=""):
    return f"""
WITH {QUAKES_SQL}
SELECT time_bucket(INTERVAL '{minutes} minutes', time) AS window_start,
       time_bucket(INTERVAL '{minutes} minutes', time) + INTERVAL '{minutes} minutes' AS window_end,
       {body}
FROM quakes {extra_where} GROUP BY 1, 2"""


EXACT_AVG_MAG_SQL = ("CAST(sum(CAST(magnitude AS DECIMAL(18,4))) AS DOUBLE) / count(magnitude)"
                     " AS avg_magnitude")
S1_SQL = _bucket_sql(30, EXACT_AVG_MAG_SQL)


def window_count_gt(spark, sf_dir):
    out = flatten_window(window_count_above(quakes_view(spark, sf_dir)))
    return out.select("window_start", "window_end", "num_earthquakes_mag_gt3")


S0_SQL = _bucket_sql(60, "count(*) AS num_earthquakes_mag_gt3", "WHERE magnitude > 3.0")


def window_energy_q(spark, sf_dir):
    out = flatten_window(window_energy(quakes_view(spark, sf_dir)))
    return out.select("window_start", "window_end",
                      _r(F.log10("total_energy")).alias("log10_total_energy"))


S2_SQL = _bucket_sql(30, "round(log10(sum(pow(10.0, 1.5 * magnitude + 4.8))), 6) AS log10_total_energy")


def window_trend_q(spark, sf_dir):
    out = flatten_window(window_trend(quakes_view(spark, sf_dir)))
    return out.select("window_start", "window_end", "num_earthquakes", "trend")


S3_SQL = _bucket_sql(30, """count(*) AS num_earthquakes,
       CASE WHEN count(*) > 10 THEN 'increase' WHEN count(*) < 5 THEN 'decrease' ELSE 'stable' END AS trend""")


def window_shallow_share(spark, sf_dir):
    out = flatten_window(window_share_below(quakes_view(spark, sf_dir)))
    return out.select("window_start", "window_end", _r("percent_shallow").alias("percent_shallow"))


S4_SQL = _bucket_sql(30, """round(CAST(sum(CASE WHEN depth < 10 THEN 1 ELSE 0 END) AS DOUBLE)
             / count(*) * 100, 6) AS percent_shallow""")


def window_avg_nst_q(spark, sf_dir):
    out = flatten_window(window_avg_nst(quakes_view(spark, sf_dir)))
    return out.select("window_start", "window_end", _r("average_nst").alias("average_nst"))


S5_SQL = _bucket_sql(30, "round(avg(nst), 6) AS average_nst")


def radius_window_count(spark, sf_dir):
    out = flatten_window(window_near_point_count(quakes_view(spark, sf_dir),
                                                 radius_km=DRIVER_RADIUS_KM))
    return out.select("window_start", "window_end", "count")


S6_SQL = f"""
WITH {QUAKES_SQL},
n AS (SELECT time FROM quakes
      WHERE {_hav_sql('latitude', 'longitude', NEAR_POINT_LAT, NEAR_POINT_LON)} <= {DRIVER_RADIUS_KM})
SELECT time_bucket(INTERVAL '120 minutes', time) AS window_start,
       time_bucket(INTERVAL '120 minutes', time) + INTERVAL '120 minutes' AS window_end,
       count(*) AS count
FROM n GROUP BY 1, 2"""


# ------------------------------------------------------------------- S7 (static)
PAIR_COLUMNS = ["window_start", "id", "previous_id", "magnitude", "previous_magnitude",
                "time", "previous_time", "net", "nst", "gap", "latitude", "longitude", "depth",
                "previous_latitude", "previous_longitude", "previous_depth"]


def pairs_out(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("window_start", F.col("window.start")).select(*PAIR_COLUMNS)


def close_together(q: DataFrame) -> DataFrame:
    """Quakes on a coarser grid of places, so that hourly windows hold pairs."""
    return (q.withColumn("latitude", ((F.col("id") * 37) % 180).cast("double") - 90)
             .withColumn("longitude", ((F.col("id") * 73) % 360).cast("double") - 180))


def proximity_jump_pairs(spark, sf_dir):
    q = close_together(quakes_view(spark, sf_dir))
    return pairs_out(proximity_pairs(q, length="60 minutes"))


S7_SQL = f"""
WITH {QUAKES_SQL},
q AS (SELECT id, magnitude, time, net, nst, gap, depth,
             CAST((id * 37) % 180 AS DOUBLE) - 90 AS latitude,
             CAST((id * 73) % 360 AS DOUBLE) - 180 AS longitude,
             time_bucket(INTERVAL '60 minutes', time) AS w FROM quakes)
SELECT a.w AS window_start, a.id, b.id AS previous_id, a.magnitude, b.magnitude AS previous_magnitude,
       a.time, b.time AS previous_time, a.net, a.nst, a.gap, a.latitude, a.longitude, a.depth,
       b.latitude AS previous_latitude, b.longitude AS previous_longitude,
       b.depth AS previous_depth
FROM q a JOIN q b ON a.w = b.w AND abs(a.latitude - b.latitude) < 20
                  AND abs(a.longitude - b.longitude) < 20
WHERE a.magnitude - b.magnitude > 0.2"""


# ----------------------------------------------------------- feed and replay
def slice_replay(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("ts")
    return replay_counts(ev, time_slices(ev, "ts", 15), "ts", 15)


A7_SQL = """
WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, max(ts) AS hi FROM events),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS slice_start FROM b),
c AS (SELECT time_bucket(INTERVAL '15 minutes', ts) AS slice_start, count(*) AS n
      FROM events GROUP BY 1)
SELECT s.slice_start, s.slice_start + INTERVAL 15 MINUTE AS slice_end,
       CAST(coalesce(c.n, 0) AS BIGINT) AS num_events
FROM s LEFT JOIN c ON s.slice_start = c.slice_start"""


LATEST_COLUMNS = ["id", "time", "magnitude", "latitude", "longitude", "depth"]


def latest_events(spark, sf_dir):
    return latest_n(quakes_view(spark, sf_dir).select(*LATEST_COLUMNS), "time", "id", 1000)


G8_SQL = f"""
WITH {QUAKES_SQL}
SELECT id, time, magnitude, latitude, longitude, depth FROM quakes
ORDER BY time DESC NULLS LAST, id DESC NULLS LAST LIMIT 1000"""


def feed_status_q(spark, sf_dir):
    return feed_status(quakes_view(spark, sf_dir))


E12_SQL = f"""
WITH {QUAKES_SQL}
SELECT count(*) AS total_events, max(time) AS last_update FROM quakes"""


def map_feed_q(spark, sf_dir):
    return map_feed(quakes_view(spark, sf_dir).drop("rlat", "rlon"))


C22_SQL = f"""
WITH {QUAKES_SQL}
SELECT latitude, longitude, coalesce(magnitude, 0.0) AS magnitude, coalesce(depth, 0.0) AS depth,
       'Unknown' AS place, time
FROM quakes"""


# ---------------------------------------------------------- dirty numeric text
def _dirty_text(ev: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    dec = F.concat((eid % 1000).cast("string"), F.lit("."), (eid % 7).cast("string"))
    raw = (F.when(eid % 8 == 0, F.concat(F.lit("[["), dec, F.lit("]]")))
           .when(eid % 8 == 1, F.lit("None")).when(eid % 8 == 2, F.lit("nan"))
           .when(eid % 8 == 3, F.lit("-3.5"))
           .when(eid % 8 == 4, F.concat((eid % 1000).cast("string"), F.lit(".")))
           .when(eid % 8 == 5, dec).when(eid % 8 == 6, F.lit(None).cast("string"))
           .otherwise(F.lit("1e-4")))
    return ev.select("event_id", raw.alias("raw_text"))


def clean_numeric_text(spark, sf_dir):
    d = _dirty_text(table(spark, sf_dir, "events"))
    return d.select("event_id", "raw_text",
                    bracketed_number("raw_text", "double").alias("bracket_value"),
                    clean_numeric("raw_text", "double").alias("clean_value"),
                    to_float("raw_text", "double").alias("dot_value"),
                    gated_cast("raw_text", STRICT_UNSIGNED, "double").alias("gated_strict"),
                    gated_cast("raw_text", SIGNED_NUMBER, "double").alias("gated_signed"))


def _sql_nan_null(x):
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


_DEC = "CAST(event_id % 1000 AS VARCHAR) || '.' || CAST(event_id % 7 AS VARCHAR)"
C6_SQL = f"""
WITH d AS (
  SELECT event_id,
         CASE event_id % 8 WHEN 0 THEN '[[' || {_DEC} || ']]' WHEN 1 THEN 'None'
              WHEN 2 THEN 'nan' WHEN 3 THEN '-3.5'
              WHEN 4 THEN CAST(event_id % 1000 AS VARCHAR) || '.'
              WHEN 5 THEN {_DEC} WHEN 6 THEN NULL ELSE '1e-4' END AS raw_text
  FROM events)
SELECT event_id, raw_text,
  {_sql_nan_null("TRY_CAST(trim(regexp_replace(raw_text, '^\\s*\\[+|\\]+\\s*$', '', 'g')) AS DOUBLE)")} AS bracket_value,
  {_sql_nan_null("CASE WHEN trim(raw_text) IN ('None', 'nan') THEN NULL ELSE TRY_CAST(trim(raw_text) AS DOUBLE) END")} AS clean_value,
  {_sql_nan_null("TRY_CAST(regexp_replace(raw_text, '(\\d+)\\.$', '\\1.0') AS DOUBLE)")} AS dot_value,
  CASE WHEN regexp_matches(trim(raw_text), '{STRICT_UNSIGNED}') THEN TRY_CAST(trim(raw_text) AS DOUBLE) END AS gated_strict,
  CASE WHEN regexp_matches(trim(raw_text), '{SIGNED_NUMBER}') THEN TRY_CAST(trim(raw_text) AS DOUBLE) END AS gated_signed
FROM d"""


# ------------------------------------------------------------- GeoJSON round trip
FLAT_COLUMNS = ["id", "magnitude", "time", "net", "nst", "gap", "latitude", "longitude", "depth"]


def geojson_flatten(spark, sf_dir):
    q = quakes_view(spark, sf_dir)
    collections = to_feature_collections(q, per_collection=100)
    flat = flatten_geojson(collections, "value")
    return flat.select("id", "magnitude", "time", "net", F.col("nst").cast("long").alias("nst"),
                       "gap", "latitude", "longitude", "depth")


A6_SQL = f"""
WITH {QUAKES_SQL}
SELECT CAST(id AS VARCHAR) AS id, magnitude, epoch_us(time) // 1000 AS time, net, nst, gap,
       latitude, longitude, depth
FROM quakes"""


QUERIES = {
    "top_per_year_group": top_per_year_group,
    "quarterly_trend": quarterly_trend,
    "sigma_label_global": sigma_label_global,
    "ntile_profile_by_group": ntile_profile_by_group,
    "yearly_lag_change": yearly_lag_change,
    "distance_weighted_avg": distance_weighted_avg,
    "ntile_profile_global": ntile_profile_global,
    "share_of_total": share_of_total_q,
    "sigma_label_by_group": sigma_label_by_group,
    "station_distance_band": station_distance_band,
    "window_avg": window_avg_q,
    "window_count_gt": window_count_gt,
    "window_energy": window_energy_q,
    "window_trend": window_trend_q,
    "window_shallow_share": window_shallow_share,
    "window_avg_nst": window_avg_nst_q,
    "radius_window_count": radius_window_count,
    "proximity_jump_pairs": proximity_jump_pairs,
    "slice_replay": slice_replay,
    "latest_events": latest_events,
    "feed_status": feed_status_q,
    "map_feed": map_feed_q,
    "clean_numeric_text": clean_numeric_text,
    "geojson_flatten": geojson_flatten,
}

ORACLE_SQL = {
    "top_per_year_group": Q1_SQL,
    "quarterly_trend": Q2_SQL,
    "sigma_label_global": Q3_SQL,
    "ntile_profile_by_group": Q4_SQL,
    "yearly_lag_change": Q5_SQL,
    "distance_weighted_avg": Q6_SQL,
    "ntile_profile_global": Q7_SQL,
    "share_of_total": Q8_SQL,
    "sigma_label_by_group": Q9_SQL,
    "station_distance_band": Q10_SQL,
    "window_avg": S1_SQL,
    "window_count_gt": S0_SQL,
    "window_energy": S2_SQL,
    "window_trend": S3_SQL,
    "window_shallow_share": S4_SQL,
    "window_avg_nst": S5_SQL,
    "radius_window_count": S6_SQL,
    "proximity_jump_pairs": S7_SQL,
    "slice_replay": A7_SQL,
    "latest_events": G8_SQL,
    "feed_status": E12_SQL,
    "map_feed": C22_SQL,
    "clean_numeric_text": C6_SQL,
    "geojson_flatten": A6_SQL,
}
