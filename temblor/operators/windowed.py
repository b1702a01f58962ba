"""Tumbling event-time window metrics (same code for static and streaming frames)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..functions.labels import energy_joules, trend_label


def windowed(df: DataFrame, time: str, length: str, aggs: list[Column],
             watermark: str | None = None, by=()) -> DataFrame:
    """``groupBy(window(time, length), *by).agg(*aggs)``; optional watermark on ``time``."""
    if watermark:
        df = df.withWatermark(time, watermark)
    return df.groupBy(F.window(time, length).alias("window"), *by).agg(*aggs)


def flatten_window(df: DataFrame, start: str = "window_start",
                   end: str = "window_end") -> DataFrame:
    """Replace the ``window`` struct by two timestamp columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias(start), F.col("window.end").alias(end), *rest)


def exact_avg(value, scale: int) -> Column:
    """Mean of a column whose values have at most ``scale`` decimals: the sum
    is exact (decimal), then one double division. Any engine doing the same
    returns the identical double, so no rounding is needed to compare.

    Null and NaN values are left out of sum and count; a value with more
    decimals than declared, or beyond 18 digits, raises an error."""
    c = F.col(value) if isinstance(value, str) else value
    number = c.cast("double")
    exact = c.try_cast(f"decimal(18,{scale})")
    checked = (F.when(c.isNull() | F.isnan(number), F.lit(None))
               # A double computed from such a value may be off in its last bits.
               .when(F.abs(exact.cast("double") - number)
                     <= F.abs(number) * 1e-14 + 10.0 ** -(scale + 6), exact)
               .otherwise(F.raise_error(F.concat(
                   F.lit(f"exact_avg: more than {scale} decimals: "), c.cast("string")))))
    return F.sum(checked).cast("double") / F.nullif(F.count(checked), F.lit(0))


def window_avg(df, time="time", value="magnitude", length="30 minutes",
               name="avg_magnitude", exact_scale: int | None = None, **kw) -> DataFrame:
    agg = exact_avg(value, exact_scale) if exact_scale is not None else F.avg(value)
    return windowed(df, time, length, [agg.alias(name)], **kw)


def window_energy(df, time="time", magnitude="magnitude", length="30 minutes",
                  name="total_energy", **kw) -> DataFrame:
    return windowed(df, time, length, [F.sum(energy_joules(magnitude)).alias(name)], **kw)


def window_count(df, time="time", length="30 minutes", name="num_earthquakes",
                 **kw) -> DataFrame:
    return windowed(df, time, length, [F.count(F.lit(1)).alias(name)], **kw)


def window_trend(df, time="time", length="30 minutes", up=10, down=5,
                 count_name="num_earthquakes", name="trend", **kw) -> DataFrame:
    counted = window_count(df, time, length, count_name, **kw)
    return counted.withColumn(name, trend_label(count_name, up, down))


def window_count_above(df, value="magnitude", threshold=3.0, time="time",
                       length="60 minutes", name="num_earthquakes_mag_gt3",
                       **kw) -> DataFrame:
    return window_count(df.filter(F.col(value) > threshold), time, length, name, **kw)


def share_below(value: str, limit: float) -> Column:
    """Percentage of rows whose ``value`` is below ``limit``."""
    return F.count_if(F.col(value) < limit) / F.count(F.lit(1)) * 100


def window_share_below(df, value="depth", limit=10.0, time="time", length="30 minutes",
                       name="percent_shallow", **kw) -> DataFrame:
    return windowed(df, time, length, [share_below(value, limit).alias(name)], **kw)


def window_avg_nst(df, time="time", value="nst", length="30 minutes",
                   name="average_nst", **kw) -> DataFrame:
    return windowed(df, time, length, [F.avg(value).alias(name)], **kw)


def near_point(df: DataFrame, lat_col: str, lon_col: str, lat: float, lon: float,
               radius_km: float, distance_name: str = "distance") -> DataFrame:
    """Rows within ``radius_km`` of a fixed point (boundary included)."""
    return (df.withColumn(distance_name, haversine_km(lat_col, lon_col, lat, lon))
              .filter(F.col(distance_name) <= radius_km))


# The reference point (Los Angeles) and radius of the near-point count.
NEAR_POINT_LAT = 34.052235
NEAR_POINT_LON = -118.243683
NEAR_POINT_RADIUS_KM = 300.0


def window_near_point_count(df, lat_col="latitude", lon_col="longitude",
                            lat=NEAR_POINT_LAT, lon=NEAR_POINT_LON,
                            radius_km=NEAR_POINT_RADIUS_KM, time="time",
                            length="120 minutes", name="count", **kw) -> DataFrame:
    near = near_point(df, lat_col, lon_col, lat, lon, radius_km)
    return window_count(near, time, length, name, **kw)


# Window lengths in minutes. The half-hour metrics, the count of
# strong events, and the count near a point.
METRIC_MINUTES, STRONG_MINUTES, NEAR_MINUTES = 30, 60, 120


def window_metrics(df: DataFrame, time: str = "time", watermark: str | None = None,
                   magnitude: str = "magnitude", depth: str = "depth", nst: str = "nst",
                   strong: float = 3.0, shallow: float = 10.0, lat_col: str = "latitude",
                   lon_col: str = "longitude", lat: float = NEAR_POINT_LAT,
                   lon: float = NEAR_POINT_LON, radius_km: float = NEAR_POINT_RADIUS_KM,
                   exact_scale: int | None = None) -> DataFrame:
    """All seven windowed metrics in one aggregation: each event is expanded to
    the window lengths it counts in (30 minutes: every event; 60: those above
    ``strong``; 120: those near the point), and rows are grouped by ``minutes``
    and ``window_end``. ``num_events`` is the count of each; the other columns
    mean something for the half-hour windows only.

    On a stream the watermark stands on the end of the window, up to the longest
    length after the event: that much is added to the delay, so that no event
    less than ``watermark`` late is lost and ended windows leave the state."""
    near = haversine_km(lat_col, lon_col, lat, lon) <= radius_km
    lengths = F.array_compact(F.array(
        F.lit(METRIC_MINUTES), F.when(F.col(magnitude) > strong, STRONG_MINUTES),
        F.when(near, NEAR_MINUTES)))
    seconds = F.col("minutes") * 60
    end = F.timestamp_seconds((F.floor(F.unix_seconds(time) / seconds) + 1) * seconds)
    rows = (df.where(F.col(time).isNotNull()).withColumn("minutes", F.explode(lengths))
            .withColumn("window_end", end))
    if watermark:
        rows = rows.withWatermark("window_end", f"{watermark} {NEAR_MINUTES} minutes")
    avg = exact_avg(magnitude, exact_scale) if exact_scale is not None else F.avg(magnitude)
    out = rows.groupBy("minutes", "window_end").agg(
        avg.alias("avg_magnitude"), F.sum(energy_joules(magnitude)).alias("total_energy"),
        F.count(F.lit(1)).alias("num_events"),
        share_below(depth, shallow).alias("percent_shallow"),
        F.avg(nst).alias("average_nst"))
    start = F.timestamp_seconds(F.unix_seconds("window_end") - seconds)
    return out.select("minutes", start.alias("window_start"), "window_end", "num_events",
                      "avg_magnitude", "total_energy", "percent_shallow", "average_nst",
                      trend_label("num_events").alias("trend"))


def feed_status(df: DataFrame, time: str = "time", count_name: str = "total_events",
                last_name: str = "last_update") -> DataFrame:
    """Total events and the newest event time (one row)."""
    return df.agg(F.count(F.lit(1)).alias(count_name), F.max(time).alias(last_name))
