"""Data shaping for map clients and feed replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_feed(df: DataFrame) -> DataFrame:
    """Points for a map client, from nested features or flat events.

    Nested ``geometry.coordinates`` (longitude, latitude, depth) come before
    flat columns, and nested ``properties`` before columns of the same name;
    magnitude is ``mag`` or ``magnitude`` (else 0), depth else 0, place else
    'Unknown' (also for an empty one), time else now."""
    cols = set(df.columns)
    nested = set()
    if "properties" in cols and isinstance(df.schema["properties"].dataType, T.StructType):
        nested = set(df.schema["properties"].dataType.names)

    def pick(*names):
        return ([F.col(f"properties.{n}") for n in names if n in nested]
                + [F.col(n) for n in names if n in cols])

    def coordinate(i):
        return [F.get(F.col("geometry.coordinates"), i)] if "geometry" in cols else []

    times = pick("time")
    kind = df.select(times[0].alias("t")).schema["t"].dataType if times else T.TimestampType()
    # "now" in the time column's own type (epoch milliseconds or a timestamp).
    now = (F.unix_millis(F.current_timestamp()) if isinstance(kind, T.NumericType)
           else F.current_timestamp()).cast(kind)
    no_number = F.lit(None).cast("double")
    return df.select(
        F.coalesce(*coordinate(1), *pick("latitude"), no_number).alias("latitude"),
        F.coalesce(*coordinate(0), *pick("longitude"), no_number).alias("longitude"),
        F.coalesce(*pick("mag", "magnitude"), F.lit(0.0)).cast("double").alias("magnitude"),
        F.coalesce(*coordinate(2), *pick("depth"), F.lit(0.0)).cast("double").alias("depth"),
        F.coalesce(*[F.nullif(c, F.lit("")) for c in pick("place")], F.lit("Unknown"))
        .alias("place"),
        F.coalesce(*[c.cast(kind) for c in times], now).alias("time"),
    )


def field_types(df: DataFrame) -> DataFrame:
    """Per column: the map client's field kind (real / boolean / string)."""
    spark = df.sparkSession

    def kind(t):
        if isinstance(t, T.NumericType):
            return "real"
        if isinstance(t, T.BooleanType):
            return "boolean"
        return "string"
    rows = [(f.name, kind(f.dataType), f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "name string, kind string, spark_type string")


def time_slices(df: DataFrame, time: str, minutes: int = 15,
                align: str = "hour", start_name: str = "slice_start",
                end_name: str = "slice_end") -> DataFrame:
    """Half-open ``[start, end)`` slices of ``minutes`` covering the span of
    ``time`` in ``df``, starting at the first event rounded down to ``align``.
    The slice table grows with the time span only."""
    step = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    # date_trunc yields a zoned timestamp; cast back so the slices keep the
    # column's own type (timestamp or timestamp_ntz).
    kind = df.schema[time].dataType
    bounds = df.agg(F.date_trunc(align, F.min(time)).cast(kind).alias("__lo"),
                    F.max(time).alias("__hi"))
    return (bounds.select(F.explode(F.sequence("__lo", "__hi", step)).alias(start_name))
                  .withColumn(end_name, F.col(start_name) + step))


def replay_counts(df: DataFrame, slices: DataFrame, time: str, minutes: int = 15,
                  start_name: str = "slice_start", count_name: str = "num_events") -> DataFrame:
    """Events per slice, empty slices kept. Slices are aligned to the minute
    grid, so an event's slice is computed, then joined by equality."""
    per = (df.withColumn(start_name, F.window(time, f"{int(minutes)} minutes").start)
             .groupBy(start_name).agg(F.count(F.lit(1)).alias(count_name)))
    return (slices.join(per, start_name, "left")
                  .withColumn(count_name, F.coalesce(F.col(count_name), F.lit(0).cast("long"))))
