"""JSON event payloads: decode, publish, and GeoJSON FeatureCollections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.timefn import epoch_ms_to_ts, ts_to_epoch_ms
from ..schemas import EVENT, GEOJSON_FEATURE_COLLECTION, GEOJSON_PASSTHROUGH


def decode(df: DataFrame, schema: StructType = EVENT, value: str = "value",
           time_fields=("time",), keep_raw: bool = False) -> DataFrame:
    """Message bytes/text -> typed columns. Malformed JSON gives a row of nulls
    (permissive ``from_json``); ``time_fields`` hold epoch milliseconds and get
    a ``<name>_ts`` timestamp next to them."""
    text = F.col(value).cast("string")
    out = df.select(*([text.alias("raw")] if keep_raw else []),
                    F.from_json(text, schema).alias("data")).select(
        *(["raw"] if keep_raw else []), "data.*")
    for f in time_fields:
        if f in out.columns:
            out = out.withColumn(f"{f}_ts", epoch_ms_to_ts(f))
    return out


def publish_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows -> ``value`` JSON text with explicit nulls (and an optional key),
    the shape a topic sink expects."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    cols = [value.alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def to_feature_collections(events: DataFrame, id_col: str = "id",
                           per_collection: int = 100) -> DataFrame:
    """Flat event rows -> GeoJSON FeatureCollection text, at most
    ``per_collection`` features per document (bounded by construction: the
    collection key is ``floor(id / per_collection)``)."""
    props = {
        "mag": F.col("magnitude"), "place": F.col("place") if "place" in events.columns
        else F.lit(None).cast("string"),
        "time": ts_to_epoch_ms("time", ntz=dict(events.dtypes).get("time") == "timestamp_ntz"),
        "net": F.col("net"), "nst": F.col("nst").cast("int"), "gap": F.col("gap"),
    }
    feature = F.struct(
        F.col(id_col).cast("string").alias("id"),
        F.struct(*[v.alias(k) for k, v in props.items()]).alias("properties"),
        F.struct(F.array("longitude", "latitude", "depth").alias("coordinates")).alias("geometry"),
    )
    return (events.withColumn("__doc", F.floor(F.col(id_col) / per_collection))
                  .groupBy("__doc").agg(F.collect_list(feature).alias("features"))
                  .select(F.to_json(F.struct("features")).alias("value")))


def flatten_geojson(df: DataFrame, value: str = "value") -> DataFrame:
    """FeatureCollection text -> one flat event row per feature: pass-through
    properties, ``mag`` -> magnitude, coordinates [lon, lat, depth]."""
    parsed = df.select(F.from_json(F.col(value).cast("string"),
                                   GEOJSON_FEATURE_COLLECTION).alias("fc"))
    feats = parsed.select(F.explode("fc.features").alias("f"))
    coords = F.col("f.geometry.coordinates")
    return feats.select(
        F.col("f.id").alias("id"), F.col("f.properties.mag").alias("magnitude"),
        *[F.col(f"f.properties.{p}").alias(p) for p in GEOJSON_PASSTHROUGH],
        F.get(coords, 1).alias("latitude"), F.get(coords, 0).alias("longitude"),
        F.get(coords, 2).alias("depth"))
