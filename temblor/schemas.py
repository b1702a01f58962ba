"""Declared schemas. Nothing is inferred: every source reads with one of these."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, FloatType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampType)


def _struct(fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, F32, F64, I32, I64, TS = (StringType(), FloatType(), DoubleType(), IntegerType(),
                             LongType(), TimestampType())

# Raw trace table (station x event), CSV with header and multi-line quoted fields.
# Columns that hold a number or the text None/nan are strings on purpose.
# Names and types of the wire or file layout.
RAW_TRACE = _struct([
    ("network_code", S), ("receiver_code", S), ("receiver_type", S),
    ("receiver_latitude", F32), ("receiver_longitude", F32), ("receiver_elevation_m", F32),
    ("p_arrival_sample", F32), ("p_status", S), ("p_weight", F32), ("p_travel_sec", F64),
    ("s_arrival_sample", F32), ("s_status", S), ("s_weight", F32),
    ("source_id", S), ("source_origin_time", TS), ("source_origin_uncertainty_sec", S),
    ("source_latitude", F32), ("source_longitude", F32),
    ("source_error_sec", S), ("source_gap_deg", S), ("source_horizontal_uncertainty_km", S),
    ("source_depth_km", S), ("source_depth_uncertainty_km", S),
    ("source_magnitude", F32), ("source_magnitude_type", S), ("source_magnitude_author", S),
    ("source_mechanism_strike_dip_rake", S),
    ("source_distance_deg", F32), ("source_distance_km", F32), ("back_azimuth_deg", F32),
    ("snr_db", S), ("coda_end_sample", S), ("trace_start_time", TS),
    ("trace_category", S), ("trace_name", S),
])

# Numeric columns normalised to float by the cleaning step (depth stays text).
# Names and types of the wire or file layout.
CLEANED_FLOAT_COLUMNS = [
    "receiver_latitude", "receiver_longitude", "receiver_elevation_m",
    "p_arrival_sample", "p_weight", "p_travel_sec", "s_arrival_sample", "s_weight",
    "source_latitude", "source_longitude",
    "source_magnitude", "source_distance_deg", "source_distance_km", "back_azimuth_deg",
]

# One event message as published on the event topic. ``time``/``updated`` are
# epoch milliseconds; we declare them as long and convert explicitly.
# Names and types of the wire or file layout.
EVENT = _struct([
    ("id", S), ("magnitude", F64), ("place", S), ("time", I64), ("updated", I64),
    ("tz", I32), ("detail", S), ("felt", I32), ("cdi", F64), ("mmi", F64),
    ("alert", S), ("status", S), ("tsunami", I32), ("sig", I32), ("net", S),
    ("code", S), ("ids", S), ("sources", S), ("types", S), ("nst", I32),
    ("dmin", F64), ("rms", F64), ("gap", F64), ("magType", S), ("type", S),
    ("title", S), ("latitude", F64), ("longitude", F64), ("depth", F64),
])

# The eight fields the scoring job reads.
# Names and types of the wire or file layout.
SCORE = _struct([
    ("id", S), ("magnitude", F64), ("place", S), ("time", F64), ("gap", F64),
    ("latitude", F64), ("longitude", F64), ("depth", F64),
])

# Upstream GeoJSON FeatureCollection (as a from_json schema string).
# Names and types of the wire or file layout.
GEOJSON_FEATURE_COLLECTION = (
    "struct<features: array<struct<id: string, properties: struct<"
    "mag: double, place: string, time: bigint, updated: bigint, tz: int, detail: string, "
    "felt: int, cdi: double, mmi: double, alert: string, status: string, tsunami: int, "
    "sig: int, net: string, code: string, ids: string, sources: string, types: string, "
    "nst: int, dmin: double, rms: double, gap: double, magType: string, type: string, "
    "title: string>, geometry: struct<coordinates: array<double>>>>>"
)

# Properties copied unchanged from a feature into the flat event row.
# Names and types of the wire or file layout.
GEOJSON_PASSTHROUGH = [
    "place", "time", "updated", "tz", "detail", "felt", "cdi", "mmi", "alert",
    "status", "tsunami", "sig", "net", "code", "ids", "sources", "types", "nst",
    "dmin", "rms", "gap", "magType", "type", "title",
]
