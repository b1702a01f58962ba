"""Questions over the functions and sources that the ten questions do not reach:
mechanism text, epoch times, raw landing and history, the map client's newest
points, and the rows that training and scoring see (with a formula in place of
the model, so that SQL can repeat them)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import split_triplet
from ..functions.timefn import epoch_ms_to_ts, ts_to_epoch_ms
from ..model import forest as m
from ..operators.feed import field_types, map_feed
from ..operators.topk import latest_n
from ..session import scratch_path
from ..sources.feed import publish_json
from ..sources.files import land_raw, list_tables, preview, raw_history, read_table
from ..sources.sinks import counted, write_curated
from ..streaming.archive import archive_rows
from ..streaming.scoring import MODEL_COLUMNS, alert_messages, score_columns, skipped_rows
from .driver import QUAKES_SQL, quakes_view, table
from .traces import TRACES_SQL, cleaned_traces, traces_from_events


# ------------------------------------------------------------ mechanism, times
def mechanism_split(spark, sf_dir):
    """Strike, dip and rake from bracketed text with uneven blanks and gaps."""
    i = F.col("event_id")
    text = (F.when(i % 11 == 0, F.lit(None)).when(i % 11 == 1, F.lit("None"))
            .otherwise(F.concat(F.lit("[[ "), (i % 360).cast("string"), F.lit(".5   "),
                                (i % 90).cast("string"), F.when(i % 3 == 0, F.lit(" ]]")).otherwise(
                                    F.concat(F.lit(".25  -"), (i % 180).cast("string"),
                                             F.lit(".0]]"))))))
    ev = table(spark, sf_dir, "events").select("event_id", text.alias("mechanism"))
    return ev.select("event_id", *split_triplet("mechanism", to="double"))


C8_SQL = """
SELECT event_id,
       CASE WHEN event_id % 11 > 1 THEN CAST(event_id % 360 AS DOUBLE) + 0.5 END AS strike,
       CASE WHEN event_id % 11 > 1 THEN CAST(event_id % 90 AS DOUBLE)
            + CASE WHEN event_id % 3 = 0 THEN 0 ELSE 0.25 END END AS dip,
       CASE WHEN event_id % 11 > 1 AND event_id % 3 <> 0
            THEN CAST(-(event_id % 180) AS DOUBLE) END AS rake
FROM events"""


def epoch_times(spark, sf_dir):
    """Wall-clock times to epoch milliseconds and back to a time."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    ms = ev.withColumn("epoch_ms", ts_to_epoch_ms("ts", ntz=True))
    back = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP'1970-01-01 00:00:00Z'"),
                            epoch_ms_to_ts("epoch_ms"))
    return ms.select("event_id", "epoch_ms", back.alias("epoch_us"))


C16_SQL = """
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, epoch_us(ts) // 1000 * 1000 AS epoch_us
FROM events"""


# ------------------------------------------------------------- landing, history
def csv_landing(spark, sf_dir):
    """Raw traces written as CSV, then read with the declared schema and landed."""
    src = scratch_path(spark, "landed", "raw-csv")
    traces_from_events(table(spark, sf_dir, "events")).write.option("header", True).csv(src)
    landed = land_raw(spark, src, scratch_path(spark, "landed", "raw-zone"))
    return landed.select("network_code", "source_id", "source_error_sec", "source_gap_deg",
                         "source_depth_km", "source_magnitude", "source_distance_km",
                         "p_travel_sec", "receiver_latitude")


A1_SQL = f"""
WITH {TRACES_SQL}
SELECT network_code, source_id, source_error_sec, source_gap_deg, source_depth_km,
       source_magnitude, source_distance_km, p_travel_sec, receiver_latitude FROM raw"""


def raw_history_rows(spark, sf_dir):
    """Archived messages (raw text, by day) read back without bookkeeping columns."""
    q = quakes_view(spark, sf_dir)
    messages = publish_json(q.select(F.col("id").cast("string").alias("id"), "magnitude",
                                     ts_to_epoch_ms("time", ntz=True).alias("time"), "net"))
    path = scratch_path(spark, "landed", "archive")
    archive_rows(messages).write.partitionBy("day").parquet(path)
    history = raw_history(spark, path, internal=("_id", "day"))
    whole = F.get_json_object("raw", "$.id") == F.col("id")
    return history.select("id", "magnitude", "time", "net", whole.alias("raw_kept"))


A8_SQL = f"""
WITH {QUAKES_SQL}
SELECT CAST(id AS VARCHAR) AS id, magnitude, epoch_us(time) // 1000 AS time, net,
       TRUE AS raw_kept FROM quakes"""


# ----------------------------------------------------------- catalog and counts
def catalog_round_trip(spark, sf_dir):
    """A managed table written, found in the catalog, previewed, read back, and
    its fields as the map client sees them; the table is dropped again."""
    q = quakes_view(spark, sf_dir).select("id", "time", "magnitude", "net", "latitude",
                                          (F.col("magnitude") > 3).alias("strong"))
    name = f"temblor_round_trip_{uuid.uuid4().hex[:12]}"
    missing = preview(spark, name) is None
    write_curated(q, name, target="table")
    try:
        listed = list_tables(spark).where(F.col("tableName") == name).count()
        shown = preview(spark, name, 5).count()
        rows = read_table(spark, name).count()
        fields = field_types(read_table(spark, name))
    finally:
        spark.sql(f"DROP TABLE {name}")
    return fields.withColumns({
        "missing_before": F.lit(missing), "listed": F.lit(listed).cast("long"),
        "shown": F.lit(shown).cast("long"), "num_rows": F.lit(rows).cast("long")})


CATALOG_SQL = """
SELECT name, kind, spark_type, true AS missing_before, CAST(1 AS BIGINT) AS listed,
       (SELECT least(count(*), 5) FROM events) AS shown, (SELECT count(*) FROM events) AS num_rows
FROM (VALUES ('id', 'real', 'bigint'), ('time', 'string', 'timestamp_ntz'),
             ('magnitude', 'real', 'double'), ('net', 'string', 'string'),
             ('latitude', 'real', 'double'), ('strong', 'boolean', 'boolean'))
     AS t(name, kind, spark_type)"""


def observed_counts(spark, sf_dir):
    """Rows counted while a table is written, beside the counts of what was read
    and of what came to lie there."""
    out = []
    for name in ("events", "orders", "customer"):
        df = table(spark, sf_dir, name)
        seen, observation = counted(df, "n")
        path = scratch_path(spark, "landed", f"counted-{name}")
        write_curated(seen, name, path=path)
        out.append((name, observation.get["n"], spark.read.parquet(path).count(), df.count()))
    return spark.createDataFrame(out, "table_name string, observed long, stored long, read long")


COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS observed, count(*) AS stored, count(*) AS read "
    f"FROM {t}" for t in ("events", "orders", "customer"))


# ------------------------------------------------------------------ map client
def latest_map_points(spark, sf_dir):
    """The newest thousand nested features as map points."""
    q = latest_n(quakes_view(spark, sf_dir), "time", "id", 1000)
    features = q.select(
        F.struct(F.col("magnitude").alias("mag"),
                 F.when(F.col("id") % 4 == 0, F.lit("")).otherwise(F.col("net")).alias("place"),
                 ts_to_epoch_ms("time", ntz=True).alias("time")).alias("properties"),
        F.struct(F.array("longitude", "latitude", F.when(F.col("id") % 5 != 0, F.col("depth")))
                 .alias("coordinates")).alias("geometry"))
    return map_feed(features)


R2_SQL = f"""
WITH {QUAKES_SQL},
n AS (SELECT * FROM quakes ORDER BY time DESC, id DESC LIMIT 1000)
SELECT latitude, longitude, magnitude, CASE WHEN id % 5 <> 0 THEN depth ELSE 0.0 END AS depth,
       CASE WHEN id % 4 = 0 THEN 'Unknown' ELSE net END AS place,
       epoch_us(time) // 1000 AS time
FROM n"""


# ---------------------------------------------------------- training and scoring
def model_training_rows(spark, sf_dir):
    """Gated numbers, rows with a null dropped, and the part each row is in."""
    rows = m.prepare(cleaned_traces(spark, sf_dir), keep=["source_id"])
    key = F.col("source_id").cast("long")
    return rows.select("source_id", *m.FEATURES, m.LABEL,
                       m.part_of(key % 10, 8).alias("part"))


TRAINING_SQL = f"""
WITH {TRACES_SQL}
SELECT source_id, depth_num AS source_depth_km, gap_num AS source_gap_deg, source_latitude,
       source_longitude, source_magnitude,
       CASE WHEN CAST(source_id AS BIGINT) % 10 < 8 THEN 'train' ELSE 'test' END AS part
FROM t WHERE depth_num IS NOT NULL AND gap_num IS NOT NULL AND source_latitude IS NOT NULL
  AND source_longitude IS NOT NULL AND source_magnitude IS NOT NULL"""


def _formula_rows(spark, sf_dir) -> DataFrame:
    """Scoring input with gaps, and a prediction on both sides of 4 and on it."""
    i = F.col("id")
    return (quakes_view(spark, sf_dir).withColumns({
        "prediction": (i % 17).cast("double") / 2, "place": F.when(i % 6 != 0, F.col("net")),
        "magnitude": F.when(i % 8 != 0, F.col("magnitude")),
        "gap": F.when(i % 9 != 0, F.col("gap")), "depth": F.when(i % 7 != 0, F.col("depth")),
    }).withColumnsRenamed(MODEL_COLUMNS))


FORMULA_SQL = f"""{QUAKES_SQL},
f AS (SELECT id, CAST(id % 17 AS DOUBLE) / 2 AS prediction,
             CASE WHEN id % 6 <> 0 THEN net END AS place,
             CASE WHEN id % 8 <> 0 THEN magnitude END AS magnitude,
             CASE WHEN id % 9 <> 0 THEN gap END AS source_gap_deg,
             CASE WHEN id % 7 <> 0 THEN depth END AS source_depth_km,
             latitude AS source_latitude, longitude AS source_longitude FROM quakes)"""


def scored_columns(spark, sf_dir):
    """Alert flag and error columns of a given prediction."""
    out = score_columns(_formula_rows(spark, sf_dir))
    return out.select("id", "prediction", "magnitude", "alert",
                      F.round("error_abs", 6).alias("error_abs"),
                      F.round("error_squared", 6).alias("error_squared"), "source_gap_deg",
                      "source_depth_km", "place")


SCORED_SQL = f"""
WITH {FORMULA_SQL}
SELECT id, prediction, magnitude, prediction >= 4 AS alert,
       round(abs(prediction - magnitude), 6) AS error_abs,
       round(pow(prediction - magnitude, 2), 6) AS error_squared, source_gap_deg,
       source_depth_km, place FROM f"""


def alert_rows(spark, sf_dir):
    """Rendered alerts of the rows at or above the threshold."""
    out = alert_messages(score_columns(_formula_rows(spark, sf_dir)))
    return out.select("id", "prediction", "magnitude", "place", "subject")


ALERT_SQL = f"""
WITH {FORMULA_SQL}
SELECT id, prediction, magnitude, place,
       'M ' || CAST(CAST(prediction AS DECIMAL(9,1)) AS VARCHAR) || ' expected near '
         || coalesce(place, 'an unnamed place') AS subject
FROM f WHERE prediction >= 4"""


def unscored_rows(spark, sf_dir):
    """Rows that the model cannot use, which scoring keeps apart."""
    return skipped_rows(_formula_rows(spark, sf_dir)).select("id", "source_gap_deg",
                                                             "source_depth_km")


UNSCORED_SQL = f"""
WITH {FORMULA_SQL}
SELECT id, source_gap_deg, source_depth_km FROM f
WHERE source_gap_deg IS NULL OR source_depth_km IS NULL OR source_latitude IS NULL
   OR source_longitude IS NULL"""


QUERIES = {
    "mechanism_split": mechanism_split,
    "epoch_times": epoch_times,
    "csv_landing": csv_landing,
    "raw_history_rows": raw_history_rows,
    "catalog_round_trip": catalog_round_trip,
    "observed_counts": observed_counts,
    "latest_map_points": latest_map_points,
    "model_training_rows": model_training_rows,
    "scored_columns": scored_columns,
    "alert_rows": alert_rows,
    "unscored_rows": unscored_rows,
}

ORACLE_SQL = {
    "mechanism_split": C8_SQL,
    "epoch_times": C16_SQL,
    "csv_landing": A1_SQL,
    "raw_history_rows": A8_SQL,
    "catalog_round_trip": CATALOG_SQL,
    "observed_counts": COUNTS_SQL,
    "latest_map_points": R2_SQL,
    "model_training_rows": TRAINING_SQL,
    "scored_columns": SCORED_SQL,
    "alert_rows": ALERT_SQL,
    "unscored_rows": UNSCORED_SQL,
}
