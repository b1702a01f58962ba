"""End-to-end jobs: the batch job, the metrics stream, training, scoring, table check.

These wire the operators together the way a deployment runs them; every
location (raw file, tables, checkpoints, model) is a parameter, and every
connection setting is passed in by the caller.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import forest
from ..operators.pairs import proximity_pairs
from ..operators.windowed import feed_status, window_metrics
from ..schemas import EVENT
from ..sources.feed import decode
from ..sources.files import land_raw, list_tables, preview
from ..sources.sinks import write_curated
from ..streaming.runner import start_append, start_fan_out, start_upsert
from ..streaming.scoring import prepare_scoring_input, scoring_batch
from . import seismic

log = logging.getLogger("temblor")

CLEANED_TABLE = "preprocessed_earthquakes"


# ------------------------------------------------------------------ batch job
def run_batch(spark: SparkSession, raw_csv: str, raw_zone: str, target: str = "table",
              out_root: str | None = None, jdbc: dict | None = None,
              cleaned_table: str = CLEANED_TABLE, as_of=None,
              split_mechanism: bool = False, only: list[str] | None = None) -> dict[str, str]:
    """Raw CSV -> Parquet landing -> cleaned table -> the ten curated tables.

    The CSV is multi-line (one split per file), so it is read once and landed
    as Parquet; the cleaned table is written once and every question reads
    it with its own column pruning and filter pushdown."""
    landed = land_raw(spark, raw_csv, raw_zone)
    cleaned = seismic.preprocess(landed, split_mechanism=split_mechanism)
    cleaned.write.mode("overwrite").saveAsTable(cleaned_table)
    q = spark.table(cleaned_table)
    written = {}
    for name, fn in seismic.CURATED.items():
        if only and name not in only:
            continue
        kwargs = {"as_of": as_of} if name in ("BiggestEarthquakesIn30Years",
                                              "AverageMagnitudeTrendIn10Years") else {}
        result = fn(q, **kwargs)
        path = f"{out_root.rstrip('/')}/{name}" if out_root else None
        write_curated(result, name, target=target, path=path, jdbc=jdbc)
        written[name] = path or name
        log.info("wrote %s", name)
    return written


# -------------------------------------------------------------- metrics stream
def events_from_messages(messages: DataFrame, watermark: str | None = None) -> DataFrame:
    """Topic messages -> typed events with a real event-time column."""
    ev = decode(messages, EVENT).withColumn("time", F.col("time_ts")).drop("time_ts")
    return ev.withWatermark("time", watermark) if watermark else ev


# Result stores of the metrics: window length in minutes, and columns. Fixed
# values: the names are those that existing readers of the stores ask for.
METRIC_STORES = {
    "avgMagnitude": (30, ["window_end", "avg_magnitude"]),
    "totalEnergy": (30, ["window_end", "total_energy"]),
    "numberOfEarthquakesTrend": (30, ["window_end", "num_events as num_earthquakes", "trend"]),
    "shallowEarthquakesPercentage": (30, ["window_end", "percent_shallow"]),
    "averageNst": (30, ["window_end", "average_nst"]),
    "strongEarthquakesPerHour": (60, ["window_end", "num_events as num_earthquakes_mag_gt3"]),
    "numberOfEarthquakesNearLA": (120, ["window_end", "num_events as count"]),
}


def start_metrics(messages: DataFrame, out_root: str, checkpoint_root: str,
                  trigger: str | None = "60 seconds", watermark: str | None = "2 hours",
                  pairs_window: str = "60 minutes",
                  names: list[str] | None = None) -> list[StreamingQuery]:
    """Start the metrics of one source: all windowed ones (S0-S6) as a single
    query with one read and one state store that fans out to their stores, the
    feed status (complete mode) and the close-pairs alert stream (append)."""
    started = []
    wanted = {f"{out_root}/{n}": (F.col("minutes") == minutes, [F.expr(c) for c in columns])
              for n, (minutes, columns) in METRIC_STORES.items() if not names or n in names}
    if wanted:
        metrics = window_metrics(events_from_messages(messages), watermark=watermark)
        started.append(start_fan_out(metrics, wanted, ["window_start"],
                                     f"{checkpoint_root}/windowMetrics", trigger,
                                     "windowMetrics"))
    if not names or "feedStatus" in names:
        # one row, complete mode: the store is replaced by each batch's result
        status = feed_status(events_from_messages(messages))
        started.append(start_upsert(status, f"{out_root}/feedStatus", [],
                                    f"{checkpoint_root}/feedStatus", mode="complete",
                                    trigger=trigger, name="feedStatus"))
    if not names or "closePairs" in names:
        raw = events_from_messages(messages, None)
        pairs = proximity_pairs(raw, length=pairs_window, watermark=watermark or "2 hours")
        pairs = pairs.withColumn("window_start", F.col("window.start")).drop("window")
        started.append(start_append(pairs, f"{out_root}/closePairs",
                                    f"{checkpoint_root}/closePairs", trigger=trigger,
                                    name="closePairs"))
    return started


# -------------------------------------------------------------------- training
def run_training(spark: SparkSession, cleaned: DataFrame, model_path: str,
                 num_trees: int = 100, max_depth: int = 10, seed: int = 42,
                 split_key: str | None = "source_id", pattern: str | None = None) -> dict:
    """Prepare, split, fit, evaluate and save; returns metrics and importances."""
    keep = [split_key] if split_key else []
    kw = {"pattern": pattern} if pattern else {}
    rows = forest.prepare(cleaned, keep=keep, **kw)
    train_df, test_df = forest.split(rows, 0.8, seed, key=split_key)
    model = forest.train(train_df, num_trees=num_trees, max_depth=max_depth, seed=seed)
    metrics = forest.evaluate(model, test_df).first().asDict()
    imp = [r.asDict() for r in forest.importances(model).collect()]
    forest.save(model, model_path)
    return {"metrics": metrics, "importances": imp, "model_path": model_path}


# --------------------------------------------------------------------- scoring
def start_scoring(spark: SparkSession, messages: DataFrame, model_path: str, out_root: str,
                  checkpoint: str, trigger: str | None = "30 seconds") -> StreamingQuery:
    """Score the live stream; predictions, rendered alerts and rows the model
    could not use go to tables."""
    model = forest.load(model_path)
    rows = prepare_scoring_input(messages)
    return (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(scoring_batch(model, f"{out_root}/realtimePredictions",
                                        f"{out_root}/alerts", f"{out_root}/skipped"))
            .trigger(processingTime=trigger).start())


# ------------------------------------------------------------------ table check
def check_tables(spark: SparkSession, database: str = "default",
                 table: str = CLEANED_TABLE, n: int = 5) -> dict:
    """Tables in a database and the first rows of one table (None if missing)."""
    names = [r.tableName for r in list_tables(spark, database).collect()]
    head = preview(spark, f"{database}.{table}", n)
    rows = [json.loads(j) for j in head.toJSON().collect()] if head is not None else None
    return {"tables": names, "preview": rows}

