"""Scoring a live event stream with a fitted pipeline and writing alerts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import threshold_flag
from ..functions.timefn import epoch_ms_to_ts
from ..schemas import SCORE
from ..sources.feed import decode
from ..sources.sinks import run_id

# Fixed value: predicted magnitude at or above which an alert row is written.
ALERT_THRESHOLD = 4.0

MODEL_COLUMNS = {"depth": "source_depth_km", "gap": "source_gap_deg",
                 "latitude": "source_latitude", "longitude": "source_longitude"}

PREDICTION_COLUMNS = ["id", "magnitude", "prediction", "error_abs", "error_squared", "alert",
                      "source_latitude", "source_longitude", "source_depth_km",
                      "source_gap_deg", "place", "time"]


def prepare_scoring_input(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message payloads -> model input columns (epoch ms -> timestamp)."""
    df = decode(messages, SCORE, value, time_fields=())
    df = df.withColumn("time", epoch_ms_to_ts("time"))
    return df.withColumnsRenamed(MODEL_COLUMNS)


def score(model: PipelineModel, df: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Model prediction, alert flag (``prediction >= threshold``) and error columns.

    Rows the assembler cannot use (a null feature) are skipped by the model;
    ``skipped_rows`` returns them so they are counted, not lost silently."""
    return score_columns(model.transform(df), threshold).select(*PREDICTION_COLUMNS)


def score_columns(predicted: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Add alert flag and error columns to rows with a ``prediction``."""
    off = F.col("prediction") - F.col("magnitude")
    return predicted.withColumns({"alert": threshold_flag("prediction", threshold),
                                  "error_abs": F.abs(off), "error_squared": F.pow(off, 2)})


def skipped_rows(df: DataFrame) -> DataFrame:
    """Input rows with a null model feature (the assembler drops them)."""
    cond = None
    for c in MODEL_COLUMNS.values():
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    return df.filter(cond)


def alert_messages(scored: DataFrame) -> DataFrame:
    """Alert rows with a subject and a body of ``name=value`` lines made from
    the row's own columns (delivery is not done here)."""
    a = scored.filter(F.col("alert"))
    a = a if "time" in a.columns else a.withColumn("time", F.lit(None).cast("timestamp"))
    shown = ["magnitude", "place", "source_latitude", "source_longitude", "source_depth_km",
             "time"]
    lines = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("n/a")))
             for c in shown]
    subject = F.format_string("M %.1f expected near %s", F.col("prediction"),
                              F.coalesce(F.col("place"), F.lit("an unnamed place")))
    return a.select("id", "prediction", "magnitude", "place", "time", subject.alias("subject"),
                    F.concat_ws("\n", *lines).alias("body"))


def scoring_batch(model: PipelineModel, predictions_path: str, alerts_path: str,
                  skipped_path: str | None = None, threshold: float = ALERT_THRESHOLD):
    """``foreachBatch`` fan-out over one input micro-batch: score it, store
    predictions and rendered alerts, and route rows the model cannot use (a
    null feature) to ``skipped_path`` instead of dropping them silently.

    The input batch is persisted once for all writes. Every write replaces
    only the partition of this run (checkpoint) and epoch, so a replayed epoch
    overwrites instead of duplicating and a fresh checkpoint adds to what is
    there; write errors raise, so the epoch is replayed from the checkpoint
    rather than lost."""
    def _write(df: DataFrame, path: str, epoch_id: int) -> None:
        (df.withColumns({"run_id": F.lit(run_id(df.sparkSession)),
                         "epoch_id": F.lit(epoch_id).cast("long")})
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("run_id", "epoch_id").parquet(path))

    def _fn(batch: DataFrame, epoch_id: int) -> None:
        b = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            scored = score(model, b, threshold).persist(StorageLevel.MEMORY_AND_DISK)
            _write(scored, predictions_path, epoch_id)
            _write(alert_messages(scored), alerts_path, epoch_id)
            if skipped_path:
                _write(skipped_rows(b), skipped_path, epoch_id)
            scored.unpersist()
        finally:
            b.unpersist()
    return _fn
