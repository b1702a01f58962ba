"""Late rows kept in a side table instead of being dropped silently."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.files import path_exists

COUNTS = "epoch_id long, num_rows long, num_late long, newest_us long"


def split_late(root: str, time: str, delay: dt.timedelta):
    """``foreachBatch`` function for a stateless stream: rows earlier than the
    newest time of all batches before, minus ``delay`` (what a stateful query
    with that watermark would drop), go to ``late=true``, the others to
    ``late=false``; a row without a time is late.

    Both parts are one write, partitioned by epoch and replaced as a whole when
    an epoch is replayed; its counts are observed in passing and written as the
    epoch's row of ``counts``, with the newest time up to it
    (``newest_us``, epoch microseconds)."""
    def _fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        before = f"{root}/counts/epoch_id={epoch_id - 1}"
        newest = (spark.read.parquet(before).first()["newest_us"]
                  if path_exists(spark, before) else None)
        late = F.col(time).isNull()
        if newest is not None:
            late = late | (F.unix_micros(time) < newest - delay // dt.timedelta(microseconds=1))
        seen = Observation(f"late-{epoch_id}")
        (batch.withColumns({"late": late, "epoch_id": F.lit(epoch_id).cast("long")})
         .observe(seen, F.count(F.lit(1)).alias("num_rows"),
                  F.count_if("late").alias("num_late"), F.max(F.unix_micros(time)).alias("newest"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("late", "epoch_id").parquet(f"{root}/rows"))
        got = seen.get
        times = [t for t in (newest, got["newest"]) if t is not None]
        (spark.createDataFrame([(epoch_id, got["num_rows"], got["num_late"],
                                 max(times, default=None))], COUNTS)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch_id").parquet(f"{root}/counts"))
    return _fn


def read_rows(spark, root: str, late: bool) -> DataFrame:
    """The rows kept, or the late ones."""
    return spark.read.parquet(f"{root}/rows").where(F.col("late") == late).drop("late")


def read_counts(spark, root: str) -> DataFrame:
    """``epoch_id``, ``num_rows``, ``num_late``, ``newest_us`` of each micro-batch."""
    return spark.read.parquet(f"{root}/counts")
