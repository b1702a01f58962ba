"""Raw archive: every message stored unchanged, plus the decoded fields; finished
days are folded into few sorted files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT
from ..sources.feed import decode
from ..sources.sinks import run_id

BATCH = ["day", "run_id", "epoch_id"]


def archive_rows(messages: DataFrame, value: str = "value") -> DataFrame:
    """Raw text, decoded fields and the day (partition column) of each message."""
    d = decode(messages, EVENT, value, keep_raw=True)
    return d.withColumn("day", F.to_date("time_ts"))


def archive_batch(root: str):
    """``foreachBatch`` function that stores ``archive_rows`` by day and
    micro-batch; a replayed epoch replaces its own partitions."""
    def _fn(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumns({"run_id": F.lit(run_id(batch.sparkSession)),
                            "epoch_id": F.lit(epoch_id).cast("long")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*BATCH).parquet(root))
    return _fn


def _read(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows below ``root``, None if it has no day (any more)."""
    if not _has_days(spark, root):
        return None
    return spark.read.parquet(root).withColumns({
        "run_id": F.col("run_id").cast("string"), "epoch_id": F.col("epoch_id").cast("long")})


def _not_in(rows: DataFrame, folded: DataFrame | None) -> DataFrame:
    """Rows of micro-batches that the folded days do not hold yet."""
    if folded is None:
        return rows
    there = folded.select(*[F.col(c).alias(f"__{c}") for c in BATCH]).distinct()
    same = [F.col(c) == F.col(f"__{c}") for c in BATCH]
    return rows.join(there, same[0] & same[1] & same[2], "left_anti")


def fold_days(spark: SparkSession, root: str, folded: str, before: dt.date,
              order: tuple[str, ...] = ("time_ts", "id"), rows_per_file: int = 1_000_000) -> int:
    """Fold the micro-batch files of the days before ``before`` into files sorted
    by ``order`` below ``folded`` (one partition a day), then remove what was
    folded from ``root``. Returns the number of days.

    Each folded row keeps the batch it came from. A fold that was broken off, or
    is run again, thus adds no row twice; messages that arrive for a day after
    it was folded are added by the next fold. Only days with files in ``root``
    are read and rewritten."""
    raw = _read(spark, root)
    if raw is None:
        return 0
    due = raw.where(F.col("day") < F.lit(before))
    batches = due.select(*BATCH).distinct().collect()  # partitions, not rows
    days = sorted({r["day"] for r in batches})
    if not days:
        return 0
    old = _read(spark, folded)
    old = None if old is None else old.where(F.col("day").isin(days))
    rows = _not_in(due.where(F.col("day").isin(days)), old)
    if old is not None:
        rows = rows.unionByName(old)
    files = -(-rows.count() // rows_per_file)
    (rows.repartitionByRange(max(1, files), "day", *order)
     .sortWithinPartitions("day", *order).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(folded))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in batches:
        fs.delete(hadoop.Path(at, "/".join(f"{c}={r[c]}" for c in BATCH)), True)
    for d in days:
        gone = hadoop.Path(at, f"day={d}")
        if not fs.listFiles(gone, True).hasNext():
            fs.delete(gone, True)
    return len(days)


def archive_history(spark: SparkSession, root: str, folded: str) -> DataFrame:
    """All archived messages: folded days, and micro-batches not folded yet."""
    done = _read(spark, folded)
    rest = _read(spark, root)
    if done is None or rest is None:
        return (done if rest is None else rest).drop("run_id", "epoch_id")
    return _not_in(rest, done).unionByName(done).drop("run_id", "epoch_id")


def _has_days(spark: SparkSession, root: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(at) and any(s.getPath().getName().startswith("day=")
                                 for s in fs.listStatus(at))
