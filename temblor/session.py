"""Session defaults and the shared scratch location.

Everything the library writes outside a caller-named sink (stream checkpoints,
lineage cuts, model cache) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (a laptop or a test)
and only on a local master do we create one, so cluster runs never touch
machine-local temporary space.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast decisions from measured sizes only: the planner's file-size
    # estimate (blind to explode/filter selectivity) never broadcasts; AQE
    # broadcasts a side once its materialised size is known to be small.
    # Explicit broadcasts in the library are size-checked or proven.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "temblor",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        # Unset: only a local run, where driver and executors share one disk,
        # may pick a folder by itself.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors "
                               "share")
        conf_dir = tempfile.mkdtemp(prefix="temblor-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def land(df, name: str):
    """Write ``df`` below the shared checkpoint folder and read it back: what
    several passes need is computed once and outlives lost executors."""
    path = scratch_path(df.sparkSession, "landed", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder (optionally made unique)."""
    root = ensure_checkpoint_dir(spark)
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return os.path.join(root, *leaf) if "://" not in root else "/".join([root.rstrip("/"), *leaf])
