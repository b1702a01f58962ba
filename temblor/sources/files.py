"""File and catalog sources."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW_TRACE


def read_raw_csv(spark: SparkSession, path: str, schema=RAW_TRACE,
                 multiline: bool = True) -> DataFrame:
    """Raw trace CSV with header and quoted multi-line fields, declared schema.

    ``multiLine`` makes each file one split, so land it once as Parquet
    (``land_raw``) and query that."""
    return (spark.read.schema(schema).option("header", True)
            .option("multiLine", multiline).option("mode", "PERMISSIVE").csv(path))


def land_raw(spark: SparkSession, src: str, dst: str, schema=RAW_TRACE,
             partition_by: list[str] | None = None) -> DataFrame:
    """Read the raw CSV once and write it as Parquet (replacing ``dst``)."""
    w = read_raw_csv(spark, src, schema).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(dst)
    return spark.read.parquet(dst)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def input_tag(spark: SparkSession, paths: list[str], *parameters) -> str:
    """Identity of some inputs: every file's path, size and time, and the
    parameters. (A folder's own length and time say nothing in many stores.)"""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    digest = hashlib.sha1(repr(parameters).encode())
    for path in paths:
        at = hadoop.Path(path)
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
        found = []
        while files.hasNext():
            st = files.next()
            found.append(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()}")
        digest.update("\n".join(sorted(found)).encode())
    return digest.hexdigest()[:16]


_SCHEMAS: dict[tuple, object] = {}


def read_parquet_cached(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet, inferring the schema of a local file once (keyed by path,
    size and modification time) and passing it explicitly afterwards, as a
    catalog would, so repeated reads skip footer inference. Folders and other
    stores are inferred each time: their own size and time tell nothing."""
    try:
        if os.path.isdir(path):
            return spark.read.parquet(path)
        st = os.stat(path)
        key = (path, st.st_size, st.st_mtime_ns)
    except OSError:  # not a local path: let Spark infer each time
        return spark.read.parquet(path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def list_tables(spark: SparkSession, database: str = "default") -> DataFrame:
    """``SHOW TABLES IN database`` as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN `{database}`")


def preview(spark: SparkSession, name: str, n: int = 5) -> DataFrame | None:
    """First ``n`` rows of a table, or None when the table does not exist."""
    if not spark.catalog.tableExists(name):
        return None
    return spark.table(name).limit(n)


def raw_history(spark: SparkSession, path_or_table: str, internal=("_id",)) -> DataFrame:
    """All archived raw events without internal bookkeeping columns."""
    is_table = "/" not in path_or_table and spark.catalog.tableExists(path_or_table)
    df = spark.table(path_or_table) if is_table else spark.read.parquet(path_or_table)
    return df.drop(*[c for c in internal if c in df.columns])
