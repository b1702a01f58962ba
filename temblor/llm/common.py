"""Small helpers shared by the training-data operators.

Nothing here (or anywhere in ``temblor.llm``) keeps data on a machine's own
disk: lineage is cut by writing a table below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space of the word rules ``[^\x20\x09-\x0D]+`` (fixed values).
SPACES = " \t\n\x0b\x0c\r"
WORD_RE = r"[^\x20\x09-\x0D]+"

# Arrow batches are cut by bytes as well as rows, so very long texts cannot
# pile up in one Python worker.
BATCH_BYTES = 4 << 20
ROOT = str(Path(__file__).resolve().parents[2])


def bounded_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Limit the bytes of one Arrow batch, and let Python workers that see the
    driver's folders import this package (elsewhere it is shipped to them, as
    any library, with ``--py-files``)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    # What workers free goes back to the system, for whoever runs beside them.
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    env.setdefault("MALLOC_ARENA_MAX", "2")


# A node with more than a thousandth of all edge ends is a hub.
HUBS = 1000

_HELD: dict = {"key": None, "value": None}


def held(key, build):
    """What ``build`` makes, kept in this worker process until another operator
    (or the same with other parameters) needs the room."""
    if _HELD["key"] != key:
        _HELD.update(key=None, value=None)
        release()
        _HELD.update(key=key, value=build())
        release()
    return _HELD["value"]


def forget() -> None:
    """Drop what another operator has left in this worker process."""
    if _HELD["key"] is not None:
        _HELD.update(key=None, value=None)
        release()


def release() -> None:
    """Give freed memory back to the system, where the C library can."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later
    passes read a fixed table, whatever executors are lost in between."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` (narrow) rows;
    beyond that the join shuffles, and adaptive execution splits hot keys."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def hash_sample(df: DataFrame, n: int, by: str | None, *hashed: str, cut=None) -> DataFrame:
    """At most ``n`` rows (of each value of ``by``, which must have few), in
    the order of a hash of ``hashed``. Counts first and keeps the fraction of
    the hash range that holds about four times ``n`` rows, so neither the
    driver nor one task is sent more than that, whatever the table's size.
    ``cut`` may shorten the columns of those rows before they are sent."""
    group = F.col(by) if by else F.lit(0)
    counts = df.groupBy(group.alias("g")).count().collect()
    share = (F.xxhash64(*hashed).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53))
    limit = F.lit(0.0)
    for r in counts:
        limit = F.when(group.eqNullSafe(F.lit(r["g"])), min(1.0, 4 * n / r["count"])).otherwise(
            limit)
    order = Window.partitionBy("__g").orderBy("__h", *hashed)
    some = df.withColumns({"__g": group, "__h": share}).where(F.col("__h") < limit)
    return ((cut(some) if cut else some)
            .withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n)
            .orderBy("__g", "__n").drop("__g", "__h", "__n"))


def crc32_mod(id_col: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def text_of(col: str) -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def runs(batches: Iterator, keys: list[str]) -> Iterator:
    """Group a sorted partition: yields one pandas frame per run of equal
    ``keys`` (the partition must be sorted by them); holds one run at a time."""
    import pandas as pd
    held: list = []
    current = None
    for pdf in batches:
        if not len(pdf):
            continue
        change = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy().nonzero()[0]
        edges = [*change.tolist(), len(pdf)]
        for a, b in zip(edges, edges[1:]):
            part = pdf.iloc[a:b]
            key = tuple(part[keys].iloc[0])
            if held and key != current:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            current = key
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable id of every node that has an edge.

    Alternating large-star and small-star passes over ``edges`` (two long
    columns; direction, loops and repeats do not matter). Each pass is a
    partial minimum by node and a join on the node. A hub costs one partial row
    per task; its minimum is sent to its neighbours' rows, which are never
    brought into one group. Every pass is written to the shared
    folder; the loop ends when a pass changes nothing. Returns ``node``,
    ``component``; without edges, no row."""
    cur = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v").distinct(), "cc-edges")
    mark = _mark(cur)
    while True:
        both = cur.union(cur.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        low = low.select("u", F.least("u", "m").alias("m"), "n")
        # Degrees add up to twice the edges, so fewer than HUBS nodes are hubs:
        # a proven bound.
        hub = F.col("n") > 2 * mark[0] / HUBS
        ahead = both.where("v > u").join(F.broadcast(
            low.where(hub).select("u", F.col("m").alias("hub_m"))), "u", "left")
        # Large star: larger neighbours of u point at u's smallest.
        large = (ahead.where("hub_m is not null").select("u", "v", F.col("hub_m").alias("m"))
                 .unionByName(ahead.where("hub_m is null").drop("hub_m")
                              .join(low.where(~hub).drop("n"), "u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # Small star: u and its smaller neighbours point at the smallest.
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        cur = materialize(small, "cc-pass")
        now = _mark(cur)
        if now == mark:
            return cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
                cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = now


def smallest_ids(links: DataFrame, members: DataFrame, classes: DataFrame,
                 name: str) -> DataFrame:
    """``node``, ``group`` (smallest id) of the classes that are linked, directly
    or through others. ``links``: ``node``, ``root``; ``members``: each ``id`` of
    each ``node``; ``classes``: each ``node`` with its smallest id, ``first``.
    Classes that hold the same id are linked too."""
    lows = (members.groupBy("id").agg(F.min("node").alias("root"), F.max("node").alias("high"))
            .where(F.col("root") < F.col("high")).select("id", "root"))
    same = members.join(lows, "id").select("node", "root")
    parts = materialize(connected_components(links.unionByName(same), "node", "root"), name)
    firsts = (parts.join(classes, "node").groupBy("component").agg(F.min("first").alias("group")))
    return parts.join(firsts, "component").select("node", "group")


def _mark(edges: DataFrame):
    """Identity of an edge set: its size and two order-free hashes."""
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                     F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first()
