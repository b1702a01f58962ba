"""``ntile(k)`` without pulling a whole group (or the whole table) into one task.

``ntile(k) OVER (PARTITION BY g ORDER BY o)`` needs each row's rank inside its
group and the group size. Spark's own window puts every row of a group (all
rows when there is no PARTITION BY) into one task, and a group may hold a
third of the data. Here the rank is built in pieces:

1. Rows are range-partitioned by (group, order columns, row number) with
   ``repartitionByRange`` and written once, with their range, to the shared
   folder. The row number ends every tie, so one hot group, one hot value or a
   mass of equal rows is spread over as many ranges as it fills; and since the
   ranges are written, an executor lost later cannot change them.
2. Row counts per (group, range) - at most ``ranges + #groups`` rows - give each
   range its offset within its group and the group size.
3. ``row_number`` inside (group, range) plus the offset is the rank inside the
   group; the ntile is computed from rank and size.

Every task sorts about ``n / ranges`` rows. Spark's range partitioner samples
on the executors and hands the driver its own bounded sample (at most a
million keys) whatever the size of the table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import land
from .joins import DEFAULT_BROADCAST_ROWS, join_small

DEFAULT_ROWS_PER_RANGE = 2_000_000


def ntile_from_rank(rank: Column, size: Column, k: int) -> Column:
    """SQL ntile from a 1-based rank and the group size: first ``size % k``
    tiles get one extra row."""
    q = F.floor(size / F.lit(k)).cast("long")
    r = (size % F.lit(k)).cast("long")
    big = r * (q + 1)
    head = F.ceil(rank / (q + 1))
    tail = r + F.ceil(F.try_divide(rank - big, q))
    return F.when(rank <= big, head).otherwise(tail).cast("long")


def rank_in_group(df: DataFrame, order, by=(), rank_name: str = "__rank",
                  size_name: str = "__size",
                  rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  keep_range: bool = False) -> DataFrame:
    """Add the 1-based ``row_number`` within ``by`` ordered by ``order``
    (ascending, nulls first) and the group size, skew-safe. ``keep_range``
    keeps the ``__range`` column (the unit one window task sorts).

    Runs a count and writes the ranged rows while it is called."""
    order = [order] if isinstance(order, str) else list(order)
    by = [by] if isinstance(by, str) else list(by)
    ranges = max(1, math.ceil(df.count() / max(1, rows_per_range)))
    keys = [F.col(c).asc_nulls_first() for c in by + order]
    ranged = land(df.withColumn("__row", F.monotonically_increasing_id())
                  .repartitionByRange(ranges, *keys, "__row")
                  .withColumn("__range", F.spark_partition_id()), "ranges")

    grp = by + ["__range"]
    counts = ranged.groupBy(*grp).agg(F.count(F.lit(1)).alias("__cnt"))
    # These windows run over one row per (group, range).
    before = (Window.partitionBy(*by).orderBy("__range") if by else Window.orderBy("__range")
              ).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    offsets = (counts
               .withColumn("__off", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))
               .withColumn(size_name, F.sum("__cnt").over(whole))
               .drop("__cnt"))
    # Without groups the offsets table has one row per range: a proven bound.
    joined = join_small(ranged, offsets, grp, max_rows=max_broadcast_rows, null_safe=True,
                        known_rows=None if by else ranges)
    w = Window.partitionBy(*[F.col(c) for c in grp]).orderBy(
        *[F.col(c).asc_nulls_first() for c in order], "__row")
    ranked = joined.withColumn(rank_name, F.col("__off") + F.row_number().over(w)).drop(
        "__off", "__row")
    return ranked if keep_range else ranked.drop("__range")


def ntile(df: DataFrame, k: int, order, by=(), name: str = "ntile", **kw) -> DataFrame:
    """Skew-safe ``ntile(k) OVER (PARTITION BY by ORDER BY order)``."""
    ranked = rank_in_group(df, order, by, **kw)
    return (ranked.withColumn(name, ntile_from_rank(F.col("__rank"), F.col("__size"), k))
            .drop("__rank", "__size"))


def ntile_profile(df: DataFrame, k: int, order, aggs: dict, by=(),
                  tile_name: str = "ntile", **kw) -> DataFrame:
    """Assign ``ntile(k)`` and aggregate per (by, tile)."""
    by = [by] if isinstance(by, str) else list(by)
    tiled = ntile(df, k, order, by, name=tile_name, **kw)
    return tiled.groupBy(*by, tile_name).agg(*[e.alias(n) for n, e in aggs.items()])
