"""Share of a grand total per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land
from .joins import attach_global


def share_of_total(df: DataFrame, by, count_name: str = "event_count",
                   total_name: str = "total_events",
                   pct_name: str = "event_percentage") -> DataFrame:
    """Count per ``by``, the grand total, and ``count / total * 100``.

    The total is a one-row aggregate of the (already small) grouped counts,
    attached as a literal; no window over all rows. The counts are written
    once, so the data is scanned once for both the total and the output.
    """
    by = [by] if isinstance(by, str) else list(by)
    counts = land(df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_name)), "counts")
    total = counts.agg(F.sum(count_name).alias(total_name))
    return (attach_global(counts, total)
            .withColumn(pct_name, F.col(count_name) * F.lit(1.0) / F.col(total_name) * 100))
