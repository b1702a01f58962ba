"""Mean / sample standard deviation and the k-sigma outlier label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import sigma_flag
from ..session import land
from .joins import DEFAULT_BROADCAST_ROWS, attach_global, join_small
from .windowed import exact_avg


def sigma_label(df: DataFrame, value: str, by=None, k: float = 2.0,
                mean_name: str = "mean", std_name: str = "std_dev",
                label_name: str = "category", high: str = "Anomalous",
                normal: str = "Normal",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                materialize: bool = False, mean_scale: int | None = None) -> DataFrame:
    """Label rows whose ``value`` exceeds mean + k*sigma (of the group or of all).

    Statistics come from a partial+final aggregation (never an unordered
    window, which would pull a whole group into one task); the statistics are
    joined back: one row for the global case, a size-checked broadcast or a
    skew-aware shuffle join for the grouped case.

    The input is read twice (statistics, then labels). When it is expensive
    to produce (a fact-to-fact join), ``materialize=True`` writes it once to
    the shared folder (lineage cut, safe against executor loss) and both
    passes read that copy.
    """
    if materialize:
        df = land(df, "sigma")
    mean = exact_avg(value, mean_scale) if mean_scale is not None else F.avg(value)
    stats_aggs = [mean.alias(mean_name), F.stddev_samp(value).alias(std_name)]
    if not by:
        out = attach_global(df, df.agg(*stats_aggs))
    else:
        by = [by] if isinstance(by, str) else list(by)
        stats = df.groupBy(*by).agg(*stats_aggs)
        out = join_small(df, stats, by, max_rows=max_broadcast_rows, null_safe=True)
    return out.withColumn(label_name, sigma_flag(value, mean_name, std_name, k, high, normal))
