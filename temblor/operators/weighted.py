"""Distance-weighted averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weighted_avg(df: DataFrame, value: str, distance: str, by,
                 weighted_name: str = "avg_weighted_magnitude",
                 avg_name: str = "avg_magnitude", value_scale: int | None = None) -> DataFrame:
    """Per group: ``avg(value / (1 + distance))`` and ``avg(value)``, non-null rows
    only (``value_scale``: plain mean from an exact decimal sum)."""
    from .windowed import exact_avg
    by = [by] if isinstance(by, (str,)) or not isinstance(by, (list, tuple)) else list(by)
    kept = df.filter(F.col(value).isNotNull() & F.col(distance).isNotNull())
    return kept.groupBy(*by).agg(
        F.avg(F.col(value) / (F.lit(1) + F.col(distance))).alias(weighted_name),
        (exact_avg(value, value_scale) if value_scale is not None else F.avg(value))
        .alias(avg_name))
