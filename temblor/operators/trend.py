"""Per-period aggregates with the change from the previous period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, value: str, order, by=(), prev_name: str | None = None,
                  change_name: str | None = None) -> DataFrame:
    """Add ``lag(value)`` within ``by`` ordered by ``order`` and ``value - lag``.

    Meant for already-aggregated input (one row per period and group). With
    no ``by`` all rows meet in one task, which is fine only because there is
    one row per period.
    """
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    prev_name = prev_name or f"prev_{value}"
    out = df.withColumn(prev_name, F.lag(value).over(w))
    if change_name:
        out = out.withColumn(change_name, F.col(value) - F.col(prev_name))
    return out


def period_change(df: DataFrame, period, aggs: dict, lag_of: str, by=(),
                  period_name: str = "period", prev_name: str | None = None,
                  change_name: str = "change") -> DataFrame:
    """``groupBy(period, *by).agg(aggs)`` then previous-period change of ``lag_of``.

    The aggregation is partial (map-side) then final, so a hot period or group
    costs one partial row per task, not a shuffle of its rows.
    """
    period_col = F.col(period) if isinstance(period, str) else period
    grouped = (df.withColumn(period_name, period_col)
                 .groupBy(period_name, *by)
                 .agg(*[expr.alias(name) for name, expr in aggs.items()]))
    return with_previous(grouped, lag_of, period_name, by=by,
                         prev_name=prev_name, change_name=change_name)
