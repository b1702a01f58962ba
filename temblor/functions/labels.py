"""Small CASE helpers shared by batch and streaming queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sigma_flag(value, mean, std, k: float = 2.0,
               high: str = "Anomalous", normal: str = "Normal") -> Column:
    """``value > mean + k*std`` -> high, else normal (null std -> normal)."""
    return F.when(_c(value) > _c(mean) + F.lit(k) * _c(std), high).otherwise(normal)


def trend_label(count, up: int = 10, down: int = 5) -> Column:
    """``> up`` increase, ``< down`` decrease, else stable."""
    c = _c(count)
    return F.when(c > up, "increase").when(c < down, "decrease").otherwise("stable")


def threshold_flag(col, threshold: float) -> Column:
    """Boolean ``col >= threshold`` that is false (not null) for a null input."""
    return F.coalesce(_c(col) >= F.lit(threshold), F.lit(False))


def energy_joules(magnitude) -> Column:
    """Released energy ``10^(1.5 m + 4.8)``."""
    return F.pow(F.lit(10.0), F.lit(1.5) * _c(magnitude) + F.lit(4.8))
