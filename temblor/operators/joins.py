"""Joining a small derived table back onto a large one.

A broadcast is used only after the small side's row count has been checked
against a bound; above it the join stays a shuffle join, where adaptive
execution can still split a hot key (skew join) at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land

# Row bound for broadcasting a derived (aggregated) table.
DEFAULT_BROADCAST_ROWS = 200_000


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, keys, how: str = "inner",
               max_rows: int = DEFAULT_BROADCAST_ROWS, null_safe: bool = False,
               known_rows: int | None = None) -> DataFrame:
    """Join ``small`` (a derived, usually aggregated table) onto ``big`` by ``keys``.

    ``small`` is written once to the shared folder, so that the size check and
    the join share one computation and nothing stays cached. ``known_rows`` is
    an upper bound the caller can prove (for example the number of ranges it
    created); it replaces writing and counting. Runs jobs while it is called.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if known_rows is not None and known_rows <= max_rows:
        side = F.broadcast(small)
    else:
        small = land(small, "small")
        side = F.broadcast(small) if bounded_rows(small, max_rows) else small
    if not keys:
        return attach_global(big, small)
    if not null_safe:
        return big.join(side, keys, how)
    renamed = side.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                            for c in side.columns])
    cond = reduce(lambda a, b: a & b,
                  [big[c].eqNullSafe(renamed[f"__r_{c}"]) for c in keys])
    return big.join(renamed, cond, how).drop(*[f"__r_{c}" for c in keys])


def attach_global(big: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row aggregate (global statistics) to every row as literals.

    The aggregate is a partial+final reduction to exactly one row; its values
    come back to the driver (one row, bounded) and become constants of the
    projection, so the big side stays a narrow map with no join at all.
    """
    row = one_row.first()
    fields = one_row.schema.fields
    return big.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in fields})
