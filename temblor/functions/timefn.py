"""Time helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ms_to_ts(col) -> Column:
    """Epoch milliseconds (long or double) -> timestamp, millisecond precision kept."""
    return F.timestamp_millis(_c(col).cast("long"))


def ts_to_epoch_ms(col, ntz: bool = False) -> Column:
    """Timestamp -> epoch milliseconds (floor). A ``timestamp_ntz`` wall clock
    (``ntz=True``) is read as UTC without going through the session zone."""
    if ntz:
        epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        micros = F.timestamp_diff("MICROSECOND", epoch, _c(col))
        return F.floor(micros / 1000).cast("long")
    return F.unix_millis(_c(col).cast("timestamp"))


def as_instant(col) -> Column:
    """A ``timestamp_ntz`` wall clock as the instant that shows it in UTC,
    whatever the session zone (for watermarks, which need instants)."""
    return F.timestamp_micros(F.timestamp_diff(
        "MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), _c(col)))


def as_wall_clock(col) -> Column:
    """The inverse of ``as_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)),
                           F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def cutoff_date(as_of, days: int) -> Column:
    """``as_of - days`` as a date; ``as_of`` may be a date/str or None (today)."""
    base = F.current_date() if as_of is None else F.lit(
        as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of)))
    return F.date_sub(base, days)


def quarter_label(col) -> Column:
    """``YYYY-Qn`` text; sorts correctly for four-digit years."""
    c = _c(col)
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def truncate_to(col, unit: str = "second", kind=None) -> Column:
    """Truncate a timestamp. ``date_trunc`` returns a zoned timestamp; pass
    ``kind`` (e.g. ``TimestampNTZType()``) to keep a column's own type."""
    out = F.date_trunc(unit, _c(col))
    return out.cast(kind) if kind is not None else out
