"""Column functions for dirty numeric text (all JVM-side, no Python workers).

Spark 4 runs with ANSI mode on, where ``cast('None' as float)`` raises. Every
parse here goes through ``try_cast`` so a bad value becomes null instead of
failing the job, and ``NaN`` is mapped to null so it cannot sort above every
real number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text sentinels that mean "no value" in the raw trace table.
SENTINELS = ("None", "nan")

# Number patterns for the gated cast.
STRICT_UNSIGNED = r"^\d+(\.\d+)?$"
SIGNED_NUMBER = r"^[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col, to: str = "double") -> Column:
    """NaN -> null for a float/double column (``nanvl``: one evaluation)."""
    return F.nanvl(_c(col), F.lit(None).cast(to))


def clean_numeric(col, to: str = "float", sentinels=SENTINELS) -> Column:
    """Sentinel text or null -> null, otherwise the number (NaN -> null)."""
    c = _c(col)
    text = F.trim(c.cast("string"))
    parsed = F.when(~text.isin(*sentinels), text.try_cast(to))
    return nan_to_null(parsed, to)


def strip_brackets(col) -> Column:
    """``[[555.6]]`` / ``[1 2 3]`` -> inner text, trimmed."""
    return F.trim(F.regexp_replace(_c(col).cast("string"), r"^\s*\[+|\]+\s*$", ""))


def bracketed_number(col, to: str = "float") -> Column:
    """``[[555.6]]`` -> 555.6 (null when not a number)."""
    return nan_to_null(strip_brackets(col).try_cast(to), to)


def normalise_trailing_dot(col) -> Column:
    """``12.`` -> ``12.0`` (Java replacement syntax, so the group is ``$1``)."""
    return F.regexp_replace(_c(col).cast("string"), r"(\d+)\.$", "$1.0")


def to_float(col, to: str = "float") -> Column:
    """Null-safe normalise-and-cast used for the cleaned table's numeric columns."""
    return nan_to_null(normalise_trailing_dot(col).try_cast(to), to)


def gated_cast(col, pattern: str = SIGNED_NUMBER, to: str = "float") -> Column:
    """Only text matching ``pattern`` becomes a number, anything else null."""
    text = F.trim(_c(col).cast("string"))
    return F.when(text.rlike(pattern), text.try_cast(to))


def split_triplet(col, names=("strike", "dip", "rake"), to: str = "float") -> list[Column]:
    """``[[ 67.0 34.6 56.7 ]]`` -> three numbers (trim first, then split on blanks)."""
    parts = F.split(strip_brackets(col), r"\s+")
    return [nan_to_null(F.get(parts, i).try_cast(to), to).alias(n) for i, n in enumerate(names)]


def with_clean_columns(df: DataFrame, cols, fn=to_float, **kw) -> DataFrame:
    """Apply ``fn`` to several columns in one projection."""
    return df.withColumns({c: fn(c, **kw) for c in cols})
