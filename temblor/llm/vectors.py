"""Vectors of whole numbers, shared by the operators that need exact sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: Components of at least this size (after scaling) raise an error: sums of
#: their squares or products would no longer fit 64 bits.
LARGEST = 1 << 28


def usable(vector_col: str) -> Column:
    """The vector is not null, not empty and all its components are finite."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & finite, F.lit(False))


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int,
                  **others: Column) -> DataFrame:
    """Usable rows as ``id`` (long), ``row`` (a number of its own), ``size``,
    ``vector`` (little-endian 32-bit floors of ``scale`` times a component) and
    the columns ``others``."""
    bounded_batches(vectors.sparkSession)
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * float(scale))
    scaled = F.when(F.forall(scaled, lambda x: F.abs(x) < float(LARGEST)), scaled).otherwise(
        F.raise_error(F.lit(f"a scaled component is not below {LARGEST}")))
    rows = vectors.where(usable(vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
        F.transform(scaled, lambda x: F.floor(x).cast("int")).alias("vector"),
        *[c.alias(name) for name, c in others.items()])
    names = ["id", "row", "size", "vector", *others]

    def number_rows(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            column = b.column(2)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype("<i4")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            cells = [flat[e - n:e].tobytes() for n, e in zip(sizes.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int32()),
                 pa.array(cells, pa.binary()), *b.columns[3:]], names=names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[3:]]
    return rows.mapInArrow(number_rows, ", ".join(
        ["id long, row long, size int, vector binary", *kinds]))


def matrix(cells, dtype: str = "<i4"):
    """The rows of equally long binary cells as one array."""
    import numpy as np
    cells = cells.to_pylist() if hasattr(cells, "to_pylist") else list(cells)
    return np.frombuffer(b"".join(cells), dtype).reshape(len(cells), -1)
