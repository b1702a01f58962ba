"""Vector code compression by k-means per part, with Drake-Hamerly bounds.

Vectors (as whole numbers) are cut into equal consecutive parts; each part
position has a codebook. For every part the ``b`` closest other entries are
persisted with lower bounds of their distances, in ascending order, and one
outer bound for all remaining entries. After the codebooks move, a bound falls
by its entry's movement and the outer bound by the largest movement. The
distance to the own entry is computed exactly; a part whose first bound exceeds
it keeps its entry unseen. Otherwise only the listed entries whose bounds do not
exceed it are verified, in whole numbers, ties to the lower index; if the outer
bound does not exceed it either, all entries are. ``b`` starts at a quarter of
the entries and shrinks to what all but a hundredth of the vectors needed.

A round is one pass over the written rows, which writes them again with their
new entries and bounds, and one aggregation of sums by part and entry, added up
in each task first; the driver sees the codebooks only.

Defined results: rows whose vector is null, empty, or holds null or non-finite
components are dropped; a scaled component of 2**28 or more is an error, and so
are kept vectors of different lengths or of a length that ``parts`` does not
divide; with fewer vectors than ``entries`` there are as many entries as
vectors; the smallest ids start the codebooks, a null id last, equal ids in the
order of their vectors; repeated rows are rows of their own; null labels are
equal; without kept rows there is no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small, table
from .vectors import matrix, whole_numbers

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
RARELY = 0.01   # share of vectors that may need more than ``b`` bounds

STATE = ["id", "label", "vector", "code", "near", "low", "used", "error"]


def squares(x, entries):
    """Exact squared distances of the rows of ``x`` to all ``entries``."""
    import numpy as np
    largest = int(np.abs(x).max(initial=0)) + int(np.abs(entries).max(initial=0))
    kind = np.float64 if largest * largest * x.shape[1] < 1 << 52 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    out = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return out.astype(np.int64)


def below(x):
    """32-bit floats not above ``x``."""
    import numpy as np
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def assign_all(x, entries, b: int):
    """Closest entry of each row, the ``b`` next ones with the bounds of their
    distances and the outer bound in the last column, and the squared distance."""
    import numpy as np
    d = squares(x, entries)
    order = np.argsort(d, axis=1, kind="stable")
    far = np.take_along_axis(d, order, 1)
    low = np.full((len(x), b + 1), np.inf, np.float32)
    some = below(np.sqrt(far[:, 1:b + 2].astype(np.float64)))
    low[:, :some.shape[1]] = some
    return order[:, 0], order[:, 1:b + 1], low, far[:, 0]


def assign_bounded(x, entries, moved, code, near, low):
    """The same after the entries have moved by ``moved``, from the bounds of the
    last pass; also how many bounds each row had to look behind (0: none)."""
    import numpy as np
    b = near.shape[1]
    code, near = code.astype(np.int64), near.astype(np.int64)
    gap = x.astype(np.int64) - entries[code]
    own = (gap * gap).sum(1)
    low = np.concatenate([low[:, :b] - moved[near], low[:, b:] - moved.max()], axis=1)
    # Ascending order again: no bound above a later one.
    low = below(np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1])
    reach = np.nextafter(np.sqrt(own.astype(np.float64)), np.inf)
    used = (low <= reach[:, None]).sum(1)
    listed = ((used > 0) & (used <= b)).nonzero()[0]
    if len(listed):
        seen = np.arange(b)[None, :] < used[listed][:, None]
        gap = x[listed].astype(np.int64)[:, None, :] - entries[near[listed]]
        d = np.concatenate([own[listed][:, None], np.where(
            seen, (gap * gap).sum(2), np.iinfo(np.int64).max)], axis=1)
        who = np.concatenate([code[listed][:, None], near[listed]], axis=1)
        bounds = np.concatenate([np.zeros((len(listed), 1), np.float32), low[listed, :b]], axis=1)
        known = np.concatenate([np.ones((len(listed), 1), bool), seen], axis=1)
        bounds = np.where(known, below(np.sqrt(np.where(known, d, 0).astype(np.float64))), bounds)
        # Verified entries by distance, ties to the lower index; the rest stay behind them.
        place = np.where(known, who, len(entries) + np.arange(b + 1)[None, :])
        order = np.lexsort((place, d), axis=1)
        who, bounds = np.take_along_axis(who, order, 1), np.take_along_axis(bounds, order, 1)
        code[listed], near[listed], low[listed, :b] = who[:, 0], who[:, 1:], bounds[:, 1:]
        own[listed] = np.take_along_axis(d, order[:, :1], 1)[:, 0]
    open_ = (used > b).nonzero()[0]
    if len(open_):
        code[open_], near[open_], low[open_], own[open_] = assign_all(x[open_], entries, b)
    return code, near, low, own, used


def _pass(rows: DataFrame, books, b: int, moved=None, listed: int = 0) -> DataFrame:
    """Assign all parts: anew, or with the bounds of the last pass (``listed``
    entries each) after the codebooks have ``moved``."""
    parts = len(books)
    kind = rows.schema["label"].dataType.simpleString()
    first = moved is None

    def assign_rows(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cells = dict(zip(batch.schema.names, batch.columns))
            x = matrix(cells["vector"]).reshape(n, parts, -1)
            code = np.zeros((n, parts), np.uint8)
            near = np.zeros((n, parts, b), np.uint8)
            low = np.zeros((n, parts, b + 1), np.float32)
            used = np.zeros(n, np.int64)
            error = np.zeros(n, np.int64)
            if not first:
                was = matrix(cells["code"], "u1")
                nears = (matrix(cells["near"], "u1").reshape(n, parts, listed) if listed
                         else np.zeros((n, parts, 0), np.uint8))
                lows = matrix(cells["low"], "<f4").reshape(n, parts, listed + 1)
                # No bound above a later one, so that any of them bounds what follows.
                lows = np.minimum.accumulate(lows[:, :, ::-1], axis=2)[:, :, ::-1]
            for p in range(parts):
                if first:
                    got = assign_all(x[:, p], books[p], b)
                else:
                    # Fewer entries in the list: the first one left out bounds the rest.
                    got = assign_bounded(x[:, p], books[p], moved[p], was[:, p],
                                         nears[:, p, :b], lows[:, p, :b + 1])
                    used = np.maximum(used, got[4])
                code[:, p], near[:, p], low[:, p] = got[:3]
                error += got[3]
            yield pa.RecordBatch.from_arrays(
                [cells["id"], cells["label"], cells["vector"],
                 *(pa.array([r.tobytes() for r in m], pa.binary()) for m in (code, near, low)),
                 pa.array(used, pa.int64()), pa.array(error, pa.int64())], names=STATE)

    return rows.mapInArrow(assign_rows, f"id long, label {kind}, vector binary, code binary, "
                                        "near binary, low binary, used long, error long")


def _moved_books(state: DataFrame, books):
    """Each entry as the rounded down mean of its parts; unused entries stay."""
    parts, entries, width = books.shape

    def sum_rows(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros((parts * entries, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0)).reshape(batch.num_rows, parts, width)
            code = matrix(batch.column(1), "u1")
            for p in range(parts):
                at = p * entries + code[:, p].astype(np.int64)
                np.add.at(total[:, :width], at, x[:, p])
                total[:, width] += np.bincount(at, minlength=parts * entries)
        entry, column = total.nonzero()
        yield pa.RecordBatch.from_arrays(
            [pa.array(entry, pa.int64()), pa.array(column, pa.int64()),
             pa.array(total[entry, column], pa.int64())], names=["entry", "column", "total"])

    import numpy as np
    sums = np.zeros((parts * entries, width + 1), np.int64)
    # At most as many rows as the codebooks have numbers, and a count each.
    for r in (state.select("vector", "code").mapInArrow(
            sum_rows, "entry long, column long, total long")
            .groupBy("entry", "column").agg(F.sum("total").alias("total")).collect()):
        sums[r["entry"], r["column"]] = r["total"]
    out = books.reshape(parts * entries, width).copy()
    hit = sums[:, width] > 0
    out[hit] = sums[hit, :width] // sums[hit, width:]
    return out.reshape(books.shape)


def fewer_bounds(state: DataFrame, b: int, entries: int) -> int:
    """``b`` for the next pass: enough for all but a share of the vectors, not
    more than before, and not below an eighth of the entries."""
    counts = {r["used"]: r["count"] for r in state.groupBy("used").count().collect()}
    rest = sum(counts.values())
    allowed, enough = RARELY * rest, b
    for m in range(b + 1):
        rest -= counts.get(m, 0)
        if rest <= allowed:
            enough = m
            break
    return min(b, max(enough, entries // 8))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: ``id_col``, ``code`` (two hex digits per part),
    ``error`` (squared distance to the coded vector), ``label_error`` (that
    summed over equal labels), ``codebooks_sha256`` (of all final entries'
    components by part, entry and place, comma-joined)."""
    import numpy as np
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte: at most 256 entries")
    rows = materialize(whole_numbers(vectors, id_col, vector_col, scale, label=F.col(label_col)),
                       "codes-vectors")
    least, most = rows.agg(F.min("size"), F.max("size")).first()
    if least is None:
        return rows.select(F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("code", "string"), ("error", "long"), ("label_error", "long"),
            ("codebooks_sha256", "string"))])
    if least != most or most % parts:
        raise ValueError(f"vectors of {least} to {most} components do not fit {parts} parts")
    first = rows.select("id").orderBy(F.asc_nulls_last("id")).limit(entries).collect()[-1]["id"]
    numbers = F.udf(lambda v: np.frombuffer(v, "<i4").tolist(), "array<int>")
    start = (rows.where(F.lit(True) if first is None else F.col("id") <= first)
             .select("id", numbers("vector").alias("v"))
             .orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect())
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, -1)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))
    entries = len(start)
    b = min(max(1, entries // 4), entries - 1)
    state = materialize(_pass(rows, books, b), "codes-state")
    for i in range(rounds):
        new = _moved_books(state, books)
        gap = (new - books).astype(np.float64)
        moved = np.nextafter(np.sqrt((gap * gap).sum(2)) * (1 + 1e-15), np.inf)
        # The pass before the first movement needed no bounds.
        listed, b = b, fewer_bounds(state, b, entries) if i else b
        books = new
        state = materialize(_pass(state, books, b, moved, listed), "codes-state")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    totals = small(state.groupBy(F.col("label").alias("same")).agg(
        F.sum("error").alias("label_error")))
    return state.join(totals, F.col("label").eqNullSafe(F.col("same"))).select(
        F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(digest).alias("codebooks_sha256"))


def op13_vector_codes(spark, sf_dir):
    """Codes and errors of every embedding: 16 parts, 64 entries, two rounds."""
    return compress(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""
far{i} AS (SELECT r, p, min({ENTRIES} * list_sum(list_transform(range(1, w + 1),
             lambda i: (x[i] - c[i]) * (x[i] - c[i]))) + e) AS m
           FROM part JOIN book{i} USING (p) GROUP BY r, p),
own{i} AS (SELECT r, p, m % {ENTRIES} AS e, m // {ENTRIES} AS d FROM far{i})""")
        if i < ROUNDS:
            steps.append(f"""
sum{i} AS (SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS v
           FROM own{i} JOIN part USING (r, p), LATERAL unnest(range(1, w + 1)) AS u(i)
           GROUP BY p, e, i),
mean{i} AS (SELECT p, e, list(v ORDER BY i) AS c FROM sum{i} GROUP BY p, e),
book{i + 1} AS (SELECT p, e, coalesce(mean{i}.c, book{i}.c) AS c
                FROM book{i} LEFT JOIN mean{i} USING (p, e))""")
    last = ROUNDS
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, z) AS r, vec_id, label, z FROM (
       SELECT vec_id, label,
              list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS z
       FROM embeddings WHERE len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
             = len(embedding))),
part AS (SELECT r, p, len(z) // {PARTS} AS w,
                z[p * (len(z) // {PARTS}) + 1:(p + 1) * (len(z) // {PARTS})] AS x
         FROM kept, range({PARTS}) AS g(p)),
book0 AS (SELECT p, r - 1 AS e, x AS c FROM part WHERE r <= {ENTRIES}),{",".join(steps)},
coded AS (SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code,
                 sum(d)::BIGINT AS error FROM own{last} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s
           FROM book{last})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       s AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


ORACLE_SQL = {"op13_vector_codes": _sql()}
