"""Exact top-k inner products in the order of the vectors' lengths.

Vectors (as whole numbers) are range-partitioned by descending length into
slabs of about ``block`` rows. The search goes down the slabs in rounds of 1, 2,
4, ... slabs: the scores found so far give each query a threshold, and a query
takes part in a round only if its length times the longest vector of the round
still reaches it (Cauchy-Schwarz). When no query does, the rest of the table is
left alone.

Within a unit (a block of queries against a slab) vectors come in chunks of
descending length. An SVD rotation, fitted on a bounded sample, brings most of
the length into the first dimensions: their partial inner product plus the
product of the two residual lengths bounds the whole product, and only pairs
whose bound reaches the threshold get their exact product of whole numbers.
Thresholds rise from chunk to chunk. A unit returns at most ``k`` rows a query.

The rotation and the bounds decide only what is computed, never the result; all
pairs above a threshold, ties included, are compared exactly.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, and a scaled component of 2**28 or more is an error;
vectors of different lengths (in dimensions) are no candidates of each other;
rows that repeat an id are rows of their own, each excluding only itself; a null
id is no query, and a candidate that comes last among ties; equal scores go to
the smaller id; without queries there is no row; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_sample, materialize, table
from .vectors import matrix, whole_numbers

QUERIES_EVERY = 50
TOP = 5
SCALE = 256
BLOCK = 8192        # vectors of a slab, and queries of a block
SAMPLE = 4096       # vectors that the rotation is fitted on
HEAD_SHARE = 0.8    # of the squared length, in the dimensions of the partial sums
TILE, CHUNK = 1024, 512

FOUND = "q_row long, q_id long, score long, no_id int, id long, row long"


def rotation(sample, share: float = HEAD_SHARE):
    """Right singular vectors of the sample (as columns, largest first) and how
    many of them hold ``share`` of its squared length."""
    import numpy as np
    x = np.asarray(sample, np.float64)
    values, columns = np.linalg.eigh(x.T @ x)
    values, columns = values[::-1], columns[:, ::-1]
    energy = np.cumsum(np.maximum(values, 0))
    head = int(np.searchsorted(energy, share * energy[-1])) + 1
    return columns, min(head, len(values))


def products(a, b):
    """Exact inner products of the rows of two arrays of whole numbers."""
    import numpy as np
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best_of(q, x, turn, head: int, k: int, tile: int = TILE, chunk: int = CHUNK):
    """Search of the queries ``q`` (q_row, q_id, norm, threshold, vector) among
    the vectors ``x`` (row, id, no_id, norm, vector): at most ``k`` rows of
    ``FOUND`` for each query, all that could be among its first ``k``."""
    import numpy as np
    import pandas as pd
    x = x.sort_values("norm", ascending=False, kind="stable")
    a, b = matrix(q["vector"]), matrix(x["vector"])
    ra, rb = a @ turn, b @ turn
    rest_a, rest_b = (np.sqrt((r[:, head:] ** 2).sum(1)) for r in (ra, rb))
    len_a, len_b = q["norm"].to_numpy(), x["norm"].to_numpy()
    own, rows = q["q_row"].to_numpy(), x["row"].to_numpy()
    ids, no_id = x["id"].to_numpy(), x["no_id"].to_numpy()
    limit = q["threshold"].to_numpy(dtype=np.float64, na_value=-np.inf).copy()
    # best[i]: positions in x of what query i has found, with their scores
    score = np.zeros((len(a), k), np.int64)
    at = np.full((len(a), k), -1)
    for i in range(0, len(a), tile):
        block = np.arange(i, min(i + tile, len(a)))
        for j in range(0, len(b), chunk):
            # The bounds are rounded: pairs get a little more room than needed.
            slack = 1e-9 * len_a[block] * len_b[j] + 1e-6
            block = block[len_a[block] * len_b[j] + slack >= limit[block]]
            if not len(block):
                break
            cut = slice(j, j + chunk)
            slack = (1e-9 * len_a[block] * len_b[j] + 1e-6)[:, None]
            bound = ra[block, :head] @ rb[cut, :head].T
            bound += rest_a[block][:, None] * rest_b[cut][None, :]
            alive = (bound + slack >= limit[block][:, None]) & (
                own[block][:, None] != rows[cut][None, :])
            who, where = alive.nonzero()
            if not len(who):
                continue
            if len(who) * 16 > alive.size:
                exact = products(a[block], b[cut])[who, where]
            else:
                exact = (a[block[who]].astype(np.int64) * b[j + where]).sum(1)
            who, where = block[who], where + j
            high = exact >= limit[who]
            who, where, exact = who[high], where[high], exact[high]
            if not len(who):
                continue
            some = np.unique(who)
            held, place = (at[some] >= 0).nonzero()
            who = np.concatenate([who, some[held]])
            where = np.concatenate([where, at[some[held], place]])
            exact = np.concatenate([exact, score[some[held], place]])
            order = np.lexsort((rows[where], ids[where], no_id[where], -exact, who))
            who, where, exact = who[order], where[order], exact[order]
            first = np.searchsorted(who, who)
            nth = np.arange(len(who)) - first
            top = nth < k
            at[some] = -1
            at[who[top], nth[top]] = where[top]
            score[who[top], nth[top]] = exact[top]
            full = some[at[some, k - 1] >= 0]
            limit[full] = np.maximum(limit[full], score[full, k - 1])
    who, nth = (at >= 0).nonzero()
    where = at[who, nth]
    return pd.DataFrame({"q_row": own[who], "q_id": q["q_id"].to_numpy()[who],
                         "score": score[who, nth], "no_id": no_id[where], "id": ids[where],
                         "row": rows[where]})


def _first(found: DataFrame, k: int) -> DataFrame:
    """Ranks from 1 to ``k`` of what each query has found."""
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "no_id", "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(rows: DataFrame, every: int, k: int, block: int) -> DataFrame:
    """``FOUND`` and ``rank`` for vectors of one length."""
    n = rows.count()
    slabs = -(-n // block)
    # Descending length; the row number lets equal lengths be split.
    vectors = materialize(rows.repartitionByRange(slabs, F.desc("norm"), "row")
                          .withColumn("slab", F.spark_partition_id()), "inner-slabs")
    slabs = vectors.agg(F.max("slab")).first()[0] + 1
    turn, head = rotation(matrix([r["vector"] for r in hash_sample(
        vectors.select("vector", "row"), SAMPLE, None, "row").collect()]))
    queries = vectors.where(F.col("id") % every == 0).select(
        F.col("row").alias("q_row"), F.col("id").alias("q_id"), "norm", "vector")
    blocks = -(-queries.count() // block)
    if not blocks:
        return rows.sparkSession.createDataFrame([], f"{FOUND}, rank int")
    queries = materialize(queries.withColumn(
        "block", F.pmod(F.xxhash64("q_row"), F.lit(blocks)).cast("int")), "inner-queries")
    x = vectors.select("row", F.coalesce("id", F.lit(0).cast("long")).alias("id"),
                       F.col("id").isNull().cast("int").alias("no_id"), "norm", "vector", "slab")

    def unit(q, x):
        return best_of(q, x, turn, head, k)

    best = None
    low, width = 0, 1
    while low < slabs:
        here = F.col("slab").between(low, low + width - 1)
        longest = vectors.where(here).agg(F.max("norm")).first()[0]
        if longest is not None:
            waiting = queries.withColumn("threshold", F.lit(None).cast("double"))
            if best is not None:
                limits = best.where(F.col("rank") == k).select(
                    "q_row", F.col("score").cast("double").alias("threshold"))
                waiting = queries.join(limits, "q_row", "left")
            waiting = waiting.where(F.col("threshold").isNull() | (
                F.col("norm") * longest * (1 + 1e-9) + 1e-6 >= F.col("threshold")))
            if best is not None and waiting.isEmpty():
                break
            left = waiting.withColumn("slab", F.explode(F.sequence(
                F.lit(low), F.lit(min(low + width, slabs) - 1))))
            right = x.where(here).withColumn("block", F.explode(F.sequence(
                F.lit(0), F.lit(blocks - 1))))
            found = left.groupBy("block", "slab").cogroup(right.groupBy("block", "slab")) \
                .applyInPandas(unit, FOUND)
            if best is not None:
                found = found.unionByName(best.drop("rank"))
            best = materialize(_first(found, k), "inner-best")
        low, width = low + width, 2 * width
    return best


def top_products(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 every: int = QUERIES_EVERY, k: int = TOP, scale: int = SCALE,
                 block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row whose
    id is divisible by ``every`` its ``k`` largest inner products with other
    rows, as whole numbers (components times ``scale``, rounded down).

    Each number of dimensions that occurs (usually one) is a search of its own.
    """
    rows = whole_numbers(vectors, id_col, vector_col, scale, norm=F.sqrt(F.aggregate(
        F.transform(F.col(vector_col).cast("array<double>"),
                    lambda x: F.floor(x * float(scale)).cast("double")),
        F.lit(0.0), lambda s, x: s + x * x)))
    rows = materialize(rows, "inner-vectors")
    sizes = [r["size"] for r in rows.select("size").distinct().orderBy("size").collect()]
    found = [_search(rows.where(F.col("size") == s), every, k, block) for s in sizes]
    empty = rows.sparkSession.createDataFrame([], f"{FOUND}, rank int")
    return reduce(DataFrame.unionByName, found, empty).select(
        F.col("q_id").alias("query_id"), "rank",
        F.when(F.col("no_id") == 0, F.col("id")).alias("vec_id"), "score")


def op11_top_products(spark, sf_dir):
    """The five largest inner products of every 50th embedding."""
    return top_products(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = {"op11_top_products": f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id,
                  list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS z
           FROM embeddings WHERE len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
                 = len(embedding)),
pairs AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, v.r AS other,
                 list_inner_product(q.z, v.z)::BIGINT AS score
          FROM v AS q JOIN v ON len(q.z) = len(v.z) AND q.r <> v.r
          WHERE q.vec_id % {QUERIES_EVERY} = 0),
ranks AS (SELECT query_id, vec_id, score, row_number() OVER (
                 PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranks WHERE rank <= {TOP}"""}
