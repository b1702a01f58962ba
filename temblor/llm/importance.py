"""Target-distribution importance resampling with an exact numeric cutoff.

Texts become arrays of hashed n-gram buckets, written once. Bucket counts of
all documents and of all target texts (added up per task before they are
shuffled) give one integer gain per bucket: the log of how much more frequent
the bucket is in the target. A document's weight is the mean gain over its
array; Gumbel noise taken from its id turns the highest scores into a weighted
draw without replacement.

How high is high enough is found by bisection over numbers, not by a sort: jobs
over the written scores count the rows up to some thresholds, until the value
of the n-th row is known; rows tied there are cut in the same way by id, and,
if an id occurs more than once, by number of features and row. Only the
selected rows are range-partitioned and numbered.

Defined results: a null or empty text has no features, weight 0, and is never
drawn; a null id is hashed as '' and comes last among ties; repeated rows are
documents of their own; an empty target gives every bucket the gain of its
rarity; without documents there is no row; texts of any length are read whole,
one at a time; other columns are ignored.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import bounded_batches, materialize, table, text_of

BUCKETS = 10_000
MAX_N = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
WORDS_KEPT = 200_000     # words whose bucket a task remembers
RANGE_ROWS = 1_000_000   # selected rows that one task numbers
THRESHOLDS = 32          # counted at once in one job of the bisection

# Bytes of words stand for themselves (A-Z as a-z), all others for a blank.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c
                    if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class Buckets(dict):
    """Bucket of each word's bytes; forgets all when it is full."""

    def __init__(self, buckets: int, limit: int = WORDS_KEPT):
        super().__init__()
        self.buckets, self.limit = buckets, limit

    def __missing__(self, word: bytes) -> int:
        import zlib
        if len(self) >= self.limit:
            self.clear()
        out = self[word] = zlib.crc32(word) % self.buckets
        return out


def features(text: bytes, known: Buckets, max_n: int = MAX_N):
    """Number of words, and the buckets of all runs of 1 to ``max_n`` of them."""
    import zlib

    import numpy as np
    words = text.translate(_WORD_BYTES).split()
    parts = [np.fromiter(map(known.__getitem__, words), np.uint32, len(words))]
    for n in range(2, max_n + 1):
        runs = zip(*(words[i:] for i in range(n)))
        parts.append(np.fromiter((zlib.crc32(b" ".join(r)) % known.buckets for r in runs),
                                 np.uint32, max(0, len(words) - n + 1)))
    return len(words), np.concatenate(parts)


def feature_arrays(texts: DataFrame, buckets: int, max_n: int) -> DataFrame:
    """``id``, ``name`` (the id as text), ``row``, ``text`` to ``id``, ``name``,
    ``row``, ``n_words``, ``n_features``, ``buckets`` (little-endian 32-bit)."""
    bounded_batches(texts.sparkSession)

    def array_rows(batches):
        import pyarrow as pa
        known = Buckets(buckets)
        for b in batches:
            words, sizes, found = [], [], []
            for text in b.column(3):
                n, own = features(text.as_py(), known, max_n)
                words.append(n)
                sizes.append(len(own))
                found.append(own.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(words, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                names=["id", "name", "row", "n_words", "n_features", "buckets"])

    rows = texts.select("id", "name", "row", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(array_rows, "id long, name string, row long, n_words long, "
                                       "n_features long, buckets binary")


def bucket_counts(arrays: DataFrame, buckets: int):
    """Features in each bucket over all rows, as an array of ``buckets`` numbers."""
    import numpy as np

    def count_rows(batches):
        import pyarrow as pa
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), "<u4"), minlength=buckets)
        some = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["b", "n"])

    out = np.zeros(buckets, np.int64)
    for r in (arrays.select("buckets").mapInArrow(count_rows, "b long, n long")
              .groupBy("b").agg(F.sum("n").alias("n")).collect()):  # at most ``buckets`` rows
        out[r["b"]] = r["n"]
    return out


def gains(own, target) -> list[int]:
    """1000 times the log of each bucket's share in the target over its share
    in the documents, both with one feature more in every bucket; rounded down."""
    buckets, s_all, t_all = len(own), int(own.sum()), int(target.sum())
    return [math.floor(1000 * math.log((float(t + 1) * float(s_all + buckets))
                                       / (float(s + 1) * float(t_all + buckets))))
            for s, t in zip(own.tolist(), target.tolist())]


def noise(name: str, seed: int = SEED) -> int:
    """1000 times a Gumbel number that the id's text alone decides, rounded down."""
    import hashlib
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def nth_value(rows: DataFrame, key: Column, n: int) -> tuple[int, int, int]:
    """The ``n``-th smallest value (from 1) of a whole-number ``key``, by counts
    alone; also how many rows lie below it and how many hold it."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    while low < high:
        steps = sorted({low + (high - low) * i // THRESHOLDS for i in range(THRESHOLDS)})
        counts = rows.agg(*[F.count(F.when(key <= F.lit(t), 1)) for t in steps]).first()
        enough = [t for t, c in zip(steps, counts) if c >= n]
        short = [t for t, c in zip(steps, counts) if c < n]
        high = min(enough, default=high)
        low = max([low, *(t + 1 for t in short)])
    below, equal = rows.agg(F.count(F.when(key < F.lit(low), 1)),
                            F.count(F.when(key == F.lit(low), 1))).first()
    return low, below, equal


def first_rows(rows: DataFrame, keys: list[str], n: int) -> Column:
    """The condition that holds for exactly the first ``n`` rows in the order of
    ``keys`` (whole numbers, not null, together unique)."""
    if n <= 0:
        return F.lit(False)
    chosen, tied = F.lit(False), F.lit(True)
    for k in keys:
        value, below, equal = nth_value(rows, F.col(k), n)
        chosen = chosen | (tied & (F.col(k) < F.lit(value)))
        tied = tied & (F.col(k) == F.lit(value))
        n -= below
        if equal == n:
            break
        rows = rows.where(F.col(k) == F.lit(value))
    return chosen | tied


def ranked(rows: DataFrame, keys: list[str], n: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The ``n`` rows with their ``rank`` from 1 in the order of ``keys``."""
    spark = rows.sparkSession
    parts = max(1, -(-n // range_rows))
    dealt = materialize(rows.repartitionByRange(parts, *keys)
                        .withColumn("part", F.spark_partition_id()), "importance-drawn")
    before, offsets = 0, []
    for r in dealt.groupBy("part").count().orderBy("part").collect():  # one row a range
        offsets.append((r["part"], before))
        before += r["count"]
    starts = spark.createDataFrame(offsets, "part int, before long")
    within = F.row_number().over(Window.partitionBy("part").orderBy(*keys))
    return (dealt.join(F.broadcast(starts), "part")
            .withColumn("rank", F.col("before") + within).drop("part", "before"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N,
             seed: int = SEED, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``id_col``, ``n_features``, ``weight``, ``score``
    and ``rank`` (null unless drawn): ``percent`` of the documents with at least
    ``min_words`` words, by highest score, ties to the smaller id."""
    ident = F.col(id_col)
    texts = docs.select(ident.cast("long").alias("id"),
                        F.coalesce(ident.cast("string"), F.lit("")).alias("name"),
                        F.monotonically_increasing_id().alias("row"),
                        text_of(text_col).alias("text"))
    arrays = materialize(feature_arrays(texts, buckets, max_n), "importance-features")
    nobody = F.lit(None)
    wanted = feature_arrays(target.select(
        nobody.cast("long").alias("id"), nobody.cast("string").alias("name"),
        nobody.cast("long").alias("row"), text_of(target_col).alias("text")), buckets, max_n)
    gain = gains(bucket_counts(arrays, buckets), bucket_counts(wanted, buckets))

    def score_rows(batches):
        import numpy as np
        import pyarrow as pa
        by_bucket = np.array(gain, np.int64)
        for b in batches:
            weights = [int(by_bucket[own].sum()) // len(own) if len(own) else 0 for own in
                       (np.frombuffer(x.as_buffer(), "<u4") for x in b.column(5))]
            scores = [w + noise(name, seed) for w, name in zip(weights, b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), b.column(4),
                 pa.array(weights, pa.int64()), pa.array(scores, pa.int64())],
                names=["id", "row", "n_words", "n_features", "weight", "score"])

    scored = arrays.mapInArrow(score_rows, "id long, row long, n_words long, n_features long, "
                                           "weight long, score long")
    scored = materialize(scored.withColumns({
        "down": -F.col("score"), "no_id": F.col("id").isNull().cast("int"),
        "by_id": F.coalesce("id", F.lit(0).cast("long"))}), "importance-scores")
    keys = ["down", "no_id", "by_id", "n_features", "row"]
    enough = F.col("n_words") >= min_words
    n = scored.where(enough).count() * percent // 100
    drawn = enough & first_rows(scored.where(enough), keys, n)
    chosen = ranked(scored.where(drawn), keys, n) if n else scored.where(F.lit(False)).withColumn(
        "rank", F.lit(None).cast("long"))
    out = chosen.unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score",
                      F.col("rank").cast("long").alias("rank"))


def op12_importance_resample(spark, sf_dir):
    """Weight, score and rank of every document against the benchmark texts."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# SQL knows no crc32: its table of 256 entries follows from the polynomial.
CRC_POLYNOMIAL = 0xEDB88320
_STEP = (f"list_reduce(range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, "
         f"{CRC_POLYNOMIAL}::UBIGINT) ELSE a >> 1 END, i::UBIGINT)")
ORACLE_SQL = {"op12_importance_resample": rf"""
WITH crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, {_STEP} AS v
                   FROM range(256) AS r(i))),
texts AS (SELECT row_number() OVER () AS r, true AS own, doc_id,
                 translate(coalesce(text, ''), '{string.ascii_uppercase}',
                           '{string.ascii_lowercase}') AS low FROM documents
          UNION ALL SELECT NULL, false, NULL, translate(coalesce(text, ''),
                 '{string.ascii_uppercase}', '{string.ascii_lowercase}') FROM benchmark),
words AS (SELECT own, r, doc_id,
                 unnest(regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
          FROM texts),
counts AS (SELECT own, r, doc_id, w, count(*) AS c FROM words GROUP BY ALL),
vocabulary AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM words)),
hashed AS (SELECT w, xor(list_reduce(list_transform(range(len(x) // 2),
                     lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT),
                     lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT),
                     4294967295::UBIGINT) % {BUCKETS} AS b FROM vocabulary, crc_table),
sums AS (SELECT b, sum(CASE WHEN own THEN c ELSE 0 END) AS s,
                sum(CASE WHEN own THEN 0 ELSE c END) AS t
         FROM counts JOIN hashed USING (w) GROUP BY b),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM sums),
gains AS (SELECT b, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + {BUCKETS})::DOUBLE)
                 / ((s + 1)::DOUBLE * (t_all + {BUCKETS})::DOUBLE))) AS g FROM sums, totals),
weights AS (SELECT r, sum(c) AS n, floor(sum(c * g) / sum(c)) AS weight
            FROM counts JOIN hashed USING (w) JOIN gains USING (b) WHERE own GROUP BY r),
scored AS (SELECT texts.r, texts.doc_id, coalesce(n, 0)::BIGINT AS n_features,
                  coalesce(weight, 0)::BIGINT AS weight,
                  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256(
                     '{SEED}:' || coalesce(texts.doc_id::VARCHAR, '')), 1, 8))::UBIGINT + 0.5::DOUBLE)
                     / 4294967296))))::BIGINT AS score
           FROM texts LEFT JOIN weights ON texts.r = weights.r WHERE own),
ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, r) AS k,
                 count(*) OVER () AS n_all FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score,
       CASE WHEN k <= {PERCENT} * n_all // 100 THEN k END AS rank
FROM scored LEFT JOIN ranks USING (r)"""}
