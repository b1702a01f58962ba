"""Quality rules: within-document counts and cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space collapsed) and hashed, and
distinct documents are counted by host and line. A line of enough documents of a
host is a candidate; it is boilerplate if enough documents with text of their
own hold it. Boilerplate lines are removed, and a document that keeps too few of
its words is rejected.

Copies must not vote, or a document's own lines would be boilerplate as soon as
it is copied often. Exact copies are one document from the start. A document
that would keep at least half of its words without all candidates votes for
itself. Any other votes by the set of its own lines (those that are no
candidates): documents with the same set are one vote, and lines that merely
stand in the place of a candidate do not count. That is the case if the
candidate before them (or, at the start, the one after) is more often next to
another candidate than to lines of no frequency: an edited line of a near copy
stands where the other copies have a shared one, while the own lines of pages
made from a template stand where every page has its own. Documents without own
lines have no vote.

Repeated words are found by hashing each 8-word window; only documents in
which two windows share a hash compare the windows themselves.

Defined results: null text has no words and fails; a null host is the host
''; repeated rows each get a row; texts of any length are counted whole, one
document being the unit of work; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, materialize, table, text_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
LINE_DOCS = 50        # a line with fewer votes of a host's documents is no boilerplate
OWN_PERCENT = 50      # documents with this much of their own vote as they are
LEFT_PERCENT = 20     # a document keeping less than this of its words is rejected


def documents_measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Counts of each document and its hashed lines; no text."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"),
                       F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD_RE), F.lit(0)))
    rows = rows.withColumn("n", F.size("words"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    rows = rows.withColumn("hashes", hashes)
    windows = F.transform(
        F.slice("hashes", 1, F.greatest(F.col("n") - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(F.col("hashes"), i + k) for k in range(1, WINDOW)]))
    rows = rows.withColumn("windows", windows)
    rows = rows.withColumn("suspect", F.size(F.array_distinct("windows")) < F.size("windows"))
    # Windows of suspect documents as strings, in order, with their places.
    strings = F.transform(F.slice("words", 1, F.col("n") - (WINDOW - 1)), lambda w, i: F.struct(
        F.array_join(F.slice("words", i + 1, WINDOW), " ").alias("w"), i.alias("i")))
    rows = rows.withColumn("ordered", F.when(F.col("suspect"), F.array_sort(strings)))
    again = F.transform("ordered", lambda x, k: F.when(
        F.coalesce(F.get(F.col("ordered"), k - 1)["w"] == x["w"], F.lit(False))
        | F.coalesce(F.get(F.col("ordered"), k + 1)["w"] == x["w"], F.lit(False)), x["i"]))
    rows = rows.withColumn("places", F.array_sort(F.array_compact(again)))
    covered = F.aggregate(
        F.transform("places", lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("places"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("lines", lines)
    low = F.transform("lines", lambda x: F.trim(F.regexp_replace(
        F.translate(x, string.ascii_uppercase, string.ascii_lowercase),
        r"[\x20\x09-\x0D]+", " ")))
    hashed = F.transform(low, lambda x: F.struct(
        F.substring(F.md5(x), 1, 16).alias("h"), F.size(F.split(x, " ")).alias("w")))
    return rows.select(
        "id", "host", F.md5("text").alias("content"), F.col("n").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", "[#*$%&|<>]", "")))
        .cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        hashed.alias("lines"))


def voters(lines: DataFrame, hits: DataFrame, own_percent: float) -> DataFrame:
    """``host``, ``content``, ``vote``: what each document with a candidate line
    (``hits``) counts as; documents without a vote are left out."""
    own = F.col("n_words") - F.col("gone")
    shared = (hits.groupBy("host", "content", "n_words").agg(F.sum("w").alias("gone"))
              .withColumn("alone", own * 100 >= F.col("n_words") * own_percent))
    few = shared.where("not alone").select("host", "content")
    place = Window.partitionBy("host", "content").orderBy("pos")
    to_next = F.coalesce(F.lead("pos").over(place), F.col("n_lines")) - F.col("pos")
    to_last = F.col("pos") - F.coalesce(F.lag("pos").over(place), F.lit(-1))
    # How often a candidate stands next to another one, and next to other lines.
    beside = (hits.withColumns({"to_next": to_next, "to_last": to_last,
                                "ends": F.lead("pos").over(place).isNull(),
                                "starts": F.lag("pos").over(place).isNull()})
              .groupBy("host", "h").agg(
        F.count_if((F.col("to_next") == 1) & ~F.col("ends")).alias("a"),
        F.count_if(F.col("to_next") > 1).alias("b"),
        F.count_if((F.col("to_last") == 1) & ~F.col("starts")).alias("c"),
        F.count_if(F.col("to_last") > 1).alias("d")).select(
        "host", "h", (F.col("b") >= F.col("a")).alias("own_after"),
        (F.col("d") >= F.col("c")).alias("own_before")))
    placed = lines.join(few, ["host", "content"], "left_semi").join(beside, ["host", "h"], "left")
    before = F.last("own_after", ignorenulls=True).over(
        place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("own_before", ignorenulls=True).over(
        place.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    mine = (placed.withColumn("genuine", F.coalesce(before, after))
            .where(F.col("own_after").isNull() & F.col("genuine"))
            .select("host", "content", "h").distinct().groupBy("host", "content")
            .agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"),
                             F.bit_xor(F.xxhash64("h")).cast("string")).alias("vote")))
    return shared.where("alone").select("host", "content", F.col("content").alias("vote")) \
        .unionByName(mine)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", line_docs: int = LINE_DOCS,
          own_percent: float = OWN_PERCENT, left_percent: float = LEFT_PERCENT) -> DataFrame:
    """``id_col``, ``host``, ``content`` (md5 of the text), the counts,
    ``removed_words`` (in boilerplate lines), ``base_failed``, ``kept``.

    A verdict depends on host and text alone, so exact copies are one document
    in the line counts and share the verdict joined back to them."""
    measured = materialize(documents_measured(docs, id_col, text_col, host_col), "quality")
    distinct = measured.groupBy("host", "content").agg(
        F.any_value("lines").alias("lines"), F.any_value("n_words").alias("n_words"))
    lines = distinct.select(
        "host", "content", "n_words", F.size("lines").alias("n_lines"),
        F.posexplode("lines").alias("pos", "line")).select(
        "host", "content", "n_words", "n_lines", "pos", F.col("line.h").alias("h"),
        F.col("line.w").alias("w"))
    often = (lines.groupBy("host", "h").agg(F.countDistinct("content").alias("n_docs"))
             .where(F.col("n_docs") >= line_docs).select("host", "h"))
    hits = materialize(lines.join(often, ["host", "h"]), "quality-lines")
    votes = voters(lines, hits, own_percent)
    common = (hits.select("host", "content", "h").distinct().join(votes, ["host", "content"])
              .groupBy("host", "h").agg(F.countDistinct("vote").alias("n_votes"))
              .where(F.col("n_votes") >= line_docs).select("host", "h"))
    removed = (hits.join(common, ["host", "h"]).groupBy("host", "content")
               .agg(F.sum("w").alias("removed_words")))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    left = (F.col("n_words") - F.col("removed_words")) * 100
    return (measured.drop("lines").join(removed, ["host", "content"], "left")
            .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (left >= F.col("n_words") * left_percent))
            .withColumnRenamed("id", id_col))


def op9_quality(spark, sf_dir):
    """Counts, base rules and the line-frequency verdict of every document."""
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


ORACLE_SQL = {"op9_quality": rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                     coalesce(source, '') AS host,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
              FROM documents),
win AS (SELECT r, i, array_to_string(list_slice(words, i, i + {WINDOW - 1}), ' ') AS w
        FROM docs, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS g(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM win)
        WHERE n >= 2),
cov AS (SELECT r, sum(least({WINDOW}, coalesce(next - i, {WINDOW}))) AS n_repeat_words FROM
        (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM rep) GROUP BY r),
distinct_docs AS (SELECT min(r) AS d, host, text FROM docs GROUP BY host, text),
raw AS (SELECT r, unnest(x) AS line, unnest(range(len(x))) AS i
        FROM (SELECT r, string_split(text, chr(10)) AS x FROM docs)),
words_in AS (SELECT r, i, line, trim(regexp_replace(translate(line, '{string.ascii_uppercase}',
               '{string.ascii_lowercase}'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS low
             FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM words_in GROUP BY r),
lines AS (SELECT d, host, substr(md5(low), 1, 16) AS h, len(string_split(low, ' ')) AS w,
                 row_number() OVER (PARTITION BY d ORDER BY i) - 1 AS pos,
                 count(*) OVER (PARTITION BY d) AS n_lines
          FROM words_in JOIN distinct_docs ON r = d),
often AS (SELECT host, h FROM lines GROUP BY host, h HAVING count(DISTINCT d) >= {LINE_DOCS}),
hits AS (SELECT d, host, h, w, pos, n_lines FROM lines JOIN often USING (host, h)),
shared AS (SELECT d, (len(words) - sum(w)) * 100 >= len(words) * {OWN_PERCENT} AS alone
           FROM hits JOIN docs ON r = d GROUP BY d, len(words)),
next AS (SELECT host, h, pos, n_lines, lead(pos) OVER (PARTITION BY d ORDER BY pos) AS n,
                lag(pos) OVER (PARTITION BY d ORDER BY pos) AS l FROM hits),
beside AS (SELECT host, h,
                  count(*) FILTER (coalesce(n, n_lines) - pos > 1)
                    >= count(*) FILTER (n - pos = 1) AS own_after,
                  count(*) FILTER (pos - coalesce(l, -1) > 1)
                    >= count(*) FILTER (pos - l = 1) AS own_before FROM next GROUP BY host, h),
placed AS (SELECT d, h, own_after, coalesce(
                  last_value(own_after IGNORE NULLS) OVER (PARTITION BY d ORDER BY pos
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(own_before IGNORE NULLS) OVER (PARTITION BY d ORDER BY pos
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS genuine
           FROM lines JOIN shared USING (d) LEFT JOIN beside USING (host, h) WHERE NOT alone),
votes AS (SELECT d, CAST(d AS VARCHAR) AS vote FROM shared WHERE alone
          UNION ALL SELECT d, 'set ' || string_agg(DISTINCT h, ' ' ORDER BY h) FROM placed
          WHERE own_after IS NULL AND genuine GROUP BY d),
common AS (SELECT host, h FROM hits JOIN votes USING (d) GROUP BY host, h
           HAVING count(DISTINCT vote) >= {LINE_DOCS}),
removed AS (SELECT d, sum(w) AS gone FROM hits JOIN common USING (host, h) GROUP BY d),
counted AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
       CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
         AS n_symbols,
       CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(gone, 0) AS gone
FROM docs JOIN distinct_docs USING (host, text) LEFT JOIN cov USING (r) LEFT JOIN dup USING (r)
     LEFT JOIN removed USING (d))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT}
         AS base_failed,
       NOT (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT})
         AND (n_words - gone) * 100 >= n_words * {LEFT_PERCENT} AS kept
FROM counted"""}
