"""License scans by a positional index of rare words.

Templates are rows of a table: a label, a word sequence (a phrase or a whole
licence text) and a mandatory key phrase in it. Words are weighed by their
document frequency over the whole corpus; a template is filed under the two
rarest words (highest IDF) of its key phrase, which every accepted match must
hold at their places, so no match can be missed. A file's occurrences of filed
words fetch the templates' postings by a join; a start stays a candidate only if
the postings of both words meet there by relative position. For the starts that
are left, the words around are compared with the template's, the key phrase must
be complete, and the share of matching words is the match's coverage. A place
carries only the words that a template can reach, never the whole text.

Defined results: null text is empty; texts of any length are read whole;
documents without a match have no label, no place and score 0; repeated rows are
scanned as often as they occur; several templates may match at one place, and
ties of score change nothing; other columns are ignored.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, text_of
from .license_texts import TEXTS

# What stands between words: cutting there costs far less than matching words.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MIN_COVERAGE = 0.6
# Templates of up to this many words in all go to every task (some 40 MB);
# beyond it their join with the places shuffles.
BROADCAST_WORDS = 2_000_000

# Templates (fixed values): label, text, key phrase, whether it is a base phrase.
TEMPLATES = [
    ("mit", "mit license", "mit license", True),
    ("apache", "apache license", "apache license", True),
    ("gpl", "general public license", "general public license", True),
    ("agpl", "gnu affero general public license", "affero general public license", False),
    ("all-rights-reserved", "all rights reserved", "all rights reserved", False),
    ("apache-2.0", "licensed under the apache license version 2 0",
     "apache license version 2", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
     "are permitted provided that the following conditions are met",
     "redistribution and use in source and binary forms", False),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", False),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa", False),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0", False),
    ("creative-commons", "licensed under a creative commons attribution license",
     "creative commons", False),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3", False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose "
     "with or without fee is hereby granted", "permission to use copy modify", False),
    ("lgpl", "gnu lesser general public license", "lesser general public license", False),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy "
     "of this software and associated documentation files", "permission is hereby granted free",
     False),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license "
     "v 2 0", "mozilla public license", False),
    ("proprietary", "proprietary and confidential", "proprietary and confidential", False),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software", False),
    *[(label, text, key, False) for label, (key, text) in sorted(TEXTS.items())],
]


def _key_start(words: list[str], key: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased."""
    return F.array_remove(F.split(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase), GAP), "")


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``label``, ``text``, ``key`` (the mandatory phrase), ``base``."""
    return spark.createDataFrame(templates, "label string, text string, key string, base boolean")


def _parsed(templates: DataFrame) -> DataFrame:
    """Templates with their words and the place of the key phrase; an error for
    a key that is empty or does not stand in its text."""
    rows = templates.select(F.monotonically_increasing_id().alias("t"), "label", "base",
                            words_of(F.col("text")).alias("words"),
                            words_of(F.col("key")).alias("key"))
    last = F.size("words") - F.size("key")
    key_at = F.when((F.size("key") > 0) & (last >= 0), F.get(F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.slice("words", i + 1, F.size("key")) == F.col("key")), F.lit(0)))
    rows = materialize(rows.withColumn("key_at", key_at), "license-templates")
    wrong = rows.where("key_at is null").select("label").first()
    if wrong:
        raise ValueError(f"template {wrong['label']}: no key phrase in its text")
    return rows


def rare_word_index(docs: DataFrame, templates: DataFrame, text_col: str = "text") -> DataFrame:
    """Each template under the rarest word of its key phrase: ``w`` at ``j``,
    and the second rarest, ``w2`` at ``j2`` (null if the key is one word)."""
    keys = templates.select("t", F.posexplode("key").alias("i", "w"), "key_at")
    vocabulary = F.broadcast(keys.select("w").distinct()) if _few(templates) else keys.select(
        "w").distinct()
    frequency = (docs.select(F.explode(F.array_distinct(words_of(text_of(text_col)))).alias("w"))
                 .join(vocabulary, "w").groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    order = F.array_sort(F.collect_list(F.struct(
        F.coalesce("n", F.lit(0)).alias("n"), "w", (F.col("key_at") + F.col("i")).alias("j"))))
    rarest = keys.join(frequency, "w", "left").groupBy("t").agg(order.alias("r"))
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    return materialize(templates.join(rarest, "t").select(
        first["w"].alias("w"), first["j"].alias("j"), second["w"].alias("w2"),
        second["j"].alias("j2"), "label", "base", F.col("words").alias("shape"), "key_at",
        F.size("key").alias("key_len")), "license-index")


def _few(templates: DataFrame) -> bool:
    column = "words" if "words" in templates.columns else "shape"
    return (templates.agg(F.sum(F.size(column))).first()[0] or 0) <= BROADCAST_WORDS


def license_matches(docs: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id",
                    text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``id_col``, ``n_words`` and ``matches``: array of (start, label, base,
    coverage), ordered by start and label. ``start`` counts words from 0; it is
    negative where a text begins inside a template. ``templates`` is a table as
    ``template_table`` makes it; the plan itself holds only the filed words,
    at most one for each template."""
    parsed = _parsed(template_table(docs.sparkSession) if templates is None else templates)
    index = rare_word_index(docs, parsed, text_col)
    filed = [r["w"] for r in index.select("w").distinct().orderBy("w").collect()] or [""]
    reach = index.agg(F.max("j").alias("before"), F.max(F.size("shape") - F.col("j"))
                      .alias("after")).first()
    before, after = reach["before"] or 0, reach["after"] or 0

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       words_of(text_of(text_col)).alias("words"))
    places = F.when(F.arrays_overlap("words", F.array(*map(F.lit, filed))), F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        lambda x: x["w"].isin(*filed)))
    low = F.greatest(F.col("at.i") - before, F.lit(0))
    near = (rows.select("row", "id", F.size("words").cast("long").alias("n_words"), "words",
                        F.explode_outer(places).alias("at"))
            .select("row", "id", "n_words", F.col("at.w").alias("w"), F.col("at.i").alias("i"),
                    low.alias("low"), F.slice("words", low + 1, F.lit(before + after))
                    .alias("near")))
    hits = near.join(F.broadcast(index) if _few(index) else index, "w", "left")
    hits = hits.withColumn("start", F.col("i") - F.col("j"))

    def word_at(j):
        return F.get("near", F.col("start") + j - F.col("low"))

    both = F.col("w2").isNull() | F.coalesce(word_at(F.col("j2")) == F.col("w2"), F.lit(False))
    same = F.when(F.col("j").isNotNull() & both, F.transform(
        "shape", lambda w, j: F.coalesce(word_at(j) == w, F.lit(False))))
    compared = hits.select("row", "id", "n_words", "start", "label", "base", "key_at", "key_len",
                           same.alias("same"))
    key = F.forall(F.slice("same", F.col("key_at") + 1, F.col("key_len")), lambda x: x)
    coverage = F.size(F.filter("same", lambda x: x)) / F.size("same")
    match = F.when(F.col("same").isNotNull() & key & (coverage >= min_coverage), F.struct(
        "start", "label", "base", coverage.alias("coverage")))
    return (compared.groupBy("row", "id", "n_words")
            .agg(F.array_sort(F.collect_list(match)).alias("matches"))
            .select(F.col("id").alias(id_col), "n_words", "matches"))


def op2_license_scan(spark, sf_dir):
    """License labels and base phrase places of every document."""
    m = license_matches(table(spark, sf_dir, "documents"))
    m = m.withColumn("base", F.filter("matches", lambda x: x["base"]))

    def joined(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(
            matches, lambda x: x["label"]))), ",")

    starts = F.transform("base", lambda x: x["start"].cast("long"))
    return m.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                    F.array_min(starts).alias("first_word"),
                    F.array_max(starts).alias("last_word"),
                    joined(F.col("base")).alias("base_labels"),
                    joined(F.col("matches")).alias("labels"),
                    F.coalesce(F.array_max(F.transform("matches", lambda x: x["coverage"])),
                               F.lit(0.0)).alias("score"))


def _sql() -> str:
    rows = []
    for t, (label, words, key, base) in enumerate(TEMPLATES):
        ws, ks = (re.findall("[0-9a-z]+", x.lower()) for x in (words, key))
        at = _key_start(ws, ks)
        rows += [f"({t}, '{label}', {base}, {j}, '{w}', {int(at <= j < at + len(ks))}, "
                 f"{len(ws)}, {len(ks)})" for j, w in enumerate(ws)]
    return rf"""
WITH tmpl(t, label, base, j, w, is_key, n, n_key) AS (VALUES {', '.join(rows)}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
pos AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i FROM docs),
cover AS (SELECT r, t, label, base, i - j AS start, count(*) / any_value(n) AS coverage
          FROM pos JOIN tmpl USING (w) GROUP BY r, t, label, base, i - j
          HAVING sum(is_key) = any_value(n_key) AND count(*) / any_value(n) >= {MIN_COVERAGE}),
got AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
               max(start) FILTER (base) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
        FROM cover GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score
FROM docs LEFT JOIN got USING (r)"""


ORACLE_SQL = {"op2_license_scan": _sql()}
