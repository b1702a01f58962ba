"""From ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet below the shared checkpoint folder and reads again as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temblor.llm import langid, ngram_join, packing, quality, secrets
from temblor.llm.common import materialize, small, table, text_of


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text beside the whole row, so that no column name can clash."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns])
                       .alias("row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter (null and empty texts among them) go; the
    rest stay, a missing language label filled in with the predicted one."""
    known = langid.fit(docs)
    if not known:  # nothing is labelled: only letters can be asked for
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = langid.identify(_carried(docs), known, keep=("row",))
    kept = judged.where(F.col("lang_pred") != langid.UNKNOWN)
    return kept.select("row.*", F.col("lang_pred").alias("__pred")).withColumn(
        "lang", F.coalesce("lang", "__pred")).drop("__pred")


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted of their own lines go."""
    judged = quality.judge(docs)
    rejected = materialize(judged.where("not kept").select(
        F.col("host").alias("__host"), F.col("content").alias("__content")).distinct(),
        "pipeline-rejected")
    same = ((F.coalesce(F.col("source").cast("string"), F.lit("")) == F.col("__host"))
            & (F.md5(text_of("text")) == F.col("__content")))
    return docs.join(small(rejected), same, "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays,
    once; rows without an id stay."""
    found = materialize(ngram_join.similar_documents(docs), "pipeline-groups")
    dropped = found.where("not kept").select(F.col("doc_id").alias("__id")).distinct()
    kept = docs.join(small(dropped), F.col("doc_id") == F.col("__id"), "left_anti")
    again = (found.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("__id"))
             .count().where("count > 1").select("__id"))
    if again.isEmpty():
        return kept
    again = small(materialize(again, "pipeline-repeated"))
    same = F.col("doc_id") == F.col("__id")
    return kept.join(again, same, "left_anti").unionByName(
        kept.join(again, same, "left_semi").dropDuplicates(["doc_id"]))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark."""
    found = secrets.scan(_carried(docs), secrets.fit(docs), keep=("row",))
    clean = found.select("row.*", F.col("spans").alias("__spans"))
    clean = clean.withColumn("text", secrets.redacted(F.col("text"), F.col("__spans")))
    return clean.withColumn("n_chars", F.when(F.size("__spans") > 0, F.char_length("text"))
                            .otherwise(F.col("n_chars")).cast("long")).drop("__spans")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two length, with their ids."""
    import public_tokenizers as tokenizers
    pieces = packing.pack(docs, tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", identify_language),
    ("quality", apply_quality_rules),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Trained models, hashing and tokenisation are beyond SQL; tests/llm compares
# the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
