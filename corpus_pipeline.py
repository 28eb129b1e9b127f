"""Cleaning and packing a corpus: each stage works on what the one before it kept.

Every stage takes the documents' columns, whatever else the table has, and all but the last return
them. Null and empty texts, repeated rows and repeated or null ids pass through every stage by the
same rules as other documents; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.llm import packing, quality, repeats, secrets, simhash
from tallyweek.llm.shared import landed, numbered, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Repeated passages: strings of so many bytes, found by so many of them, that hold so many words.
PASSAGE_BYTES, PASSAGE_GRAM, PASSAGE_WORDS = 240, 32, 50
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject, at its score of 0.7."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    scorer = quality.fit(docs, labels.where(fold != 2))
    rows = quality.score(docs.select(*COLUMNS), scorer, keep=COLUMNS[1:]).withColumnRenamed("id", "doc_id")
    return rows.where(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays; rows without an id come last."""
    small_batches(spark)
    rows = numbered(docs.select(*COLUMNS), "numbered")
    place = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "row")
    found = simhash.near_duplicates(rows.select(place.alias("place"), "text"), id_col="place")
    keep = found.where("id = component").select("id.row")
    return rows.join(keep, "row", "left_semi").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that occur more than once are cut out; every document stays.

    They are looked for as repeated strings of PASSAGE_BYTES, which 50 words hardly ever fall short
    of. A cut inside a character leaves bytes that are no UTF-8; they become the replacement character."""
    small_batches(spark)
    rows = docs.select(*COLUMNS).withColumn("had_text", F.col("text").isNotNull())
    more = ["lang", "source", "n_chars", "had_text"]
    kept = repeats.remove_repeats(rows, length=PASSAGE_BYTES, gram=PASSAGE_GRAM, least_words=PASSAGE_WORDS, keep=more)
    kept = kept.withColumnRenamed("id", "doc_id")
    kept = kept.withColumn("text", F.when(F.col("had_text"), F.make_valid_utf8(F.col("kept").cast("string"))))
    changed = F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*COLUMNS)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    small_batches(spark)
    before = docs.select(*COLUMNS).withColumn("old", F.length("text"))
    rows = secrets.redact(before)
    changed = F.when(F.length("text") != F.col("old"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", changed).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    small_batches(spark)
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return rows.withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("secrets", no_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # classifier, fingerprints, repeats and packing are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
