"""Corpus pipeline: from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read again.  All stages but the last
return the columns of ``documents`` (extra columns stay).

* quality: documents that the quality classifier rejects go;
* language: documents without a letter, or that no language's machine accepts, go;
* exact dedup: of equal texts the one with the most code points, then the
  smallest id stays;
* near dedup: of each component of near copies the row with the smallest id (then the
  smallest hash of its text) stays; a row whose id another row shares is judged by its
  own text; rows with a NULL id stay;
* packing: one row per piece with its sequence and offset.

An empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import exact_dedup, language_id, minhash, packing, quality_cnn
from runlens.llm.common import configure, documents, labels, materialize
from runlens.llm.queries import vocabulary

#: No SQL: three stages are learned or hashed models; tested against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_cnn.accept_quality(docs, quality_cnn.train_quality(docs, labels(spark, sf_dir)))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return language_id.accept_language(docs, language_id.train_language_id(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    # Rows are told apart by id and text, so a text that many documents share is not one key.
    key = [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
           exact_dedup.text_digest("text").alias("sha")]
    names = ["none", "id", "sha", "points"]
    own = exact_dedup.owners(docs).select(F.col("keep_id").alias("doc_id"), "text_sha256", "keep_points").select(
        *key[:2], F.col("text_sha256").alias("sha"), F.col("keep_points").alias("points"))
    # Whole rows travel in one column, so that no name of theirs can clash, and once;
    # an id may have several rows with this text: the longest of them, one of equal ones.
    points = F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint").alias("points")
    rows = docs.select(F.struct(*docs.columns).alias("row"), *key, points)
    return rows.join(own, names).dropDuplicates(names).select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), minhash.text_hash("text").alias("hash"))
    found = minhash.row_components(docs).select(F.col("doc_id").alias("id"), "hash", "component").filter(
        F.col("component").isNotNull()).distinct()
    # The first row by (id, hash) of each component stays; rows are told apart by both.
    first = found.groupBy("component").agg(F.min(F.struct("id", "hash")).alias("first"))
    gone = found.join(first, "component").filter(F.struct("id", "hash") != F.col("first")).select("id", "hash")
    return rows.join(gone, ["id", "hash"], "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last stage's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
