"""Registered queries of the training-data operators: each applies its operator
with production parameters to the whole intended table and returns all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (embedding_dedup, exact_dedup, language_id, license_scan, lm_score, minhash, packing, quality_cnn,
               sentencepiece_codec, spelling, token_output, toxicity_cnn, whitening)
from .common import configure, documents, labels

QueryFn = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the same on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_decode(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(documents(spark, sf_dir))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_cnn.score_quality(docs, quality_cnn.train_quality(docs, labels(spark, sf_dir)))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train_language_id(docs))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity_cnn.score_toxicity(docs, toxicity_cnn.train_toxicity(docs, labels(spark, sf_dir)))


def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir))


def queries() -> dict[str, QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        return run
    return {f.__name__: wrap(f) for f in (
        op1_license_scan, op2_sentencepiece, op3_lm_score, op4_embedding_dedup, op5_quality, op6_minhash,
        op7_language_id, op8_packing, op9_exact_dedup, op10_toxicity, op11_token_output,
        op12_whitening, op13_spelling)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express the result on whole tables."""
    return {"op1_license_scan": license_scan.license_sql(), "op9_exact_dedup": exact_dedup.exact_dedup_sql()}
