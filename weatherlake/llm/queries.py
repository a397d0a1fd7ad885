"""The operators applied to their whole tables, by query name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherlake.llm import (
    alignment, exact_dedup, language_id, mixing, near_dedup, ngram_model, piece_bpe, quality, secret_scan, sharding, source_audit, sql, surrogates, token_files,
)
from weatherlake.llm.common import stored
from weatherlake.session import scratch_path

SHARDS = 40
# Only for the query; a user passes a key of their own.
SURROGATE_KEY = "key of the query"
# The tokenizers' files, at the same place on all executors.
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(spark, documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_documents(documents(spark, sf_dir), tokenizer_path(PIECE_TOKENIZER))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace_entities(documents(spark, sf_dir), SURROGATE_KEY)
    return replaced.select("row.doc_id", *[name for name in replaced.columns if name != "row"])


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sharding.records_of(documents(spark, sf_dir))
    totals = stored(sharding.slot_totals(records), "slot-totals")
    path = scratch_path(spark, "slot-map")
    sharding.write_map(sharding.first_map(totals, SHARDS), path)
    return sharding.assign(records, totals, sharding.read_map(spark, path, 1)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
        "map_version",
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_model = language_id.fit_text_model(documents(spark, sf_dir))
    return language_id.identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), text_model)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(documents(spark, sf_dir)).select(
        "row.doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op8_ngram_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_model.train_and_score(documents(spark, sf_dir))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.mark_near_copies(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "source", "times"
    )


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_versions(documents(spark, sf_dir), scratch_path(spark, "secret-ledger"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (op1_quality_rules, op2_token_files, op3_sentencepiece, op4_surrogates, op5_sharding, op6_language_id, op7_exact_dedup, op8_ngram_model, op9_minhash, op10_mixing, op11_secret_scan, op12_alignment, op13_source_audit)
}
SQL: dict[str, str] = {"op1_quality_rules": sql.QUALITY, "op7_exact_dedup": sql.EXACT_DEDUP, "op11_secret_scan": sql.SECRETS, "op13_source_audit": sql.SOURCE_AUDIT}
