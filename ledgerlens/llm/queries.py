"""The registered queries of the subpackage: each applies one operator to its
whole table with production parameters and derives the stated columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    html_text,
    merkle,
    mixing,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    sharding,
    simhash,
    substring_dedup,
    token_counts,
    topk,
    url_filter,
    whitening,
)
from ledgerlens.llm.common import read
from ledgerlens.llm.vocabulary import load_pieces

# A public SentencePiece model with byte pieces.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", "q.base_failed", "kept")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "pattern")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(read(spark, sf_dir, "documents"))
    digest = F.sha2(secret_scan.joined("base"), 256)
    return out.select("row.doc_id", "n_assign", "n_access", "n_hex", digest.alias("base_sha256"), secret_scan.joined("spans").alias("spans"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), MODEL)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read(spark, sf_dir, "documents"), carry=["doc_id"])
    none = F.lit(None).cast("int").alias("grown_shard")
    return out.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read(spark, sf_dir, "documents"), carry=["doc_id"])
    taken = F.col("size") * F.col("whole") + F.col("part")
    return out.select("row.doc_id", "size", "source_size", "target", taken.alias("taken"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece_codec.encode(read(spark, sf_dir, "documents"), load_pieces(MODEL), carry=["doc_id"])
    return out.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.groups(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(read(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return out.select("row.page_id", "row.url", "text", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_secret_scans": op5_secret_scans,
    "op6_token_counts": op6_token_counts,
    "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_whitening": op12_whitening,
    "op13_html_extraction": op13_html_extraction,
}
