"""The corpus pipeline: one function per stage, each calling one operator of
``ledgerlens.llm`` on everything the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import mixing, quality_rules, secret_scan, sentencepiece_codec, simhash
from ledgerlens.llm.common import drop_table, dropping, read, write_table
from ledgerlens.llm.vocabulary import load_pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that are rejected go."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every span found is masked in the text."""
    return secret_scan.mask(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: each document as often as the mix
    takes it; the one in which a source's last block ends, up to there."""
    return mixing.mixed_corpus(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: the ids of every text; decoding gives it back."""
    out = sentencepiece_codec.encode(docs, load_pieces(MODEL), carry=["doc_id", "source"])
    return out.select("row.doc_id", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing_sources),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# XXH64 fingerprints, connected components and tokenization are beyond SQL; the
# stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the table documents.  Each stage's tables go
    when its rows are written, and those when the next stage's are; what the last
    stage's rows are read from stays."""
    docs, path = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with dropping(spark):
            kept, written = write_table(stage(spark, docs, sf_dir))
        if path is not None:
            drop_table(spark, path)
        docs, path = kept, written
    return STAGES[-1][1](spark, docs, sf_dir)
