"""Queries of the operators that read texts one by one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import piece_codec, quality_mil, secret_scan, token_counts
from millrace.llm.common import cut, table


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(table(spark, sf_dir, "documents"),
                                         public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    # written once: the block totals and the rows both read it
    return token_counts.suffix_sums(cut(token_counts.length_histogram(lengths), "length-histogram"))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded with dropout, written, and decoded from the written ids."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = cut(piece_codec.encode_pieces(table(spark, sf_dir, "documents"), model), "piece-ids")
    return piece_codec.decode_pieces(encoded, model).drop("text")


QUALITY_THRESHOLD, HELD_OUT = 0.3, 5


def held_out(id_col: str = "doc_id"):
    """Whether an id belongs to the fifth of the rows that never train."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_mil.Model:
    return quality_mil.train(*quality_mil.training_bags(docs, labels.where(~held_out())))


def op7_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = quality_mil.score_documents(docs, quality_model(docs, labels))
    return scores.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op4_piece_codec": op4_piece_codec, "op7_quality_mil": op7_quality_mil,
           "op6_secret_scan": op6_secret_scan, "op10_token_counts": op10_token_counts}
ORACLES: dict[str, str] = {}
