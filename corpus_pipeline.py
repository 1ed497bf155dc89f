"""From raw documents to token ids in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again,
and calls one operator of ``millrace.llm`` with its production parameters.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, exact_dedup, minhash, piece_codec, quality_mil
from millrace.llm.common import bounded_batches, bounded_reads, cut, table
from millrace.llm.queries_text import QUALITY_THRESHOLD, quality_model


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance classifier does not reject."""
    return quality_mil.keep_good(docs, quality_model(docs, table(spark, sf_dir, "labels")), QUALITY_THRESHOLD)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    bounded_batches(spark)
    return exact_dedup.drop_rows(docs, exact_dedup.mark_duplicates(*exact_dedup.earlier_batch(docs)))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the row with the smallest id."""
    bounded_batches(spark)
    return exact_dedup.drop_rows(docs, minhash.near_duplicates(docs, digests=True))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text_sha256): SentencePiece ids with merge-dropout, written,
    read again and decoded; the digest is that of the decoded text, which must be
    the encoded one."""
    bounded_batches(spark)
    bounded_reads(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.checked_pieces(cut(piece_codec.encode_pieces(docs, model, digests=True), "piece-ids"), model)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("MinHash near-dedup", near),
          ("benchmark decontamination", clean), ("SentencePiece encoding and decoding", tokens)]

# a learned classifier and a keyed tokenizer have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
