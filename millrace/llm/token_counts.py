"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once; only their lengths survive, aggregated to one
row per distinct length (partial aggregates before the shuffle, so equal
lengths never meet as rows). Suffix sums over the histogram then answer, for
every context limit: how many documents and tokens lie beyond it, the
total after truncating every document to it, and the quantile it is.

The sums run block by block: lengths are grouped into blocks of ``BLOCK``,
the few block totals are summed over all blocks, and a window inside each
block adds the rest, so no task holds the whole histogram.

Edge cases: a null or empty text has length 0 and counts as a document; ids
are not read, so null ids, ties and repeated rows all count; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def rank_file_counter(path: str, pattern: str) -> Callable[[list[str]], list[int]]:
    """Token counts under a byte-level BPE given as a rank file; strings of
    special tokens are ordinary text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]


def token_lengths(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """One ``n_tokens`` per document; ``path`` must be readable on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = rank_file_counter(path, pattern)
        for batch in batches:
            lengths = count([t or "" for t in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["n_tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame, col: str = "n_tokens") -> DataFrame:
    """(n_tokens, n_docs), one row per distinct length; null lengths count as 0."""
    return (lengths.groupBy(F.coalesce(F.col(col), F.lit(0)).cast("long").alias("n_tokens"))
            .agg(F.count("*").alias("n_docs")))


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per distinct length taken as the context limit:

    n_docs, docs_over, tokens_over  documents of that length; documents longer
                                    than the limit and all their tokens
    total_docs, total_tokens        the corpus
    truncated_tokens                sum over documents of min(length, limit)
    docs_within, quantile           documents that fit, also as a share
    """
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / block)) \
                    .withColumn("tokens", F.col("n_docs") * F.col("n_tokens"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    # one row per block of lengths: as many as the longest document has blocks
    after = Window.partitionBy(F.lit(0)).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    blocks = blocks.select(
        "block", F.coalesce(F.sum("b_docs").over(after), F.lit(0)).alias("a_docs"),
        F.coalesce(F.sum("b_tokens").over(after), F.lit(0)).alias("a_tokens"),
        F.sum("b_docs").over(whole).alias("total_docs"), F.sum("b_tokens").over(whole).alias("total_tokens"))
    longer = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.join(blocks, "block")
            .withColumn("docs_over", F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("a_docs"))
            .withColumn("tokens_over", F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("a_tokens")))
    return rows.select(
        "n_tokens", "n_docs", "docs_over", "tokens_over", "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens"))
        .alias("truncated_tokens"),
        (F.col("total_docs") - F.col("docs_over")).alias("docs_within"),
        ((F.col("total_docs") - F.col("docs_over")) / F.col("total_docs")).alias("quantile"))


def limits(sums: DataFrame, context_limits: list[int]) -> DataFrame:
    """The totals at any stated limits, not only at lengths that occur: the
    largest length not above a limit carries its suffix sums, and each
    document beyond it contributes the limit itself."""
    total_docs, total_tokens = (F.coalesce(F.max(c), F.lit(0)) for c in ("total_docs", "total_tokens"))
    answers = []
    for limit in context_limits:
        at = F.when(F.col("n_tokens") <= limit, F.col("n_tokens"))
        docs_over = F.coalesce(F.max_by("docs_over", at), total_docs)
        tokens_over = F.coalesce(F.max_by("tokens_over", at), total_tokens)
        answers.append(F.struct(F.lit(int(limit)).cast("long").alias("context_limit"),
                                docs_over.alias("docs_over"),
                                (total_tokens - tokens_over + docs_over * limit).alias("truncated_tokens")))
    return sums.agg(F.array(*answers).alias("a")).select(F.inline("a"))


def length_quantile(sums: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share ``q`` of the documents fit in."""
    return sums.where(F.col("docs_within") >= F.ceil(F.col("total_docs") * q)).agg(F.min("n_tokens").alias("n_tokens"))
