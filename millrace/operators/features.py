"""Feature preparation with Spark ML transformers.

Fitting an indexer or encoder is one distributed aggregation (value
counts); the fitted labels are small metadata. Vectors leave an operator as
``array<double>`` (``to_array``) so results stay plain SQL types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (Bucketizer, IndexToString, Normalizer, OneHotEncoder,
                                StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import global_row_number


def to_array(col: str | Column) -> Column:
    """ML vector -> ``array<double>``."""
    return vector_to_array(F.col(col) if isinstance(col, str) else col)


def to_vector(col: str | Column) -> Column:
    """``array<float|double>`` -> ML dense vector."""
    return array_to_vector(F.col(col) if isinstance(col, str) else col)


def indexer(inputs: Sequence[str], outputs: Sequence[str], handle_invalid: str = "error",
            order: str = "frequencyDesc") -> StringIndexer:
    """Category index by frequency (most frequent -> 0.0, ties by value).
    ``handle_invalid='keep'`` maps unseen values and nulls to an extra index,
    which streams need."""
    return StringIndexer(inputCols=list(inputs), outputCols=list(outputs),
                         handleInvalid=handle_invalid, stringOrderType=order)


def index_category(df: DataFrame, inputs: Sequence[str], outputs: Sequence[str],
                   handle_invalid: str = "error") -> DataFrame:
    return indexer(inputs, outputs, handle_invalid).fit(df).transform(df)


def label_ranks(df: DataFrame, col: str) -> DataFrame:
    """(``label``, ``index``) of all values of ``col``, the most frequent first, ties by value: what
    ``indexer`` fits, as a distributed table. Nulls have no label. Occurrences are counted
    with partial aggregates before any value is moved, so a value that fills a third of all rows is one row
    per task."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("label"))
              .agg(F.count(F.lit(1)).alias("n")))
    ranked = global_row_number(counts, [F.desc("n"), F.asc("label")], "index")
    return ranked.select("label", F.col("index").cast("double").alias("index"))


def index_distributed(df: DataFrame, inputs: Sequence[str], outputs: Sequence[str],
                      handle_invalid: str = "error", labels: Sequence[DataFrame] | None = None) -> DataFrame:
    """``index_category`` for columns of any number of values: the labels stay a table, which is
    joined back (Spark broadcasts a small one; a frequent value's rows are split by adaptive
    execution), so no list of labels reaches the driver.

    ``labels`` are ``label_ranks`` of another frame to index by. A null, or a value without a label, raises
    with ``error``, loses its row with ``skip``, and gets the number of labels with ``keep``."""
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError(f"handle_invalid must be error, skip or keep, not {handle_invalid!r}")
    names = list(df.columns)
    for k, (col, out) in enumerate(zip(inputs, outputs)):
        table = label_ranks(df, col) if labels is None else labels[k]
        key, index, size = (f"{out}__{x}" for x in ("label", "index", "size"))
        table = table.select(F.col("label").alias(key), F.col("index").alias(index))
        df = df.join(table, F.col(col).cast("string") == F.col(key), "inner" if handle_invalid == "skip" else "left")
        value = F.col(index)
        if handle_invalid == "error":
            value = F.coalesce(value, F.raise_error(F.concat(F.lit(f"{col} has no label for "), F.coalesce(
                F.col(col).cast("string"), F.lit("null")))).cast("double"))
        elif handle_invalid == "keep":
            df = df.crossJoin(F.broadcast(table.agg(F.count(F.lit(1)).cast("double").alias(size))))  # one row
            value = F.coalesce(value, F.col(size))
        names = [n for n in names if n != out] + [out]
        df = df.withColumn(out, value).select(*[F.col(f"`{n}`") for n in names])
    return df


def index_to_label(df: DataFrame, input_col: str, output_col: str,
                   labels: Sequence[str]) -> DataFrame:
    """Inverse of the index: index -> label text."""
    return IndexToString(inputCol=input_col, outputCol=output_col,
                         labels=list(labels)).transform(df)


def one_hot(df: DataFrame, inputs: Sequence[str], outputs: Sequence[str],
            drop_last: bool = True) -> DataFrame:
    """One-hot vectors; with ``drop_last`` the last category is all zeros."""
    enc = OneHotEncoder(inputCols=list(inputs), outputCols=list(outputs), dropLast=drop_last)
    return enc.fit(df).transform(df)


def assembler(inputs: Sequence[str], output: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    """Scalars and vectors into one vector; a null raises unless
    ``handle_invalid`` is 'skip' (drop row) or 'keep' (NaN)."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output,
                           handleInvalid=handle_invalid)


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return assembler(inputs, output, handle_invalid).transform(df)


def bucketize(df: DataFrame, input_col: str, output_col: str, splits: Sequence[float],
              handle_invalid: str = "error") -> DataFrame:
    """Bucket index on split points: buckets are left-closed, the last one
    closed on both ends."""
    return Bucketizer(inputCol=input_col, outputCol=output_col, splits=list(splits),
                      handleInvalid=handle_invalid).transform(df)


def normalize(df: DataFrame, input_col: str, output_col: str, p: float = 1.0) -> DataFrame:
    """Scale each vector to unit p-norm (a zero vector stays zero)."""
    return Normalizer(inputCol=input_col, outputCol=output_col, p=p).transform(df)


def scaler(input_col: str, output_col: str, with_mean: bool = True,
           with_std: bool = True) -> StandardScaler:
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean,
                          withStd=with_std)
