"""A keyed table on plain files: upsert by key into hash buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_path

BUCKET = "key_bucket"


def _layout(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/layout")
    exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema("buckets INT, keys ARRAY<STRING>").json(f"{path}/layout").first() if exists else None


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that is last by ``order``, then by all columns, so the choice does not depend on
    partitions. Nulls come first in the order and are equal as keys. Rows are reduced in the map tasks first."""
    # maps cannot be compared; their entries can
    text = [F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.struct(*[F.col(f"`{c}`") for c in order], *text).alias("rank"),
                     *[F.col(f"`{c}`").alias(f"key_{k}") for k, c in enumerate(keys)])
    best = rows.groupBy(*[f"key_{k}" for k in range(len(keys))]).agg(F.max_by("row", "rank").alias("row"))
    return best.select("row.*")


def upsert_table(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64) -> None:
    """Write ``df`` into the table at ``path``: a row replaces the table's row with its key if it is newer by ``order``
    (a row that is equal in ``order`` is decided by all its columns).

    The table is dealt into ``buckets`` by a hash of the key. Only buckets that ``df`` touches are
    read, merged (with partial aggregates, so many versions of one key are one row per task) and replaced; the merge is
    written beside the table first, then put in place bucket by bucket. A run that fails in between leaves every bucket
    whole, old or new, and running it again gives the same table. One writer at a time."""
    spark, keys = df.sparkSession, list(keys)
    layout = _layout(spark, path)
    if layout is None:
        spark.createDataFrame([(buckets, keys)], "buckets INT, keys ARRAY<STRING>").coalesce(1).write.json(f"{path}/layout")
    elif (layout.buckets, layout["keys"]) != (buckets, keys):
        raise ValueError(f"the table at {path} has {layout.buckets} buckets by {layout['keys']}, not {buckets} by {keys}")
    if BUCKET in df.columns:
        raise ValueError(f"{BUCKET} is the table's own column")
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
    fresh = newest(df, keys, order).withColumn(BUCKET, bucket)
    staged = shared_path(spark, "upsert-fresh")
    fresh.write.parquet(staged)
    fresh = spark.read.schema(fresh.schema).parquet(staged)
    rows = read_table(spark, path, with_bucket=True)
    if rows is not None:
        touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most ``buckets``
        if rows.drop(BUCKET).schema.simpleString() != df.schema.simpleString():
            raise ValueError(f"the table at {path} has other columns: {rows.drop(BUCKET).schema.simpleString()}")
        both = rows.where(F.col(BUCKET).isin(touched)).unionByName(fresh)
        merged = newest(both.drop(BUCKET), keys, order).withColumn(BUCKET, bucket)
        staged = shared_path(spark, "upsert-merged")
        merged.write.parquet(staged)
        fresh = spark.read.schema(merged.schema).parquet(staged)
    (fresh.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(f"{path}/rows"))


def read_table(spark: SparkSession, path: str, with_bucket: bool = False) -> DataFrame | None:
    """The rows of a keyed table; None before the first write."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    rows = spark.read.parquet(f"{path}/rows")
    return rows if with_bucket else rows.drop(BUCKET)
