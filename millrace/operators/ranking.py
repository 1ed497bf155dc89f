"""Places in one global order, without bringing rows to the driver or to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import shared_path


def global_row_number(df: DataFrame, order: Sequence[Column], col: str = "row_number") -> DataFrame:
    """``df`` with a column ``col``: 0, 1, 2 ... over all rows in ``order``, which should leave no ties.

    Rows are range-partitioned and numbered within their range; a range's offset is the
    sum of the sizes before it (one small row per range). The numbered rows are written
    to the shared folder, so ranges and offsets are of the same partitioning, whatever is lost
    or run again."""
    spark, taken = df.sparkSession, set(df.columns)
    part, place = (next(n for n in (name, *(f"{name}_{k}" for k in range(len(taken) + 1))) if n not in taken)
                   for name in ("range", "place"))
    path = shared_path(spark, "ranges")
    ranged = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    numbered = ranged.withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(*order)).cast("long"))
    numbered.write.parquet(path)
    held = spark.read.schema(numbered.schema).parquet(path)
    # one row per range: as many as the range partitioning has partitions
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.groupBy(part).agg(F.count(F.lit(1)).alias("size")).select(
        F.col(part), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    joined = held.join(offsets.withColumnRenamed("offset", f"{place}_offset"), part)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(f"{place}_offset") + F.col(place) - 1).alias(col))
