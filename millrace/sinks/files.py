"""File and table sinks.

Writers are distributed: each task writes its own part file. A single
output file (``single_file=True``) funnels all rows through one task and is
only for small results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tuple_text(cols: Sequence[str]):
    """The text form of a JVM tuple, ``(a,b,...)`` (``null`` for nulls)."""
    return F.format_string("(" + ",".join(["%s"] * len(cols)) + ")",
                           *[F.col(c).cast("string") for c in cols])


def write_tuples_text(df: DataFrame, path: str, cols: Sequence[str] | None = None,
                      mode: str = "overwrite") -> None:
    """One ``(k,v)`` text line per row, one part file per partition."""
    cols = list(cols or df.columns)
    df.select(tuple_text(cols).alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False,
              mode: str = "overwrite", **options) -> None:
    """CSV with a header row. ``single_file`` writes one part file through
    one task, which reads the partitions in their order (a sort's order is kept);
    what comes after the last shuffle runs in that task too."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", header).options(**options).csv(path)


def write_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "append",
                dedupe: Sequence[str] | None = None, partition_by: Sequence[str] | None = None,
                **options) -> None:
    """Keyed result sink: a path (contains ``/`` or ``:``) or a catalog table.

    ``dedupe`` keeps one (arbitrary) row per key within this frame only;
    keys already in an appended-to target are not replaced. Use
    ``mode='overwrite'``, or a table format with MERGE, for upsert semantics.
    Default is append, duplicates kept.
    """
    out = df.dropDuplicates(list(dedupe)) if dedupe else df
    writer = out.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target or ":" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)
