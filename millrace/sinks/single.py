"""One CSV file from many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.session import shared_path


def write_single_csv(df: DataFrame, path: str, header: bool = True, **options) -> None:
    """One CSV file at ``path`` (a file, not a folder) with the rows in the frame's order.

    Tasks write part files in parallel, without headers; the parts are then joined on storage in their order: bytes go
    from file to file in the driver's JVM through one small buffer, nothing is parsed or held. The joined
    file has another name until it is whole, so a failure leaves no half file at ``path``; a file
    that is there is replaced at the end."""
    spark = df.sparkSession
    staged = shared_path(spark, "single-csv")
    df.write.option("header", False).options(**options).csv(f"{staged}/parts")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file_of = jvm.org.apache.hadoop.fs.Path
    target, parts = file_of(path), file_of(f"{staged}/parts")
    source, goal = parts.getFileSystem(conf), target.getFileSystem(conf)
    half = file_of(f"{path}.{staged.rsplit('-', 1)[-1]}.half")
    names = sorted(s.getPath().toString() for s in source.listStatus(parts) if s.getPath().getName().startswith("part-"))
    if header:
        # the header as Spark's own writer spells it, with the same options
        spark.createDataFrame([], df.schema).coalesce(1).write.option("header", True).options(**options).csv(f"{staged}/head")
        head = file_of(f"{staged}/head")
        names = [s.getPath().toString() for s in source.listStatus(head) if s.getPath().getName().startswith("part-")] + names
    out = goal.create(half, True)
    try:
        for name in names:
            part = source.open(file_of(name))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
            finally:
                part.close()
    except Exception:
        out.close()
        goal.delete(half, False)
        raise
    out.close()
    if goal.exists(target):
        goal.delete(target, False)
    if not goal.rename(half, target):
        raise OSError(f"cannot rename {half.toString()} to {path}")
