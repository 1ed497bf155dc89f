"""CSV files whose headers differ: one reader call per header, columns matched by name or place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# numeric types by width; two of them widen to the later one
_WIDTH = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
MATCHES = ("name", "position")


def header_groups(spark: SparkSession, path, encoding: str = "UTF-8") -> DataFrame:
    """(header, files, n_files) of the CSV files under a folder or glob: files are grouped by their first
    line. Each task keeps the first line of a file's first split only."""
    lines = spark.read.option("encoding", encoding).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    firsts = (lines.where("block = 0").withColumn("place", F.monotonically_increasing_id())
              .groupBy("file").agg(F.min_by("value", "place").alias("header")))
    return firsts.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files"), F.count(F.lit(1)).alias("n_files"))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: the wider number, else text. An untyped (all-null) column
    takes the other's type."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _WIDTH and type(b) in _WIDTH:
        both = {type(a), type(b)}
        if T.FloatType in both or T.LongType in both and T.DoubleType in both:
            return T.DoubleType()
        return a if _WIDTH.index(type(a)) > _WIDTH.index(type(b)) else b
    return T.StringType()


def read_by_header(spark: SparkSession, path, match: str | None = None, infer_schema: bool = True,
                   null_value: str = "", file_col: str | None = "source_file", **options) -> DataFrame:
    """All CSV files under a folder or glob as one frame, whatever the order of their columns.

    Files with one header are one reader call. Where headers differ, ``match`` must say how columns
    meet: ``"name"`` (a column that a file lacks is null) or ``"position"`` (all headers must be
    equally long; names are those of the first header by file path); without it, different headers raise.
    Types inferred for the groups widen: integers to the wider one, numbers to double, anything else to text.
    Only headers and file paths reach the driver."""
    if match not in (None, *MATCHES):
        raise ValueError(f"match must be one of {MATCHES}, not {match!r}")
    groups = sorted(header_groups(spark, path, options.get("encoding", "UTF-8")).collect(), key=lambda g: g.files[0])
    if not groups:
        raise ValueError(f"no CSV file with a header under {path}")
    if len(groups) > 1 and match is None:
        raise ValueError(f"{len(groups)} different headers under {path}: {groups[0].header!r} ({groups[0].files[0]}), "
                         f"{groups[1].header!r} ({groups[1].files[0]}); match them by name or position")
    reader = (spark.read.option("header", True).option("inferSchema", infer_schema).option("nullValue", null_value)
              .options(**options))
    frames = []
    for group in groups:
        frame = reader.csv(list(group.files))
        frames.append((frame.columns, frame.withColumn(file_col, F.col("_metadata.file_path")) if file_col else frame))
    if match == "position":
        names = frames[0][0]
        if any(len(columns) != len(names) for columns, _ in frames):
            raise ValueError(f"headers of different lengths under {path} cannot be matched by position")
        more = [file_col] if file_col else []
        frames = [(names, frame.toDF(*names, *more)) for _, frame in frames]
    names = list(dict.fromkeys(n for columns, _ in frames for n in columns))
    types = {n: reduce(wider, [f.schema[n].dataType for columns, f in frames if n in columns]) for n in names}

    def widened(columns, frame) -> DataFrame:
        out = [(F.col(f"`{n}`") if n in columns else F.lit(None)).cast(types[n]).alias(n) for n in names]
        return frame.select(*out, *([file_col] if file_col else []))

    return reduce(DataFrame.union, [widened(*f) for f in frames])
