"""Union of many frames, seeded random splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import shared_path


def union_all(frames: Sequence[DataFrame], by_name: bool = False,
              allow_missing: bool = False) -> DataFrame:
    """Union (duplicates kept) by column position, or by name."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
    return reduce(DataFrame.union, frames)


def split_draw(seed: int, keys: Sequence[str]):
    """A number in [0, 1) from the key columns and the seed: the first 32 bits of
    their MD5. It depends on nothing else, so every job over the rows, on any
    partitioning, sees the same draw. Nulls count as a text of their own."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2 ** 32


def _free(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as ``df`` leaves free."""
    taken = {c.lower() for c in df.columns}
    before = "_"
    while any(before + n in taken for n in names):
        before += "_"
    return [before + n for n in names]


def tag_split(df: DataFrame, weights: Sequence[float], seed: int,
              names: Sequence[str] | None = None, col: str = "split",
              keys: Sequence[str] | None = None, tasks: int | None = None) -> DataFrame:
    """All rows with a column ``split`` naming their part (a column of that name is replaced, every
    other one is kept, whatever its name). Weights are normalised to
    sum 1. With ``keys`` it is one pass without a shuffle, and rows that agree in
    them go to the same part. Without, every row has a draw of its own: equal rows
    are numbered, and the draw is that of the whole row (columns of any type) and
    its number, which costs one aggregation by row; the rows leave in ``tasks`` parts (the
    session's number of shuffle partitions unless given)."""
    names = list(names or [f"part{i}" for i in range(len(weights))])
    total, below, part = float(sum(weights)), 0.0, F.lit(names[-1])
    cases = []
    for name, w in zip(names[:-1], weights):
        below += w / total
        cases.append((name, below))
    draw, row, number = _free(df, "draw", "row", "number")
    for name, bound in reversed(cases):
        part = F.when(F.col(draw) < bound, F.lit(name)).otherwise(part)
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != col.lower()]
    if not keys:
        df, keys = _numbered(df, row, number, tasks), [row, number]
    return df.withColumn(draw, split_draw(seed, keys)).select(*kept, part.alias(col))


COPIES_AT_ONCE, ROWS_A_TASK = 10_000, 500_000
# types whose equal values have one form, so grouping by them changes none
PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType,
         T.TimestampNTZType)


def _as_text(field: T.StructField):
    """Equal texts only for equal values."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column)
    if isinstance(field.dataType, T.AtomicType):
        return column.cast("string")
    return F.to_json(F.struct(column), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                                        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def _numbered(df: DataFrame, row: str, number: str, tasks: int | None = None) -> DataFrame:
    """``df`` with ``row``, a digest of all columns, and ``number``, which counts equal
    rows from 0. Copies are counted (in the map tasks first) and written out again
    in runs of ``COPIES_AT_ONCE``, dealt to ``tasks`` tasks. Their number is given to Spark, which
    would else put the few bytes of very many copies together in one task."""
    digest = F.sha2(F.to_json(F.array(*map(_as_text, df.schema.fields))), 256)
    named = [F.col(f"`{f.name}`").alias(f"_c{i}") for i, f in enumerate(df.schema.fields)]
    plain = [isinstance(f.dataType, PLAIN) for f in df.schema.fields]
    # plain columns are the same in all rows of a digest: as keys they are hashed, not sorted
    keys = ["_row", *[f"_c{i}" for i, p in enumerate(plain) if p]]
    rest = [F.first(f"_c{i}").alias(f"_c{i}") for i, p in enumerate(plain) if not p]
    counted = df.select(digest.alias("_row"), *named).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), *rest)
    last = F.col("_copies") - 1
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES_AT_ONCE))))
    begin = F.col("_run") * COPIES_AT_ONCE
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.repartition(tasks, "_row", "_run")
    return (dealt.withColumn("_number", F.explode(F.sequence(begin, F.least(last, begin + COPIES_AT_ONCE - 1))))
            .select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(df.columns)],
                    F.col("_row").alias(row), F.col("_number").alias(number)))


def random_split(df: DataFrame, weights: Sequence[float], seed: int,
                 keys: Sequence[str] | None = None) -> list[DataFrame]:
    """Seeded split into one frame per weight, by ``keys`` or row by row where none are named
    (``tag_split``).

    With keys each frame is a filter of the input. Without, the tagged rows are written once to the shared
    folder, a folder per part, and each frame reads its own: the shuffle that numbers equal rows is
    done once for all parts, when this is called. A task sorts its rows by part to write them, so the rows are
    counted first and dealt ``ROWS_A_TASK`` to a task. An empty table gives empty parts."""
    part, = _free(df, "part")
    tasks = None if keys else max(1, -(-df.count() // ROWS_A_TASK))
    tagged = tag_split(df, weights, seed, col=part, keys=keys, tasks=tasks)
    if not keys:
        path = shared_path(df.sparkSession, "split")
        tagged.write.partitionBy(part).parquet(path)
        tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    return [tagged.filter(F.col(part) == f"part{i}").drop(part) for i in range(len(weights))]
