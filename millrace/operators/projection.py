"""Projection, derived columns, SQL over views, equality filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def project(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*cols)


def derive_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection."""
    return df.withColumns(dict(exprs))


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """SQL over frames bound by name (``{name}`` placeholders), no global view."""
    return spark.sql(sql, **frames)


def format_column(df: DataFrame, col: str | int, text: str, out: str | None = None) -> DataFrame:
    """``text + value`` for one column, addressed by name or by position."""
    name = df.columns[col] if isinstance(col, int) else col
    return df.select(F.concat(F.lit(text), F.col(name).cast("string")).alias(out or name))


def filter_equal(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows where both sides are equal (a null on either side never passes)."""
    return df.filter(F.col(left) == F.col(right))


def filter_not_equal(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows where the sides differ (a null on either side never passes)."""
    return df.filter(~(F.col(left) == F.col(right)))
