"""Query registry: name -> (Spark builder, oracle SQL or None).

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the driver
tables; its DuckDB oracle sits next to it so both are reviewed together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    fn: QueryFn
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None = None, note: str = ""):
    """Register a query under ``name`` with its oracle SQL (None = rows only)."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Registered(name, fn, sql.strip() if sql else None, note)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (one parquet file per table)."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")
