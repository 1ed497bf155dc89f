"""Registering user functions by name (usable from SQL and the DataFrame API).

Prefer the built-in forms in ``millrace.functions.scalar``. When logic truly
has no built-in form, register a vectorised pandas UDF (Arrow batches), never
a row-at-a-time Python UDF.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf


def register_function(spark: SparkSession, name: str, fn: Callable, return_type: str):
    """Register ``fn`` (pandas Series -> Series) as a vectorised UDF named
    ``name``; returns the column function for DataFrame use."""
    udf = pandas_udf(fn, returnType=return_type)
    spark.udf.register(name, udf)
    return udf
