"""Missing-value queries. The driver tables hold no nulls, so each query
first injects nulls (or empty strings and NaN) with a key-based CASE."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.quality import (fill_all_numeric, fill_constants, impute_mean,
                                        missing_profile)
from millrace.plans.registry import query, table


def _null_when(cond, c):
    return F.when(cond, F.lit(None)).otherwise(F.col(c))


def lineitem_with_gaps(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return li.withColumns({
        "l_quantity": _null_when(F.col("l_linenumber") == 2, "l_quantity"),
        "l_extendedprice": _null_when(F.col("l_linenumber") == 5, "l_extendedprice"),
    })


@query("impute_mean", sql="""
WITH g AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS q,
                  CASE WHEN l_linenumber = 5 THEN NULL ELSE l_extendedprice END AS p
           FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round(coalesce(q, avg(q) OVER ()), 6) AS l_quantity,
       round(coalesce(p, avg(p) OVER ()), 6) AS l_extendedprice
FROM g
""")
def q_impute_mean(spark, sf_dir):
    out = impute_mean(lineitem_with_gaps(spark, sf_dir), ["l_quantity", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber",
                      F.round("l_quantity", 6).alias("l_quantity"),
                      F.round("l_extendedprice", 6).alias("l_extendedprice"))


def customer_with_gaps(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.withColumns({
        "c_nationkey": _null_when(F.col("c_custkey") % 7 == 1, "c_nationkey"),
        "c_acctbal": _null_when(F.col("c_custkey") % 9 == 2, "c_acctbal"),
        "c_mktsegment": _null_when(F.col("c_custkey") % 13 == 3, "c_mktsegment"),
    })


_CUSTOMER_GAPS_SQL = """
  (SELECT c_custkey, c_name,
          CASE WHEN c_custkey % 7 = 1 THEN NULL ELSE c_nationkey END AS c_nationkey,
          CASE WHEN c_custkey % 9 = 2 THEN NULL ELSE c_acctbal END AS c_acctbal,
          CASE WHEN c_custkey % 13 = 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment
   FROM customer)"""


@query("fill_all_numeric", sql=f"""
WITH g AS {_CUSTOMER_GAPS_SQL}, m AS (SELECT avg(c_acctbal) AS v FROM g)
SELECT c_custkey, c_name,
       coalesce(c_nationkey, CAST(trunc(m.v) AS INTEGER)) AS c_nationkey,
       round(coalesce(c_acctbal, m.v), 6) AS c_acctbal, c_mktsegment
FROM g, m
""")
def q_fill_all_numeric(spark, sf_dir):
    df = customer_with_gaps(spark, sf_dir)
    mean = df.agg(F.avg("c_acctbal")).first()[0]  # one scalar to the driver
    out = fill_all_numeric(df, mean)
    return out.withColumn("c_acctbal", F.round("c_acctbal", 6))


@query("fill_constants", sql=f"""
SELECT c_custkey, c_name, coalesce(c_nationkey, -1) AS c_nationkey,
       coalesce(c_acctbal, 0.0) AS c_acctbal, coalesce(c_mktsegment, 'UNKNOWN') AS c_mktsegment
FROM {_CUSTOMER_GAPS_SQL}
""")
def q_fill_constants(spark, sf_dir):
    return fill_constants(customer_with_gaps(spark, sf_dir),
                          {"c_nationkey": -1, "c_acctbal": 0.0, "c_mktsegment": "UNKNOWN"})


@query("missing_profile", sql=f"""
WITH g AS (SELECT c_custkey,
                  CASE WHEN c_custkey % 17 = 4 THEN '' ELSE c_name END AS c_name,
                  c_nationkey,
                  CASE WHEN c_custkey % 19 = 5 THEN 'nan'::DOUBLE ELSE c_acctbal END AS c_acctbal,
                  c_mktsegment
           FROM {_CUSTOMER_GAPS_SQL})
SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey_missing,
       count(*) FILTER (WHERE c_name IS NULL OR c_name = '') AS c_name_missing,
       count(*) FILTER (WHERE c_nationkey IS NULL) AS c_nationkey_missing,
       count(*) FILTER (WHERE c_acctbal IS NULL OR isnan(c_acctbal)) AS c_acctbal_missing,
       count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment = '') AS c_mktsegment_missing
FROM g
""")
def q_missing_profile(spark, sf_dir):
    df = customer_with_gaps(spark, sf_dir).withColumns({
        "c_name": F.when(F.col("c_custkey") % 17 == 4, F.lit("")).otherwise(F.col("c_name")),
        "c_acctbal": F.when(F.col("c_custkey") % 19 == 5, F.lit(float("nan")))
                      .otherwise(F.col("c_acctbal")),
    })
    return missing_profile(df)
