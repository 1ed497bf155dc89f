"""Projection, filter, SQL-view, scalar-function, aggregate, union and
split queries over the driver tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import scalar
from millrace.functions.registry import register_function
from millrace.operators.aggregates import filtered_counts, global_means, match_counts, ratios
from millrace.operators.projection import (derive_columns, filter_equal, filter_not_equal,
                                           format_column, project, run_sql)
from millrace.operators.sampling import random_split, tag_split, union_all
from millrace.plans.io_queries import CUSTOMER_LINE_SCHEMA, customer_lines
from millrace.plans.registry import query, table
from millrace.sources.files import parse_delimited


def lineitem_with_null_tax(spark, sf_dir):
    """lineitem with ``l_tax`` nulled on line 3 of every order (null probe)."""
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("l_tax", F.when(F.col("l_linenumber") == 3, F.lit(None))
                         .otherwise(F.col("l_tax")))


_NULL_TAX_SQL = """(SELECT * REPLACE (CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS l_tax)
   FROM lineitem)"""


@query("project", sql="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def q_project(spark, sf_dir):
    return project(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity"])


@query("derive_columns", sql="""
SELECT l_orderkey, l_linenumber,
       l_extendedprice * (1 - l_discount) AS revenue,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
       CAST(l_linenumber AS DOUBLE) AS line_double
FROM lineitem
""")
def q_derive_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = derive_columns(li, {
        "revenue": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "charge": F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),
        "line_double": scalar.to_double("l_linenumber"),
    })
    return out.select("l_orderkey", "l_linenumber", "revenue", "charge", "line_double")


@query("sql_view", sql="SELECT c_name AS name FROM customer")
def q_sql_view(spark, sf_dir):
    customers = parse_delimited(customer_lines(spark, sf_dir), CUSTOMER_LINE_SCHEMA)
    return run_sql(spark, "SELECT name FROM {customers}", customers=customers)


@query("format_column", sql="SELECT 'Name: ' || c_name AS name FROM customer")
def q_format_column(spark, sf_dir):
    customers = parse_delimited(customer_lines(spark, sf_dir), CUSTOMER_LINE_SCHEMA)
    return format_column(customers, "name", "Name: ")


@query("filter_match", sql=f"""
SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM {_NULL_TAX_SQL}
WHERE l_discount = l_tax
""")
def q_filter_match(spark, sf_dir):
    li = lineitem_with_null_tax(spark, sf_dir)
    return filter_equal(li, "l_discount", "l_tax").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("filter_mismatch", sql=f"""
SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM {_NULL_TAX_SQL}
WHERE NOT (l_discount = l_tax)
""")
def q_filter_mismatch(spark, sf_dir):
    li = lineitem_with_null_tax(spark, sf_dir)
    return filter_not_equal(li, "l_discount", "l_tax").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("global_mean", sql="""
SELECT round(avg(l_quantity), 6) AS l_quantity_mean,
       round(avg(l_extendedprice), 6) AS l_extendedprice_mean,
       round(avg(l_discount), 6) AS l_discount_mean,
       round(avg(l_tax), 6) AS l_tax_mean
FROM lineitem
""")
def q_global_mean(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    means = global_means(table(spark, sf_dir, "lineitem"), cols)
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


@query("match_counts", sql=f"""
SELECT count(*) AS n_total,
       count(*) FILTER (WHERE l_discount = l_tax) AS n_match,
       count(*) FILTER (WHERE NOT (l_discount = l_tax)) AS n_mismatch,
       count(*) FILTER (WHERE l_discount = 0.0 AND l_discount = l_tax) AS n_zero_match,
       count(*) FILTER (WHERE l_discount = 0.0 AND NOT (l_discount = l_tax)) AS n_zero_mismatch
FROM {_NULL_TAX_SQL}
""")
def q_match_counts(spark, sf_dir):
    li = lineitem_with_null_tax(spark, sf_dir)
    eq = F.col("l_discount") == F.col("l_tax")
    zero = F.col("l_discount") == 0.0
    return filtered_counts(li, {"n_match": eq, "n_mismatch": ~eq,
                                "n_zero_match": zero & eq, "n_zero_mismatch": zero & ~eq})


@query("match_ratio", sql=f"""
WITH c AS (SELECT count(*) AS n_total,
                  count(*) FILTER (WHERE l_discount = l_tax) AS n_match,
                  count(*) FILTER (WHERE NOT (l_discount = l_tax)) AS n_mismatch
           FROM {_NULL_TAX_SQL})
SELECT n_total, n_match, n_mismatch,
       CAST(n_match AS DOUBLE) / n_total AS n_match_ratio,
       CAST(n_mismatch AS DOUBLE) / n_total AS n_mismatch_ratio
FROM c
""")
def q_match_ratio(spark, sf_dir):
    counts = match_counts(lineitem_with_null_tax(spark, sf_dir), "l_discount", "l_tax")
    return ratios(counts, ["n_match", "n_mismatch"], "n_total")


@query("union_all", sql="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def q_union_all(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return union_all([c, s])


def split_sql(seed: int, weights, names, keys: str, source: str, cols: str | None = None) -> str:
    """The split by the MD5 of seed and keys, in DuckDB."""
    total, below, cases = float(sum(weights)), 0.0, ""
    for name, w in zip(names[:-1], weights):
        below += w / total
        cases += f" WHEN draw < {below!r} THEN '{name}'"
    return f"""SELECT * EXCLUDE draw, CASE{cases} ELSE '{names[-1]}' END AS split
    FROM (SELECT {cols or keys}, CAST('0x' || substr(md5(concat_ws('|', '{seed}', {keys})), 1, 8) AS BIGINT)
                 / CAST(4294967296 AS DOUBLE) AS draw FROM {source})"""


LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query("random_split", sql=split_sql(11, [0.8, 0.2], ["train", "test"], ", ".join(LINE_KEYS), "lineitem"))
def q_random_split(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    return tag_split(li, [0.8, 0.2], seed=11, names=["train", "test"], keys=LINE_KEYS)


FLAGS = ["l_returnflag", "l_linestatus"]
NUMBERED_SQL = f"""(SELECT *, row_number() OVER (PARTITION BY r) - 1 AS number
 FROM (SELECT {", ".join(FLAGS)}, sha256('["' || l_returnflag || '","' || l_linestatus || '"]') AS r FROM lineitem))"""


@query("random_split_rows", sql=split_sql(11, [0.7, 0.2, 0.1], ["part0", "part1", "part2"], "r, number",
                                          NUMBERED_SQL, ", ".join(FLAGS)))
def q_random_split_rows(spark, sf_dir):
    """Rows without a key, most of them equal to very many others, dealt one by one."""
    parts = random_split(table(spark, sf_dir, "lineitem").select(*FLAGS), [0.7, 0.2, 0.1], seed=11)
    return union_all([p.withColumn("split", F.lit(f"part{i}")) for i, p in enumerate(parts)])


@query("random_split_unnormalised",
       sql=split_sql(11, [0.3, 0.3], ["train", "test"], ", ".join(LINE_KEYS), "lineitem"))
def q_random_split_unnormalised(spark, sf_dir):
    """Weights that do not sum to 1 are shares of their sum."""
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    return tag_split(li, [0.3, 0.3], seed=11, names=["train", "test"], keys=LINE_KEYS)


@query("random_split_three_way",
       sql=split_sql(24, [0.8, 0.18, 0.02], ["train", "test", "unseen"], ", ".join(LINE_KEYS), "lineitem"))
def q_random_split_three_way(spark, sf_dir):
    """Three frames, each a filter of the same input, put together again."""
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    parts = random_split(li, [0.8, 0.18, 0.02], seed=24, keys=LINE_KEYS)
    return union_all([p.withColumn("split", F.lit(n)) for p, n in zip(parts, ["train", "test", "unseen"])])


# --- scalar functions -------------------------------------------------------

@query("fn_class_code", sql="""
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_returnflag IS NULL THEN NULL WHEN lower(l_returnflag) = 'a' THEN 0
                 WHEN lower(l_returnflag) = 'n' THEN 1 ELSE 2 END AS DOUBLE) AS class_code
FROM lineitem
""")
def q_fn_class_code(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     scalar.class_code("l_returnflag", ("A", "N")).alias("class_code"))


_AGE_SQL = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal / 100 END"


@query("fn_age_band", sql=f"""
SELECT c_custkey, CASE WHEN ({_AGE_SQL}) IS NULL THEN NULL
                       WHEN ({_AGE_SQL}) < 15 THEN 'Child' ELSE c_mktsegment END AS band
FROM customer
""")
def q_fn_age_band(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    age = F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_acctbal") / 100)
    return c.select("c_custkey", scalar.age_band("c_mktsegment", age).alias("band"))


@query("fn_sum_flag", sql="""
SELECT l_orderkey, l_linenumber,
       CAST(l_linenumber + CAST(l_quantity AS INTEGER) % 4 > 3 AS DOUBLE) AS family_flag
FROM lineitem
""")
def q_fn_sum_flag(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    b = F.col("l_quantity").cast("int") % 4
    return li.select("l_orderkey", "l_linenumber",
                     scalar.sum_flag("l_linenumber", b).alias("family_flag"))


@query("fn_to_double", sql="""
SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS nation_double FROM customer
""")
def q_fn_to_double(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", scalar.to_double("c_nationkey").alias("nation_double"))


# Salutations mixed into customer names for the title query,
# including ones that fold (Don., Major., Capt., Mlle., Mme.) and ones that
# must not match (Dona., Prof.).
SALUTATIONS = ["Mr.", "Mrs.", "Miss.", "Master.", "Dr.", "Rev.", "Col.", "Ms.", "Don.",
               "Major.", "Capt.", "Mlle.", "Mme.", "Lady.", "Sir.", "Dona.", "Prof.", ""]


def _titled_names(c):
    arr = F.array(*[F.lit(s) for s in SALUTATIONS])
    sal = F.element_at(arr, (F.pmod(F.col("c_custkey"), F.lit(len(SALUTATIONS))) + 1).cast("int"))
    return F.concat(F.col("c_name"), F.lit(", "), sal, F.lit(" "), F.col("c_mktsegment"))


def _salutation_sql():
    items = ", ".join("'" + s + "'" for s in SALUTATIONS)
    return f"([{items}])[c_custkey % {len(SALUTATIONS)} + 1]"


@query("fn_regex_title", sql=f"""
WITH n AS (SELECT c_custkey, c_name || ', ' || {_salutation_sql()} || ' ' || c_mktsegment AS name
           FROM customer),
     t AS (SELECT c_custkey, name,
                  CASE WHEN regexp_extract(name, '{scalar.TITLE_PATTERN}', 0) = '' THEN 'Other.'
                       ELSE regexp_extract(name, '{scalar.TITLE_PATTERN}', 0) END AS hit
           FROM n)
SELECT c_custkey, name,
       CASE WHEN hit IN ('Don.', 'Major.', 'Capt.') THEN 'Sir.'
            WHEN hit IN ('Mlle.', 'Mme.') THEN 'Miss.' ELSE hit END AS title
FROM t
""")
def q_fn_regex_title(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    named = c.select("c_custkey", _titled_names(c).alias("name"))
    return named.select("c_custkey", "name", scalar.title("name").alias("title"))


@query("fn_constant", sql="SELECT o_orderkey, 0.0::DOUBLE AS survived FROM orders")
def q_fn_constant(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", scalar.constant(0.0).alias("survived"))


@query("fn_add", sql="""
SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS total
FROM customer
""")
def q_fn_add(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    other = F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_nationkey"))
    return c.select("c_custkey", scalar.add("c_acctbal", other).alias("total"))


def _flag_code(s: pd.Series) -> pd.Series:
    """Vectorised class code of a return flag (A -> 0, N -> 1, else 2)."""
    low = s.str.lower()
    return low.map({"a": 0.0, "n": 1.0}).fillna(2.0).where(s.notna(), None).astype("float64")


@query("udf_surface", sql="""
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_returnflag IS NULL THEN NULL WHEN lower(l_returnflag) = 'a' THEN 0
                 WHEN lower(l_returnflag) = 'n' THEN 1 ELSE 2 END AS DOUBLE) AS flag_code
FROM lineitem
""")
def q_udf_surface(spark, sf_dir):
    register_function(spark, "flag_code", _flag_code, "double")
    return run_sql(spark, "SELECT l_orderkey, l_linenumber, flag_code(l_returnflag) AS flag_code "
                          "FROM {li}", li=table(spark, sf_dir, "lineitem"))
