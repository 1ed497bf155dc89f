"""Feature-preparation queries (index, inverse index, one-hot, assemble,
bucketize, normalise)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import tokenize
from millrace.operators.features import (assemble, bucketize, index_category, index_distributed,
                                         index_to_label, indexer, normalize, one_hot, to_array)
from millrace.plans.lineitem_nb import NB_FEATURES
from millrace.plans.registry import query, table
from millrace.plans.text_queries import _LINES_SQL, _TOKENS_SQL

_IDX_SQL = """CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE)"""


def orders_with_segment(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                              "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey)


@query("index_category", sql=f"""
WITH j AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, c_mktsegment
           FROM orders JOIN customer ON o_custkey = c_custkey),
p AS (SELECT o_orderpriority, {_IDX_SQL.format(c='o_orderpriority')} AS priority_idx FROM j GROUP BY 1),
s AS (SELECT o_orderstatus, {_IDX_SQL.format(c='o_orderstatus')} AS status_idx FROM j GROUP BY 1),
m AS (SELECT c_mktsegment, {_IDX_SQL.format(c='c_mktsegment')} AS segment_idx FROM j GROUP BY 1)
SELECT o_orderkey, priority_idx, status_idx, segment_idx
FROM j JOIN p USING (o_orderpriority) JOIN s USING (o_orderstatus) JOIN m USING (c_mktsegment)
""")
def q_index_category(spark, sf_dir):
    df = orders_with_segment(spark, sf_dir)
    out = index_category(df, ["o_orderpriority", "o_orderstatus", "c_mktsegment"],
                         ["priority_idx", "status_idx", "segment_idx"])
    return out.select("o_orderkey", "priority_idx", "status_idx", "segment_idx")


@query("index_distributed", sql=f"""
WITH lines AS (SELECT doc_id, unnest({_LINES_SQL}) AS line FROM documents),
words AS (SELECT doc_id, unnest({_TOKENS_SQL}) AS word FROM lines),
r AS (SELECT word, {_IDX_SQL.format(c='word')} AS word_idx FROM words GROUP BY 1)
SELECT doc_id, word_idx, count(*) AS n FROM words JOIN r USING (word) GROUP BY ALL
""")
def q_index_distributed(spark, sf_dir):
    """Tokens of all documents by their rank in the corpus, a column of very many values."""
    words = tokenize(table(spark, sf_dir, "documents"), keep=["doc_id"])
    indexed = index_distributed(words, ["word"], ["word_idx"])
    return indexed.groupBy("doc_id", "word_idx").agg(F.count(F.lit(1)).alias("n"))


@query("index_to_label", sql=f"""
WITH p AS (SELECT o_orderpriority, {_IDX_SQL.format(c='o_orderpriority')} AS priority_idx
           FROM orders GROUP BY 1)
SELECT o_orderkey, priority_idx, o_orderpriority AS priority_label
FROM orders JOIN p USING (o_orderpriority)
""")
def q_index_to_label(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    model = indexer(["o_orderpriority"], ["priority_idx"]).fit(o)
    indexed = model.transform(o).drop("o_orderpriority")
    back = index_to_label(indexed, "priority_idx", "priority_label", model.labelsArray[0])
    return back.select("o_orderkey", "priority_idx", "priority_label")


@query("one_hot", sql=f"""
WITH p AS (SELECT o_orderpriority, {_IDX_SQL.format(c='o_orderpriority')} AS priority_idx
           FROM orders GROUP BY 1),
k AS (SELECT count(*) AS k FROM p)
SELECT o_orderkey, priority_idx,
       array_to_string(list_transform(range(k - 1),
                       lambda i: CASE WHEN i = priority_idx THEN 1 ELSE 0 END), ',') AS one_hot
FROM orders JOIN p USING (o_orderpriority), k
""")
def q_one_hot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    idx = index_category(o, ["o_orderpriority"], ["priority_idx"])
    enc = one_hot(idx, ["priority_idx"], ["priority_vec"])
    code = F.array_join(F.transform(to_array("priority_vec"),
                                    lambda x: x.cast("int").cast("string")), ",")
    return enc.select("o_orderkey", "priority_idx", code.alias("one_hot"))


@query("assemble", sql="""
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2,
       CAST(l_linenumber AS DOUBLE) AS f3
FROM lineitem
""")
def q_assemble(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    vec = to_array("features")
    return assemble(li, NB_FEATURES, "features").select(
        "l_orderkey", "l_linenumber", *[vec[i].alias(f"f{i}") for i in range(len(NB_FEATURES))])


# The fare split points of the bucketiser.
FARE_SPLITS = [0.0, 10.0, 20.0, 30.0, 40.0, float("inf")]


@query("bucketize", sql="""
WITH q AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity END AS l_quantity
           FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity,
       CAST(CASE WHEN l_quantity IS NULL THEN NULL WHEN l_quantity < 10 THEN 0
                 WHEN l_quantity < 20 THEN 1 WHEN l_quantity < 30 THEN 2
                 WHEN l_quantity < 40 THEN 3 ELSE 4 END AS DOUBLE) AS bucket
FROM q
""")
def q_bucketize(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    li = li.withColumn("l_quantity", F.when(F.col("l_linenumber") == 4, F.lit(None))
                       .otherwise(F.col("l_quantity")))
    return bucketize(li, "l_quantity", "bucket", FARE_SPLITS)


@query("normalize_l1", sql="""
SELECT l_orderkey, l_linenumber,
       round(l_quantity / (abs(l_quantity) + abs(l_discount) + abs(l_tax)), 9) AS n0,
       round(l_discount / (abs(l_quantity) + abs(l_discount) + abs(l_tax)), 9) AS n1,
       round(l_tax / (abs(l_quantity) + abs(l_discount) + abs(l_tax)), 9) AS n2
FROM lineitem
""")
def q_normalize_l1(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    vec = assemble(li, ["l_quantity", "l_discount", "l_tax"], "raw")
    arr = to_array("unit")
    return normalize(vec, "raw", "unit", p=1.0).select(
        "l_orderkey", "l_linenumber", *[F.round(arr[i], 9).alias(f"n{i}") for i in range(3)])
