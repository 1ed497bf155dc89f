"""Source and sink queries. Round trips write to a fresh folder below the
shared checkpoint folder and read the files back with the operator under
test, so the value check covers writer and reader together."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import count_by_key, token_count
from millrace.plans.registry import query, table
from millrace.plans.text_queries import _LINES_SQL, _TOKENS_SQL
from millrace.session import shared_path
from millrace.sinks.keyed import read_table, upsert_table
from millrace.sinks.single import write_single_csv
from millrace.sinks.files import write_csv, write_table, write_tuples_text
from millrace.sources.headers import read_by_header
from millrace.sources.files import (conform, from_rows, parse_delimited, read_csv,
                                    read_csv_schema, read_lines, read_many)

CUSTOMER_LINE_SCHEMA = ("customer_id INT, name STRING, nation INT, balance DOUBLE, "
                        "segment STRING")


def customer_lines(spark, sf_dir):
    """``customer`` as comma-separated text lines (``value``)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                "c_mktsegment").alias("value"))


@query("src_text_lines", sql="""
SELECT line, count(*) AS n
FROM (SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
GROUP BY line
""")
def q_src_text_lines(spark, sf_dir):
    path = shared_path(spark, "text-lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    lines = read_lines(spark, path)
    return count_by_key(lines.withColumnRenamed("value", "line"), "line")


@query("src_csv_inferred", sql="""
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def q_src_csv_inferred(spark, sf_dir):
    path = shared_path(spark, "csv-inferred")
    write_csv(table(spark, sf_dir, "supplier"), path, header=True)
    return read_csv(spark, path)


@query("src_csv_schema", sql="""
SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem
""")
def q_src_csv_schema(spark, sf_dir):
    path = shared_path(spark, "csv-schema")
    cols = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    write_csv(table(spark, sf_dir, "lineitem").select(*cols), path, header=False)
    schema = ("l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, "
              "l_extendedprice DOUBLE, l_returnflag STRING")
    # declared schema on read, then the typed-view check (D3)
    return conform(read_csv_schema(spark, path, schema, mode="FAILFAST"), schema)


@query("parse_delimited", sql="""
SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS name, c_nationkey AS nation,
       c_acctbal AS balance, c_mktsegment AS segment FROM customer
""")
def q_parse_delimited(spark, sf_dir):
    return parse_delimited(customer_lines(spark, sf_dir), CUSTOMER_LINE_SCHEMA, strict=True)


# A small code table for the literal-rows query.
REGION_CODES = [(0, "AFR"), (1, "AMR"), (2, "ASA"), (3, "EUR"), (4, "MEA")]


@query("literal_rows", sql="""
WITH codes(r_regionkey, code) AS (VALUES (0, 'AFR'), (1, 'AMR'), (2, 'ASA'), (3, 'EUR'), (4, 'MEA'))
SELECT code, count(*) AS n_customers
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN codes ON n_regionkey = r_regionkey
GROUP BY code
""")
def q_literal_rows(spark, sf_dir):
    codes = from_rows(spark, REGION_CODES, "r_regionkey INT, code STRING")
    nation = table(spark, sf_dir, "nation")
    cust = table(spark, sf_dir, "customer").select("c_nationkey")
    # Spark sizes both sides in bytes and broadcasts the small ones
    keyed = (nation.join(codes, nation.n_regionkey == codes.r_regionkey)
             .select("n_nationkey", "code"))
    return (cust.join(keyed, cust.c_nationkey == keyed.n_nationkey)
            .groupBy("code").agg(F.count(F.lit(1)).alias("n_customers")))


@query("multi_file_ingest", sql="""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def q_multi_file_ingest(spark, sf_dir):
    path = shared_path(spark, "many-files")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    # one folder of files per order status: several files whatever the layout
    orders.write.partitionBy("o_orderstatus").option("header", True).csv(path)
    found = read_many(spark, path, file_col=None)
    return found.select(*orders.columns)


def _rises(file_a, key_a, file_b, key_b):
    return (file_a < file_b) | ((file_a == file_b) & (key_a < key_b))


def in_file_order(rows):
    """Per priority: n, first_key, last_key and whether (source_file, o_orderkey) rise with
    ``place``: neighbours within each ``part`` of the read, and the first row of a part
    against the last of the one before (one small row per part)."""
    before = Window.partitionBy("part").orderBy("place")
    steps = rows.select("o_orderpriority", "o_orderkey", F.lit(1).cast("long").alias("counted"), F.coalesce(
        _rises(F.lag("source_file").over(before), F.lag("o_orderkey").over(before),
               F.col("source_file"), F.col("o_orderkey")), F.lit(True)).alias("rises"))
    row = F.struct("source_file", "o_orderkey", "o_orderpriority")
    edges = (rows.groupBy("part").agg(F.min_by(row, "place").alias("top"), F.max_by(row, "place").alias("end"))
             .withColumn("above", F.lag("end").over(Window.orderBy("part"))))
    borders = edges.select(
        F.col("top.o_orderpriority").alias("o_orderpriority"), F.lit(None).cast(rows.schema["o_orderkey"].dataType)
        .alias("o_orderkey"), F.lit(0).cast("long").alias("counted"), F.coalesce(
            _rises(F.col("above.source_file"), F.col("above.o_orderkey"),
                   F.col("top.source_file"), F.col("top.o_orderkey")), F.lit(True)).alias("rises"))
    return steps.unionByName(borders).groupBy("o_orderpriority").agg(
        F.sum("counted").alias("n"), F.min("o_orderkey").cast("long").alias("first_key"),
        F.max("o_orderkey").cast("long").alias("last_key"), F.min("rises").alias("in_file_order"))


@query("ordered_ingest", sql="""
SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
       true AS in_file_order
FROM orders GROUP BY o_orderpriority
""")
def q_ordered_ingest(spark, sf_dir):
    """Files read in the order of their names, their rows in the order in which
    they were written: files and, within a file, keys must rise."""
    path = shared_path(spark, "ordered-files")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    # ranges: a priority is written by many tasks, and its files' names rise with the keys
    (orders.repartitionByRange("o_orderpriority", "o_orderkey").sortWithinPartitions("o_orderpriority", "o_orderkey")
     .write.partitionBy("o_orderpriority").option("header", True).csv(path))
    rows = read_many(spark, path, ordered=True).select(
        "o_orderpriority", "o_orderkey", "source_file", F.monotonically_increasing_id().alias("place"),
        F.spark_partition_id().alias("part"))
    # written, so that rows and borders are of the same read
    held = shared_path(spark, "ordered-rows")
    rows.write.parquet(held)
    return in_file_order(spark.read.schema(rows.schema).parquet(held))


@query("sink_text", sql=f"""
WITH lines AS (SELECT unnest({_LINES_SQL}) AS line FROM documents),
     words AS (SELECT unnest({_TOKENS_SQL}) AS word FROM lines),
     counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)
SELECT '(' || word || ',' || CAST(n AS VARCHAR) || ')' AS value FROM counts
""")
def q_sink_text(spark, sf_dir):
    path = shared_path(spark, "tuples-text")
    write_tuples_text(token_count(table(spark, sf_dir, "documents")), path, ["word", "n"])
    return read_lines(spark, path)


@query("sink_csv", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem
""")
def q_sink_csv(spark, sf_dir):
    path = shared_path(spark, "csv-sink")
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    write_csv(df, path, header=True)
    return read_csv_schema(spark, path, df.schema, header=True)


@query("sink_table", sql="SELECT c_name, c_nationkey FROM customer")
def q_sink_table(spark, sf_dir):
    path = shared_path(spark, "keyed-table")
    write_table(table(spark, sf_dir, "customer").select("c_name", "c_nationkey"), path)
    return spark.read.parquet(path)


@query("multi_file_headers", sql="""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_custkey AS o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders
""")
def q_multi_file_headers(spark, sf_dir):
    """Three folders of CSV files with the same columns in three orders, one of them without the
    priority, matched by name."""
    path = shared_path(spark, "header-orders")
    orders = table(spark, sf_dir, "orders")
    for status, columns in (("O", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]),
                            ("F", ["o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey", "o_orderkey"]),
                            ("P", ["o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice"])):
        write_csv(orders.where(F.col("o_orderstatus") == status).select(*columns), f"{path}/{status}")
    found = read_by_header(spark, f"{path}/*", match="name", file_col=None)
    return found.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast(orders.schema["o_custkey"].dataType),
                        F.col("o_totalprice").cast("double"), "o_orderpriority", "o_orderstatus")


@query("sink_upsert", sql="""
SELECT o_custkey, last_order, total, source FROM (
  SELECT o_custkey, o_orderkey AS last_order, o_totalprice AS total,
         CASE WHEN o_orderkey % 2 = 0 THEN 'first' ELSE 'second' END AS source,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k FROM orders) WHERE k = 1
""")
def q_sink_upsert(spark, sf_dir):
    """Two writes with overlapping keys: of each customer the newest order stays."""
    path = shared_path(spark, "upsert-table")
    orders = table(spark, sf_dir, "orders")
    for k, name in enumerate(("first", "second")):
        part = orders.where(F.col("o_orderkey") % 2 == k).select(
            "o_custkey", F.col("o_orderkey").alias("last_order"), F.col("o_totalprice").alias("total"), F.lit(name).alias("source"))
        upsert_table(part, path, ["o_custkey"], ["last_order"], buckets=16)
    return read_table(spark, path)


@query("sink_csv_single", sql="""
SELECT CAST(count(*) AS BIGINT) AS line_no, 'l_orderkey,l_linenumber,l_returnflag' AS head, true AS in_order FROM lineitem
""")
def q_sink_csv_single(spark, sf_dir):
    """One file of sorted rows, written by many tasks: rows after the header, the header, and whether
    no row has a lower key than the row before it in the file (within each split that is read)."""
    path = f"{shared_path(spark, 'one-csv')}.csv"
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    write_single_csv(rows.orderBy("l_orderkey", "l_linenumber"), path)
    lines = read_lines(spark, path).select("value", F.monotonically_increasing_id().alias("place"),
                                           F.spark_partition_id().alias("part"))
    head = F.col("place") == 0
    parts = F.split("value", ",")
    key = F.when(~head, parts[0].cast("long") * 1000 + parts[1].cast("long"))
    before = Window.partitionBy("part").orderBy("place")
    told = lines.select(head.alias("first"), "value", F.coalesce(F.lag(key).over(before) <= key, F.lit(True)).alias("rises"))
    return told.agg(F.count_if(~F.col("first")).alias("line_no"), F.max(F.when(F.col("first"), F.col("value"))).alias("head"),
                    F.min("rises").alias("in_order"))
