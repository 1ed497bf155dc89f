"""Payload and streaming queries.

Streams read a landing folder that Spark writes from a driver table (the
stand-in for a topic), run with ``availableNow`` into a checkpointed sink,
and the query returns the sink's files read back as a batch frame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.operators.models import load_model, save_model
from millrace.plans.lineitem_nb import nb_fit, nb_input, nb_sql
from millrace.plans.registry import query, table
from millrace.session import shared_path
from millrace.streaming.payload import decode_payload, encode_payload
from millrace.streaming.recovery import (committed, decode_with_rejects, load_current, publish_model,
                                         read_committed)
from millrace.streaming.streams import (for_each_batch, open_topic, publish_topic, score_stream,
                                        to_memory, to_parquet)

PRICE_FIELDS = "l_quantity DOUBLE NOT NULL, l_extendedprice DOUBLE NOT NULL, " \
               "l_discount DOUBLE NOT NULL, l_tax DOUBLE NOT NULL"
PRICE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
USER_FIELDS = "id INT NOT NULL, name STRING NOT NULL, email STRING"
FILES_PER_TRIGGER = 64  # a micro-batch is this many files, whatever the folder holds


def landed(spark, df, label):
    """``df`` published to a folder, one file per partition, and its stream."""
    path = shared_path(spark, label)
    publish_topic(df, label, "parquet", path=path)
    return open_topic(spark, label, "parquet", path=path, maxFilesPerTrigger=FILES_PER_TRIGGER)


@query("payload_round_trip", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
""")
def q_payload_round_trip(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    enc = encode_payload(li, PRICE_COLS, keep=["l_orderkey", "l_linenumber"], schema=PRICE_FIELDS, fmt="fixed")
    return decode_payload(enc, "value", PRICE_FIELDS, keep=["l_orderkey", "l_linenumber"], fmt="fixed")


def customer_users(spark, sf_dir):
    """customer as user records: id, name and a nullable e-mail."""
    c = table(spark, sf_dir, "customer")
    email = F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).otherwise(
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")))
    return c.select(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"),
                    email.alias("email"))


@query("payload_round_trip_records", sql="""
SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name,
       CASE WHEN c_custkey % 4 = 0 THEN NULL
            ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email
FROM customer
""")
def q_payload_round_trip_records(spark, sf_dir):
    users = customer_users(spark, sf_dir)
    enc = encode_payload(users, ["id", "name", "email"], schema=USER_FIELDS, fmt="json")
    return decode_payload(enc, "value", USER_FIELDS, fmt="json")


_EVENT_COLS = ["event_id", "user_id", "event_type", "value", "props"]


@query("stream_source", sql="SELECT event_id, user_id, event_type, value, props FROM events")
def q_stream_source(spark, sf_dir):
    stream = landed(spark, table(spark, sf_dir, "events").select(*_EVENT_COLS), "events")
    out, ckpt = shared_path(spark, "events-sink"), shared_path(spark, "events-ckpt")
    to_parquet(stream, out, ckpt)
    return spark.read.parquet(out)


_LINE_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"]


@query("stream_to_parquet", sql=f"SELECT {', '.join(_LINE_COLS)} FROM lineitem")
def q_stream_to_parquet(spark, sf_dir):
    stream = landed(spark, table(spark, sf_dir, "lineitem").select(*_LINE_COLS), "lines")
    out, ckpt = shared_path(spark, "lines-sink"), shared_path(spark, "lines-ckpt")
    to_parquet(stream, out, ckpt)
    return spark.read.parquet(out)


def status_counts_sink(path: str):
    """foreachBatch body: per micro-batch counts by order status, written to
    ``path/batch_id=N`` (overwrite, so a replayed batch is idempotent)."""

    def write(batch_df, batch_id):
        counts = batch_df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


@query("stream_foreach_batch", sql="""
SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus
""")
def q_stream_foreach_batch(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    stream = landed(spark, orders, "orders")
    out, ckpt = shared_path(spark, "orders-batches"), shared_path(spark, "orders-ckpt")
    for_each_batch(stream, status_counts_sink(out), ckpt)
    per_batch = spark.read.parquet(out)
    return per_batch.groupBy("o_orderstatus").agg(F.sum("n").alias("n"))


@query("stream_decode_to_parquet", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
""")
def q_stream_decode_to_parquet(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    messages = encode_payload(li, PRICE_COLS, keep=keys, schema=PRICE_FIELDS, fmt="fixed")
    stream = landed(spark, messages, "payload")
    decoded = decode_payload(stream, "value", PRICE_FIELDS, keep=keys, fmt="fixed")
    out, ckpt = shared_path(spark, "decoded-sink"), shared_path(spark, "decoded-ckpt")
    to_parquet(decoded, out, ckpt)
    return spark.read.parquet(out)


@query("stream_score", sql=nb_sql("""
SELECT l_orderkey, l_linenumber, prediction FROM scored
"""))
def q_stream_score(spark, sf_dir):
    model, _ = nb_fit(spark, sf_dir)
    path = save_model(model, shared_path(spark, "nb-stream-model"))
    rows = nb_input(spark, sf_dir).drop("l_returnflag")
    stream = landed(spark, rows, "score")
    scored = score_stream(load_model(path), stream).select("l_orderkey", "l_linenumber",
                                                            "prediction")
    out, ckpt = shared_path(spark, "score-sink"), shared_path(spark, "score-ckpt")
    to_parquet(scored, out, ckpt)
    return spark.read.parquet(out)


@query("stream_restart", sql="""
SELECT 1 AS run, count(*) AS n FROM orders
UNION ALL SELECT 2, count(*) FROM orders
UNION ALL SELECT 3, count(*) + (SELECT count(*) FROM supplier) FROM orders
""")
def q_stream_restart(spark, sf_dir):
    """One checkpoint, three runs: the first drains the folder, the second finds
    nothing new, the third takes only what was published in between."""
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    more = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast(keys.schema["k"].dataType).alias("k"))
    path, out, ckpt = (shared_path(spark, f"restart-{x}") for x in ("topic", "sink", "ckpt"))
    counts = []
    for run, new in enumerate([keys, None, more], start=1):
        if new is not None:
            publish_topic(new, "keys", "parquet", path=path)
        stream = open_topic(spark, "keys", "parquet", path=path, maxFilesPerTrigger=FILES_PER_TRIGGER)
        to_parquet(stream, out, ckpt)
        counts.append((run, spark.read.parquet(out).count()))
    return spark.createDataFrame(counts, "run INT, n LONG")


@query("stream_to_console_rows", sql="SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def q_stream_to_console_rows(spark, sf_dir):
    """The rows that an inspection sink gets, in memory instead of on the console:
    counts by status, one small row each."""
    stream = landed(spark, table(spark, sf_dir, "orders").select("o_orderstatus"), "console")
    name = f"console_{uuid.uuid4().hex}"
    to_memory(stream.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), name,
              shared_path(spark, "console-ckpt"), output_mode="complete")
    return spark.table(name)


@query("stream_quarantine", sql="""
SELECT reason, count(*) AS n, CAST(sum(l_orderkey) AS DECIMAL(38,0)) AS keys,
       CASE WHEN reason IS NULL THEN CAST(sum(l_quantity) AS BIGINT) END AS quantity
FROM (SELECT *, CASE WHEN l_orderkey % 7 = 0 THEN 'length 5, not 32' END AS reason FROM lineitem) GROUP BY reason
""")
def q_stream_quarantine(spark, sf_dir):
    """Payloads of every seventh order are cut short on their way: good rows are decoded, bad ones set aside."""
    li, keys = table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    messages = encode_payload(li, PRICE_COLS, keep=keys, schema=PRICE_FIELDS, fmt="fixed")
    cut = F.when(F.col("l_orderkey") % 7 == 0, F.substring("value", 1, 5)).otherwise(F.col("value"))
    stream = landed(spark, messages.withColumn("value", cut), "damaged")
    good, bad, ckpt = (shared_path(spark, f"quarantine-{x}") for x in ("rows", "rejects", "ckpt"))
    decode_with_rejects(stream, "value", PRICE_FIELDS, "fixed", good, bad, ckpt, keep=keys)
    rows = read_committed(spark, good).agg(
        F.lit(None).cast("string").alias("reason"), F.count(F.lit(1)).alias("n"),
        F.sum("l_orderkey").cast("decimal(38,0)").alias("keys"), F.sum("l_quantity").cast("long").alias("quantity"))
    rejected = read_committed(spark, bad).groupBy(F.col("reject_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").cast("decimal(38,0)").alias("keys"),
        F.lit(None).cast("long").alias("quantity"))
    return rows.unionByName(rejected)


class _Fault(Exception):
    """A fault that a query injects."""


@query("stream_crash_recovery", sql="""
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS DECIMAL(38,0)) AS keys, 1 AS failed_runs FROM orders GROUP BY o_orderstatus
""")
def q_stream_crash_recovery(spark, sf_dir):
    """The first run fails inside its first micro-batch, after the data and before the manifest; the
    second one starts from the same checkpoint. Every order counts once."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path, out, ckpt = (shared_path(spark, f"crash-{x}") for x in ("topic", "sink", "ckpt"))
    publish_topic(orders, "orders", "parquet", path=path)

    def fault(batch_id):
        raise _Fault(f"lost before batch {batch_id} was committed")

    failed = 0
    for hook in (fault, None):
        stream = open_topic(spark, "orders", "parquet", path=path, maxFilesPerTrigger=FILES_PER_TRIGGER)
        try:
            for_each_batch(stream, committed(lambda batch, batch_id: {out: batch}, hook), ckpt)
        except Exception as error:
            if "was committed" not in str(error):
                raise
            failed += 1
            if read_committed(spark, out, orders.schema).count():
                raise AssertionError("rows of a batch that was not committed are seen")
    rows = read_committed(spark, out)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("decimal(38,0)").alias("keys"),
                                             F.lit(failed).alias("failed_runs"))


@query("model_versions", sql=nb_sql("""
SELECT l_orderkey, l_linenumber, prediction, run FROM scored, (VALUES (1), (2)) r(run)
"""))
def q_model_versions(spark, sf_dir):
    """A stream loads the published model; while a later version is only half saved, the
    earlier one goes on scoring, and after it is published the stream's rows are scored by it."""
    model, _ = nb_fit(spark, sf_dir)
    root = shared_path(spark, "model-root")
    publish_model(model, root, spark)
    model.stages[0].write().save(f"{root}/versions/half/stages/0")  # a version without metadata, not pointed at
    rows = nb_input(spark, sf_dir).drop("l_returnflag")
    columns = ["l_orderkey", "l_linenumber", "prediction"]
    before = load_current(spark, root).transform(rows).select(*columns, F.lit(1).alias("run"))
    publish_model(model, root, spark)
    out, ckpt = shared_path(spark, "versions-sink"), shared_path(spark, "versions-ckpt")
    scored = score_stream(load_current(spark, root), landed(spark, rows, "versions"))
    to_parquet(scored.select(*columns), out, ckpt)
    return spark.read.parquet(out).withColumn("run", F.lit(2)).unionByName(before)
