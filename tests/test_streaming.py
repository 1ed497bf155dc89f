import struct

import pytest

from millrace.streaming.payload import decode_payload, encode_payload
from millrace.streaming.streams import open_stream, open_topic, publish_topic, to_memory, to_parquet

USER = "id INT NOT NULL, name STRING NOT NULL, email STRING"
PRICES = "a DOUBLE NOT NULL, b FLOAT NOT NULL"


def land(df, path, files):
    """``files`` files of a topic."""
    publish_topic(df.repartition(files), "t", "parquet", path=path)
    return path


def test_fixed_records_are_avro_bytes(spark):
    df = spark.createDataFrame([(1.5, 2.5), (-1.0, 0.0)], "a double, b float")
    enc = encode_payload(df, ["b", "a"], schema=PRICES, fmt="fixed")
    assert [bytes(r.value) for r in enc.collect()] == [struct.pack("<df", 1.5, 2.5), struct.pack("<df", -1.0, 0.0)]
    assert decode_payload(enc, "value", PRICES, fmt="fixed").collect() == df.collect()


@pytest.mark.parametrize("change", ["substring(value, 1, 11)", "concat(value, X'00')"])
def test_fixed_records_of_another_length_raise(spark, change):
    df = spark.createDataFrame([(1.5, 2.5), (-1.0, 0.0)], "a double, b float")
    enc = encode_payload(df, ["a", "b"], schema=PRICES, fmt="fixed")
    with pytest.raises(Exception, match="bytes long"):
        decode_payload(enc.selectExpr(f"{change} AS value"), "value", PRICES, fmt="fixed").collect()
    with pytest.raises(ValueError, match="fixed width"):
        encode_payload(df, ["a", "b"], schema="a DOUBLE, b FLOAT NOT NULL", fmt="fixed")
    with pytest.raises(ValueError, match="unknown payload format"):
        decode_payload(enc, "value", PRICES, fmt="text")


def test_json_records_round_trip_and_truncated_ones_raise(spark):
    df = spark.createDataFrame([(1, "a", None), (-2, "b \"q\" é\n", "b@x")], USER)
    enc = encode_payload(df, ["id", "name", "email"], schema=USER, fmt="json")
    assert dict(enc.dtypes) == {"value": "binary"}
    back = decode_payload(enc, "value", USER, fmt="json")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    for cut in ("substring(value, 1, length(value) - 2)", "CAST('{\"id\": 1}' AS BINARY)"):
        with pytest.raises(Exception):
            decode_payload(enc.selectExpr(f"{cut} AS value"), "value", USER, fmt="json").collect()


def test_stream_restart_adds_nothing_and_equals_batch(spark, scratch):
    src = spark.range(5000).selectExpr("id", "id % 7 AS k")
    landing = land(src, scratch("land"), 5)
    schema = spark.read.parquet(landing).schema
    out, ckpt = scratch("out"), scratch("ckpt")
    to_parquet(open_stream(spark, "parquet", landing, schema, maxFilesPerTrigger=1), out, ckpt)
    first = spark.read.parquet(out).count()
    to_parquet(open_stream(spark, "parquet", landing, schema, maxFilesPerTrigger=1), out, ckpt)
    assert first == 5000 and spark.read.parquet(out).count() == 5000
    assert spark.read.parquet(out).exceptAll(src).count() == 0


def test_stream_decode_and_score_memory(spark, scratch):
    from millrace.plans.lineitem_nb import nb_fit, nb_input
    model, df = nb_fit(spark, "/root/testdata/sf0.001")
    landing = land(nb_input(spark, "/root/testdata/sf0.001").drop("l_returnflag"), scratch("score-land"), 3)
    stream = open_stream(spark, "parquet", landing, spark.read.parquet(landing).schema)
    to_memory(model.transform(stream).select("prediction"), "scored_mem", scratch("mem-ckpt"))
    assert spark.sql("SELECT count(*) FROM scored_mem").first()[0] == df.count()


def test_console_sink_and_foreach_batch_idempotent(spark, scratch):
    from millrace.streaming.streams import for_each_batch, to_console
    landing = land(spark.range(300).selectExpr("id", "id % 3 AS k"), scratch("con"), 3)
    schema = spark.read.parquet(landing).schema
    q = to_console(open_stream(spark, "parquet", landing, schema), scratch("con-ckpt"), num_rows=2)
    assert q.lastProgress is not None
    out = scratch("feb")

    def write(batch_df, batch_id):
        batch_df.groupBy("k").count().write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    ckpt = scratch("feb-ckpt")
    stream = open_stream(spark, "parquet", landing, schema, maxFilesPerTrigger=1)
    for_each_batch(stream, write, ckpt)
    total = lambda: spark.read.parquet(out).groupBy().sum("count").first()[0]
    assert total() == 300
    replay = spark.read.parquet(landing)
    write(replay, 99)
    write(replay, 99)  # the same batch id replayed overwrites its folder
    assert total() == 600


def test_payload_with_large_arrow_types(spark):
    key = "spark.sql.execution.arrow.useLargeVarTypes"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        nums = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS a")
        enc = encode_payload(nums, ["a"], schema="a DOUBLE NOT NULL", fmt="fixed")
        assert decode_payload(enc, "value", "a DOUBLE NOT NULL", fmt="fixed").agg({"a": "sum"}).first()[0] == 4950
    finally:
        spark.conf.set(key, old)


def test_schema_from_avro_json_round_trips(spark):
    from millrace.streaming.payload import avro_schema_json, schema_from_avro_json
    text = ('{"type": "record", "name": "member", "fields": [{"name": "key", "type": "int"}, '
            '{"name": "label", "type": "string"}, {"name": "note", "type": ["string", "null"]}, '
            '{"name": "score", "type": "double"}]}')
    st = schema_from_avro_json(text)
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in st.fields] == [
        ("key", "int", False), ("label", "string", False), ("note", "string", True),
        ("score", "double", False)]
    assert schema_from_avro_json(avro_schema_json(st)) == st
    other = text.replace('["string", "null"]', '["null", "string"]')
    assert schema_from_avro_json(other) == st  # either order of the union
    for odd in ('["string", "int", "null"]', '["string"]'):
        with pytest.raises(ValueError):
            schema_from_avro_json(text.replace('["string", "null"]', odd))


def test_topic_formats_are_explicit(spark, scratch):
    path, schema = scratch("topic"), "a DOUBLE NOT NULL"
    msgs = encode_payload(spark.range(50).selectExpr("CAST(id AS DOUBLE) AS a"), ["a"],
                          schema=schema, fmt="fixed")
    publish_topic(msgs, "iris", "parquet", path=path)
    publish_topic(msgs, "iris", "parquet", path=path)  # append
    stream = decode_payload(open_topic(spark, "iris", "parquet", path=path), "value", schema, fmt="fixed")
    to_memory(stream, "topic_mem", scratch("topic-ckpt"))
    assert spark.sql("SELECT count(*), sum(a) FROM topic_mem").first() == (100, 2450.0)
    for bad in (lambda: open_topic(spark, "iris"), lambda: open_topic(spark, "iris", "parquet"),
                lambda: publish_topic(msgs, "iris"), lambda: publish_topic(msgs, "iris", "parquet")):
        with pytest.raises(ValueError):
            bad()


def test_a_stated_timeout_stops_a_query_and_none_is_set_by_default(spark, scratch):
    import inspect

    from millrace.streaming import streams
    for fn in (streams.to_parquet, streams.to_console, streams.for_each_batch, streams.to_memory, streams.await_query):
        assert inspect.signature(fn).parameters["timeout"].default is None
    endless = spark.readStream.format("rate").load()
    with pytest.raises(TimeoutError):
        to_memory(endless, "endless", scratch("endless"), trigger={"processingTime": "1 second"}, timeout=3)


def test_sink_without_checkpoint_uses_shared_folder(spark, scratch):
    from millrace.streaming.streams import to_console
    landing = land(spark.range(10), scratch("nockpt"), 1)
    q = to_console(open_stream(spark, "parquet", landing, spark.read.parquet(landing).schema),
                   None, num_rows=1)
    assert q.lastProgress is not None


def test_null_message_decodes_to_nulls_and_fields_pair_by_name(spark):
    schema = "a DOUBLE NOT NULL, b DOUBLE NOT NULL"
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    enc = encode_payload(df, ["b", "a"], schema=schema, fmt="fixed")  # order of cols does not matter
    assert tuple(decode_payload(enc, "value", schema, fmt="fixed").first()) == (1.0, 2.0)
    with pytest.raises(ValueError):
        encode_payload(df, ["a"], schema=schema, fmt="fixed")
    tomb = enc.union(spark.createDataFrame([(None,)], "value binary"))
    rows = sorted(decode_payload(tomb, "value", schema, fmt="fixed").collect(), key=lambda r: r.a or 0)
    assert [tuple(r) for r in rows] == [(None, None), (1.0, 2.0)]
