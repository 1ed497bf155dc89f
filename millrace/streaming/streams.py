"""Structured Streaming sources, sinks and scoring.

Sources are any ``readStream`` format: ``kafka`` where its package is
deployed, file formats (parquet, csv, json, text) everywhere. Sinks always
set a checkpoint location (exactly-once file sink, restartable query).
``availableNow`` processes what is there in one or more micro-batches and
stops; a wait is bounded only where the caller asks for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

def open_stream(spark: SparkSession, fmt: str, path: str | None = None, schema=None,
                **options) -> DataFrame:
    """``readStream`` of any format; file sources need a schema."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**{k: str(v) for k, v in options.items()})
    return reader.load(path) if path is not None else reader.load()


def await_query(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Block until the query stops and re-raise its failure. An ``availableNow``
    run ends by itself; a ``timeout`` in seconds stops the query and raises."""
    finished = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() or True
    if not finished:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} still running after {timeout}s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"stream failed: {exc}")
    return query


def _writer(stream: DataFrame, checkpoint: str | None, trigger: dict | None, name: str | None):
    if checkpoint is None:  # a fresh folder under the shared checkpoint dir
        from millrace.session import shared_path
        checkpoint = shared_path(stream.sparkSession, "stream-ckpt")
    w = stream.writeStream.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"availableNow": True}))


def to_parquet(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
               partition_by=None, wait: bool = True,
               timeout: float | None = None) -> StreamingQuery:
    """Append a stream to parquet files (exactly once via the checkpoint)."""
    w = _writer(stream, checkpoint, trigger, None).format("parquet").outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.option("path", path).start()
    return await_query(q, timeout) if wait else q


def to_console(stream: DataFrame, checkpoint: str, trigger: dict | None = None,
               num_rows: int = 20, wait: bool = True,
               timeout: float | None = None) -> StreamingQuery:
    """Print each micro-batch (append mode); for inspection only."""
    q = (_writer(stream, checkpoint, trigger, None).format("console").outputMode("append")
         .option("numRows", num_rows).option("truncate", False).start())
    return await_query(q, timeout) if wait else q


def to_memory(stream: DataFrame, name: str, checkpoint: str, trigger: dict | None = None,
              wait: bool = True, timeout: float | None = None,
              output_mode: str = "append") -> StreamingQuery:
    """Collect a stream into an in-memory table on the driver (tests and small
    results, such as counts by a few keys)."""
    q = _writer(stream, checkpoint, trigger, name).format("memory").outputMode(output_mode).start()
    return await_query(q, timeout) if wait else q


def for_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                   trigger: dict | None = None, wait: bool = True,
                   timeout: float | None = None) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch; ``fn`` works on the
    whole micro-batch as a DataFrame (distributed), and should be idempotent
    per ``batch_id`` because a batch is replayed after a failure."""
    q = _writer(stream, checkpoint, trigger, None).foreachBatch(fn).start()
    return await_query(q, timeout) if wait else q


def publish(df: DataFrame, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Batch-publish a frame with a ``value`` (and optional ``key``) column,
    e.g. to a Kafka topic (``topic=``, ``kafka.bootstrap.servers=``), or to
    files for a file stream source."""
    w = df.write.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if path is None:
        w.save()
    else:
        w.mode("append").save(path)


def score_stream(model, stream: DataFrame) -> DataFrame:
    """Apply a fitted pipeline to a stream, micro-batch by micro-batch; the
    model is loaded once and broadcast with the plan, not per record."""
    return model.transform(stream)


def open_topic(spark: SparkSession, topic: str, fmt: str = "kafka", servers: str | None = None,
               path: str | None = None, **options) -> DataFrame:
    """Messages of a topic as a stream with (at least) a binary ``value`` column.

    ``fmt`` says where they are: ``"kafka"`` needs ``servers`` (and Spark's Kafka
    package, whose absence raises); a file format needs the ``path`` of the
    folder that the topic's messages are written to."""
    if fmt == "kafka":
        if not servers:
            raise ValueError(f"topic {topic!r}: the kafka format needs servers")
        # a bounded run must see the messages already in the topic
        return open_stream(spark, "kafka", **{"kafka.bootstrap.servers": servers, "subscribe": topic,
                                              "startingOffsets": "earliest", **options})
    if path is None:
        raise ValueError(f"topic {topic!r}: the {fmt} format needs a path")
    return open_stream(spark, fmt, path, spark.read.format(fmt).load(path).schema, **options)


def publish_topic(df: DataFrame, topic: str, fmt: str = "kafka", servers: str | None = None,
                  path: str | None = None) -> None:
    """Publish ``value`` (and ``key``) rows to a topic, where ``fmt`` says (see
    ``open_topic``)."""
    if fmt == "kafka":
        if not servers:
            raise ValueError(f"topic {topic!r}: the kafka format needs servers")
        publish(df, "kafka", topic=topic, **{"kafka.bootstrap.servers": servers})
    elif path is None:
        raise ValueError(f"topic {topic!r}: the {fmt} format needs a path")
    else:
        publish(df, fmt, path)
