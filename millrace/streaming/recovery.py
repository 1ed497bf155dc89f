"""Streams that survive: bad records set aside, batches that count once they are whole, models that are replaced
in one step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.files import _as_schema
from millrace.streaming.streams import for_each_batch

REASON = "reject_reason"

# storage, through Hadoop's file systems


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written under another name, then renamed over ``path`` in one step."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    half, fs = _fs(spark, f"{path}.{uuid.uuid4().hex}.half")
    out = fs.create(half, True)
    out.write(bytearray(text.encode()))
    out.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = option
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(half.toUri(), conf)
    context.rename(context.makeQualified(half), context.makeQualified(_fs(spark, path)[0]), options)


def get_text(spark: SparkSession, path: str) -> str | None:
    where, fs = _fs(spark, path)
    if not fs.exists(where):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0][0] if rows else ""


# bad records


def _width(schema: T.StructType) -> int:
    """Bytes of a ``fixed`` record."""
    return sum({"double": 8, "float": 4}[f.dataType.typeName()] for f in schema.fields)


def check_payload(df: DataFrame, value_col: str, schema, fmt: str) -> DataFrame:
    """``df`` with ``reject_reason``: why its payload is no record of ``schema``, null for good ones (and for
    a missing payload, which decodes to nulls). Built-in expressions; batch and streaming frames."""
    st, value = _as_schema(schema), F.col(value_col)
    if fmt == "fixed":
        reason = F.when(F.octet_length(value) != _width(st), F.concat(
            F.lit("length "), F.octet_length(value).cast("string"), F.lit(f", not {_width(st)}")))
    elif fmt == "json":
        text = F.col(value_col).cast("string")
        loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in st.fields]
                             + [T.StructField("_corrupt", T.StringType(), True)])
        record = F.from_json(text, loose, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        reason = F.when(F.is_valid_utf8(value) & F.get(F.array(record["_corrupt"]), 0).isNotNull(), F.lit("not a record of the schema"))
        for f in st.fields:
            if not f.nullable:
                reason = reason.when(record[f.name].isNull(), F.lit(f"lacks {f.name}"))
        reason = F.when(~F.is_valid_utf8(value), F.lit("not UTF-8")).otherwise(reason)
    else:
        raise ValueError(f"payloads of format {fmt!r} cannot be checked; json and fixed can")
    return df.withColumn(REASON, F.when(value.isNotNull(), reason))


def decode_with_rejects(stream: DataFrame, value_col: str, schema, fmt: str, path: str, rejects: str, checkpoint: str,
                        keep: Sequence[str] = (), wait: bool = True) -> StreamingQuery:
    """Decode a stream into parquet at ``path`` and set payloads that do not decode aside at ``rejects`` (``keep``,
    payload, reason, batch_id), in one checkpointed run. Both are committed sinks: a batch that is replayed replaces
    what its first try left. The check and the decoding see one written copy of the batch."""
    from millrace.streaming.payload import decode_payload

    checked = check_payload(stream, value_col, schema, fmt)

    def write(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        good = batch.where(F.col(REASON).isNull())
        bad = batch.where(F.col(REASON).isNotNull()).select(*keep, value_col, REASON, F.lit(batch_id).cast("long").alias("batch_id"))
        return {path: decode_payload(good, value_col, schema, keep=keep, fmt=fmt), rejects: bad}

    return for_each_batch(checked, committed(write), checkpoint, wait=wait)


# committed batches


def committed(make: Callable[[DataFrame, int], dict[str, DataFrame]],
              before_commit: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body. ``make(batch, batch_id)`` gives frames by target path; each is written into a folder of its
    own try (``data/batch-try``), and when all are written, a manifest per target that names the folder replaces the
    batch's earlier one. ``read_committed`` sees only what manifests name, so half-written tries never show and
    a batch that is replayed counts once. ``before_commit`` is a hook between data and manifests."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        one = batch.persist()
        try:
            tries = {}
            for path, frame in make(one, batch_id).items():
                tries[path] = f"data/{batch_id}-{uuid.uuid4().hex}"
                frame.write.parquet(f"{path}/{tries[path]}")
        finally:
            one.unpersist()
        if before_commit is not None:
            before_commit(batch_id)
        for path, folder in tries.items():
            put_text(spark, f"{path}/manifests/{batch_id:012d}.json", json.dumps({"batch": batch_id, "folder": folder}))

    return write


def read_committed(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows of all committed batches at ``path``. Before the first one, ``schema`` gives the empty frame."""
    where, fs = _fs(spark, f"{path}/manifests")
    folders = []
    if fs.exists(where):
        # one small line per batch
        folders = [json.loads(r[0])["folder"] for r in spark.read.option("pathGlobFilter", "*.json")
                   .text(f"{path}/manifests", wholetext=True).collect()]
    if not folders:
        if schema is None:
            raise ValueError(f"no committed batch at {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", f"{path}/data").parquet(*[f"{path}/{f}" for f in sorted(folders)])


# versioned models


def publish_model(model, root: str, spark: SparkSession) -> str:
    """Save a fitted pipeline as a new version below ``root`` and make it the current one: the version's folder is
    never written again, and the pointer is replaced in one step after it is whole."""
    version = f"versions/{uuid.uuid4().hex}"
    model.write().save(f"{root}/{version}")
    put_text(spark, f"{root}/current", version)
    return f"{root}/{version}"


def current_version(spark: SparkSession, root: str) -> str:
    version = get_text(spark, f"{root}/current")
    if not version:
        raise ValueError(f"no model has been published at {root}")
    return f"{root}/{version}"


def load_current(spark: SparkSession, root: str) -> PipelineModel:
    """The published model; one that is being saved meanwhile does not show."""
    return PipelineModel.load(current_version(spark, root))
