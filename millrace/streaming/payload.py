"""Record payloads: the binary ``value`` of a message as typed columns and back.

The caller names the format:

* ``"avro"``: Spark's ``to_avro`` / ``from_avro`` (the spark-avro package must be
  deployed; Spark raises where it is not), any flat record;
* ``"json"``: Spark's ``to_json`` / ``from_json``, any flat record; a message that is
  not one whole record raises;
* ``"fixed"``: records of non-null doubles and floats only, whose Avro binary form
  is their little-endian bytes one after the other. Every record then has the
  same width, so an Arrow batch is one numpy view; another width raises.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AVRO_TYPES = {T.IntegerType: "int", T.LongType: "long", T.FloatType: "float",
               T.DoubleType: "double", T.BooleanType: "boolean", T.StringType: "string"}
_FIXED = {"double": "<f8", "float": "<f4"}


def _avro_type(dt) -> str:
    for cls, name in _AVRO_TYPES.items():
        if isinstance(dt, cls):
            return name
    raise TypeError(f"unsupported payload field type {dt}")


def _as_schema(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def avro_schema_json(schema, name: str = "record") -> str:
    """The Avro JSON schema of a flat StructType (nullable -> [type, null])."""
    st = _as_schema(schema)
    fields = []
    for f in st.fields:
        t = _avro_type(f.dataType)
        fields.append({"name": f.name, "type": [t, "null"] if f.nullable else t})
    return json.dumps({"type": "record", "name": name, "fields": fields})


def schema_from_avro_json(text: str) -> T.StructType:
    """StructType of a flat Avro record schema (the JSON of an .avsc file):
    primitive field types, and unions of a type and null, in either order, as
    nullable fields."""
    by_name = {v: k for k, v in _AVRO_TYPES.items()}
    fields = []
    for f in json.loads(text)["fields"]:
        t = f["type"]
        nullable = isinstance(t, list)
        if nullable:
            kinds = [k for k in t if k != "null"]
            if len(kinds) != 1 or len(t) != 2:
                raise ValueError(f"unsupported union for {f['name']}: {t}")
            t = kinds[0]
        if t not in by_name:
            raise ValueError(f"unsupported Avro type for {f['name']}: {t}")
        fields.append(T.StructField(f["name"], by_name[t](), nullable))
    return T.StructType(fields)


def _fixed_dtype(schema: T.StructType) -> np.dtype:
    """The numpy record of a fixed-width schema."""
    odd = [f.name for f in schema.fields if f.nullable or _avro_type(f.dataType) not in _FIXED]
    if odd:
        raise ValueError(f"fields {odd} have no fixed width: only non-null doubles and floats do")
    return np.dtype([(f.name, _FIXED[_avro_type(f.dataType)]) for f in schema.fields])


# --- Arrow batch functions ----------------------------------------------------

def _offsets(arr: pa.Array) -> np.ndarray:
    """Where each value of a binary / large_binary array begins and ends."""
    off_type = np.int64 if pa.types.is_large_binary(arr.type) else np.int32
    return np.frombuffer(arr.buffers()[1], dtype=off_type)[arr.offset: arr.offset + len(arr) + 1]


def _decode_batches(batches, value_col, keep, fixed, out_schema):
    for batch in batches:
        values = batch.column(value_col)
        kept = [batch.column(k) for k in keep]
        nulls = values.is_null()
        present = values.drop_null()
        offsets = _offsets(present) if len(present) else np.zeros(1, np.int64)
        if not np.all(np.diff(offsets) == fixed.itemsize):
            raise ValueError(f"a record is not {fixed.itemsize} bytes long")
        data = np.frombuffer(present.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if len(present) else \
            np.empty(0, np.uint8)
        recs = data.view(fixed)
        # a null message (a tombstone) decodes to nulls
        where = pa.array(np.where(nulls.to_numpy(zero_copy_only=False), 0,
                                  np.cumsum(~nulls.to_numpy(zero_copy_only=False)) - 1),
                         mask=nulls.to_numpy(zero_copy_only=False))
        cols = [pa.array(recs[name].astype(fixed[name].newbyteorder("="))).take(where) for name in fixed.names]
        yield pa.RecordBatch.from_arrays(kept + cols, schema=out_schema)


def _encode_batches(batches, cols, keep, fixed, out_col, out_schema):
    value_type = out_schema.field(out_col).type
    off_type = np.int64 if pa.types.is_large_binary(value_type) else np.int32
    for batch in batches:
        n = batch.num_rows
        recs = np.empty(n, dtype=fixed)
        for c in cols:
            if batch.column(c).null_count:
                raise ValueError(f"field {c} is null, but the record says it never is")
            recs[c] = batch.column(c).to_numpy(zero_copy_only=False)
        offsets = np.arange(n + 1, dtype=off_type) * fixed.itemsize
        value = pa.Array.from_buffers(value_type, n, [None, pa.py_buffer(offsets.astype(off_type).tobytes()),
                                                      pa.py_buffer(recs.tobytes())])
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [value], schema=out_schema)


def _arrow_schema(spark: SparkSession, schema: T.StructType):
    """The Arrow schema Spark expects back from ``mapInArrow`` (large
    binary/string types when the session asks for them)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    large = str(spark.conf.get("spark.sql.execution.arrow.useLargeVarTypes", "false")).lower()
    return to_arrow_schema(schema, prefers_large_types=large == "true")


FORMATS = ("avro", "json", "fixed")


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown payload format {fmt!r}; one of {FORMATS}")


def decode_payload(df: DataFrame, value_col: str, schema, keep: Sequence[str] = (),
                   fmt: str = "avro") -> DataFrame:
    """Binary column -> typed columns of ``schema`` (plus ``keep`` columns).
    Works on batch and streaming frames; a null message gives nulls."""
    _check_format(fmt)
    st, keep = _as_schema(schema), list(keep)
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro
        rec = from_avro(F.col(value_col), avro_schema_json(st), {"mode": "FAILFAST"})
        return df.select(*keep, rec.alias("_rec")).select(*keep, "_rec.*")
    decoded = [T.StructField(f.name, f.dataType, True) for f in st.fields]
    if fmt == "json":
        rec = F.from_json(F.col(value_col).cast("string"), T.StructType(decoded), {"mode": "FAILFAST"})
        # a message that was there must have given its required fields
        lost = [f.name for f in st.fields if not f.nullable]
        gap = F.col(value_col).isNotNull() & (F.lit(False) if not lost else
                                              F.greatest(*[F.col(f"_rec.{c}").isNull() for c in lost], F.lit(False)))
        rows = df.select(*keep, value_col, rec.alias("_rec"))
        cols = [F.when(gap, F.raise_error(F.lit(f"a record lacks one of {lost}"))).otherwise(F.col(f"_rec.{f.name}"))
                .cast(f.dataType).alias(f.name) for f in st.fields]
        return rows.select(*keep, *cols)
    fixed = _fixed_dtype(st)
    out = T.StructType([df.schema[k] for k in keep] + decoded)
    arrow_schema = _arrow_schema(df.sparkSession, out)
    return df.select(*keep, value_col).mapInArrow(
        lambda it: _decode_batches(it, value_col, keep, fixed, arrow_schema), out)


def encode_payload(df: DataFrame, cols: Sequence[str], out_col: str = "value",
                   keep: Sequence[str] = (), schema=None, fmt: str = "avro") -> DataFrame:
    """Typed columns -> one binary payload column (plus ``keep`` columns)."""
    _check_format(fmt)
    cols, keep = list(cols), list(keep)
    st = _as_schema(schema) if schema is not None else T.StructType([df.schema[c] for c in cols])
    if sorted(cols) != sorted(st.names):
        raise ValueError(f"payload columns {cols} do not match the record fields {st.names}")
    cols = list(st.names)  # record field order, paired by name
    if fmt == "avro":
        from pyspark.sql.avro.functions import to_avro
        return df.select(*keep, to_avro(F.struct(*cols), avro_schema_json(st)).alias(out_col))
    if fmt == "json":
        record = F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in st.fields]))
        return df.select(*keep, record.cast("binary").alias(out_col))
    fixed = _fixed_dtype(st)
    out = T.StructType([df.schema[k] for k in keep] + [T.StructField(out_col, T.BinaryType())])
    arrow_schema = _arrow_schema(df.sparkSession, out)
    return df.select(*keep, *cols).mapInArrow(
        lambda it: _encode_batches(it, cols, keep, fixed, out_col, arrow_schema), out)
