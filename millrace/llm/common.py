"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_path

# bytes that stay part of a word after ASCII lower-casing: digits, a-z and
# every byte of a non-ASCII character; all others become a space
ALNUM_TABLE = bytes(b if chr(b).isdigit() and b < 128 or 97 <= b <= 122 or b >= 128
                    else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python in Arrow batches of at most ``BATCH_ROWS`` rows: Spark's
    default of 10,000 rows is made for numbers, and a batch of long texts is held
    by the JVM and by the Python worker at once. It changes no result; a smaller
    setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def bounded_reads(spark: SparkSession) -> None:
    """Read Parquet in column batches of at most ``BATCH_ROWS`` rows: with Spark's 4,096, the
    vectors and levels of a column of long arrays are large blocks of the JVM's heap. It
    changes no result; a smaller setting of the session stays."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    if not 0 < int(spark.conf.get(key, "4096")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read for operators that run Python on it."""
    bounded_batches(spark)
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def text_bytes(text_col: str):
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(text_col).cast("binary"), F.lit(b"").cast("binary"))


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-case A-Z and take the runs of digits, letters and non-ASCII characters."""
    return text.translate(ALNUM_TABLE).split()


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: its
    lineage ends there, so a lost executor repeats only what came after."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1 ... (sizes[0] numbers), begin[1] ..."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)


class Memo(dict):
    """``memo[key]`` is ``make(key)``, kept for the ``entries`` keys that came
    last or again since the last turnover: at most twice as many are held."""

    def __init__(self, make: Callable, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value


def worker_keeps(key: tuple, make: Callable):
    """``make()``, kept for later tasks of the same Python worker that ask with the
    same key; one object per worker. Functions of this package are shipped by
    value, so their own globals are new in each task, while ``sys.modules`` lives as
    long as the worker."""
    kept = sys.modules.setdefault("millrace_worker_keeps", types.ModuleType("millrace_worker_keeps"))
    if getattr(kept, "key", None) != key:
        kept.key, kept.value = None, None  # the old one goes first
        kept.value = make()
        kept.key = key
    return kept.value


_BLANKS = tuple(bytes([b]) for b in (32, 9, 10, 11, 12, 13))


def text_blocks(raw: bytes, size: int) -> Iterator[bytes]:
    """A text in blocks of ``size`` bytes, cut before white space; a word longer
    than a block is a longer block of its own."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + size)
        if end < len(raw) and raw[end:end + 1] not in _BLANKS:
            back = max(raw.rfind(c, at, end) for c in _BLANKS)
            end = back if back > at else min((x for c in _BLANKS if (x := raw.find(c, end)) >= 0), default=len(raw))
        yield raw[at:end]
        at = end


FILTER_BITS, PROBES = 1 << 27, 3


def _spread(keys: np.ndarray) -> np.ndarray:
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xCF1BBCDCB7A56463)):
        keys = (keys ^ (keys >> np.uint64(shift))) * np.uint64(factor)
    return keys ^ (keys >> np.uint64(32))


def _probes(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for j in range(PROBES):
        yield _spread(keys + np.uint64(j * 0x632BE59BD9B4E019 % 2 ** 64)) >> np.uint64(65 - bits.bit_length())


def key_filter(keys: DataFrame, limit: int = FILTER_BITS) -> Broadcast:
    """A broadcast Bloom filter of the numbers in column ``key``, 16 bits for each and at most
    ``limit`` bits in all. Beyond that it only lets more strangers pass."""
    bits = min(limit, 1 << (max(1024, 16 * keys.count()) - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.unique(np.concatenate(list(_probes(batch.column("key").to_numpy().view(np.uint64), bits))))
                slots, first = np.unique(at >> np.uint64(6), return_index=True)
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(slots.view(np.int64)), pa.array(value.view(np.int64))],
                                                 ["slot", "value"])

    slots = keys.select("key").mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.bit_or("value").alias("value"))
    found = slots.toPandas()  # at most limit / 64 rows
    words = np.zeros(bits // 64, np.uint64)
    words[found["slot"].to_numpy()] = found["value"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(words)


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (unsigned) can be in a filter; false for strangers only."""
    out = np.ones(len(keys), bool)
    for at in _probes(keys, len(words) * 64):
        out &= (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def in_filter(found: Broadcast, key: Column) -> Column:
    """``may_hold`` for a column of numbers that are not null."""
    @F.pandas_udf("boolean")
    def test(keys: pd.Series) -> pd.Series:
        return pd.Series(may_hold(found.value, keys.to_numpy(np.int64).view(np.uint64)))

    return test(key)
