"""Exact deduplication against a history kept under minimal perfect hashes.

The distinct digests of an earlier batch are dealt to shards by their first
bytes. Each shard gets a minimal perfect hash: level after level, keys that
fall alone into a cell of a bit table own it, the rest try the next level with
another seed, and a key's slot is the number of owned cells before its own.
Slot arrays hold the full 32-byte digest, the winner's locator (the largest
id with that text) and the number of rows. A perfect hash sends strangers to
arbitrary slots, so a lookup counts only if the slot's digest is equal byte by
byte. Digests of a new batch that are members join their slot's group; the
others form groups of their own.

Texts are reduced to (id, digest) in the scan; digests are grouped with partial
aggregates before they meet a shard, so a text that makes up a third of all
rows is one digest by then. A shard holds at most about ``SHARD_KEYS`` keys of
either batch. The way back from groups to rows is an ordinary join, whose hot
keys adaptive execution splits.

Texts are equal when they are identical after lower-casing A-Z only; the row
with the largest id stays.

Edge cases: null text counts as empty, and empty texts are equal; a null id
never wins over another id, and in a group of null ids only, all rows stay;
rows that repeat id and text are one document: they count twice in group_size
and share ``kept``; an empty table or history gives no rows for it; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, in_filter, key_filter, text_bytes

SHARD_KEYS = 50_000
LOAD = 2.0  # cells per key of a level
DIGEST = 32
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _cell(words: np.ndarray, level: int, cells: int) -> np.ndarray:
    """The cell of each key (first 8 digest bytes as a number) on a level."""
    z = words ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))
    for shift, factor in ((30, _MIX[0]), (27, _MIX[1])):
        z = (z ^ (z >> np.uint64(shift))) * factor
    return ((z ^ (z >> np.uint64(31))) % np.uint64(cells)).astype(np.int64)


def _words(digests: np.ndarray) -> np.ndarray:
    """The last 8 bytes of each digest; the first ones chose the shard."""
    return np.ascontiguousarray(digests[:, -8:]).view(np.uint64).ravel()


class PerfectHash:
    """Minimal perfect hash over distinct digests, an (n, 32) byte array.

    Keys whose 8 hashed bytes are equal can never part; they fall through to a
    short list that is searched by the whole digest."""

    MAX_LEVELS = 40

    def __init__(self, digests: np.ndarray):
        words = _words(digests)
        self.levels: list[np.ndarray] = []
        left = np.arange(len(digests))
        while len(left) and len(self.levels) < self.MAX_LEVELS:
            cells = max(64, int(LOAD * len(left)))
            at = _cell(words[left], len(self.levels), cells)
            owned = np.bincount(at, minlength=cells) == 1
            self.levels.append(owned)
            left = left[~owned[at]]
        self.before = np.cumsum([0] + [int(x.sum()) for x in self.levels])
        self.ranks = [np.cumsum(x) - 1 for x in self.levels]
        self.rest = {digests[i].tobytes(): int(self.before[-1]) + k for k, i in enumerate(left)}

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """A slot for each digest; for strangers an arbitrary one or -1."""
        words, out = _words(digests), np.full(len(digests), -1, np.int64)
        left = np.arange(len(digests))
        for k, (owned, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = _cell(words[left], k, len(owned))
            mine = owned[at]
            out[left[mine]] = self.before[k] + rank[at[mine]]
            left = left[~mine]
        for i in left if self.rest else ():
            out[i] = self.rest.get(digests[i].tobytes(), -1)
        return out


def _matrix(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, DIGEST)


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of each text after lower-casing A-Z."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.lower() changes A-Z only
            digests = [hashlib.sha256(t.as_py().lower()).digest() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())],
                                             ["doc_id", "digest"])

    return rows.mapInArrow(run, "doc_id long, digest binary")


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def _shard(shards: int):
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


def merge_groups(incoming: DataFrame, history: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(digest, keep_id, group_size) of each distinct digest of both batches."""
    old, new = cut(_groups(history), "digests-history"), cut(_groups(incoming), "digests-incoming")
    shards = max(old.count(), new.count()) // shard_keys + 1

    def look_up(key: tuple, slots: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(slots) or not len(found):
            return pd.concat([slots, found])[["digest", "keep_id", "group_size"]]
        digests, asked = _matrix(slots["digest"]), _matrix(found["digest"])
        perfect = PerfectHash(digests)
        own = perfect.slots(digests)
        order = np.empty(len(own), np.int64)
        order[own] = np.arange(len(own))
        slots, held = slots.iloc[order].reset_index(drop=True), digests[order]
        at = perfect.slots(asked)
        member = (at >= 0) & (held[at] == asked).all(axis=1)
        hits = found[member].set_index(at[member])
        keep = slots["keep_id"].astype("Int64")
        rivals = hits["keep_id"].astype("Int64").reindex(keep.index)
        slots["keep_id"] = keep.where(rivals.isna() | (keep.notna() & (keep >= rivals).fillna(False)), rivals)
        slots["group_size"] += hits["group_size"].reindex(keep.index).fillna(0).astype("int64")
        return pd.concat([slots, found[~member]])[["digest", "keep_id", "group_size"]]

    sides = [g.select(_shard(shards).alias("shard"), "*").groupBy("shard") for g in (old, new)]
    return sides[0].cogroup(sides[1]).applyInPandas(look_up, "digest binary, keep_id long, group_size long")


def mark_duplicates(incoming: DataFrame, history: DataFrame | None = None, id_col: str = "doc_id",
                    text_col: str = "text", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per row of both batches: doc_id, keep_id, group_size, kept, text_sha256.

    Without a ``history`` the incoming digests are grouped on their own."""
    rows = cut(text_digests(incoming, id_col, text_col), "digest-rows")
    if history is None:
        groups = cut(_groups(rows), "digest-groups")
    else:
        old = cut(text_digests(history, id_col, text_col), "digest-rows")
        groups = cut(merge_groups(rows, old, shard_keys), "digest-groups")
        rows = rows.unionByName(old)
    return (rows.join(groups, "digest")
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def earlier_batch(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``docs`` as (incoming, history): half by a hash of the id plays the earlier batch."""
    earlier = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(2)) == 0
    return docs.where(~earlier), docs.where(earlier)


def drop_rows(docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``marks`` (doc_id, text_sha256, kept) does not keep.

    A Bloom filter of the marked rows lets all others pass without a shuffle; only rows that it
    stops (the marked ones and a few strangers) meet the marks in an exact join.

    A row is known by its id and the SHA-256 of its text after lower-casing A-Z: of rows
    that share an id, only those whose text is marked go. A null id equals a null id, so
    marked rows without an id go too. Rows equal in both go or stay together. All columns are
    returned as they are, whatever their names."""
    gone = marks.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.unhex("text_sha256").alias("gone_text"))
    gone = cut(gone.distinct(), "dropped-rows")
    found = key_filter(gone.select(F.xxhash64("gone_id", "gone_text").alias("key")))
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    digest = F.unhex(F.sha2(lower.cast("binary"), 256))
    stopped = in_filter(found, F.xxhash64(F.col(id_col).cast("long"), digest))
    rows = docs.where(stopped).select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("row_id"),
                                      digest.alias("row_text"))
    same = F.col("row_id").eqNullSafe(F.col("gone_id")) & (F.col("row_text") == F.col("gone_text"))
    return docs.where(~stopped).union(rows.join(gone, same, "left_anti").select("row.*"))
