"""Benchmark decontamination with a broadcast set of test n-grams.

The benchmark's words are numbered, and every window of ``WINDOW``
consecutive item words (or a shorter item's whole word sequence) becomes a
tuple of numbers with a 64-bit polynomial hash. Each document is scanned
once: words outside the benchmark's vocabulary get number 0 and rule out every
window over them, the remaining windows are hashed in one numpy pass and
looked up in the sorted hashes, and each hit is verified on the tuple itself
before it counts. A document word inside any occurrence of a window is hit.

The set is collected and broadcast in blocks of at most ``BLOCK_BYTES`` of
benchmark text, counted first; a benchmark beyond one block is scanned for
block by block, with the hits so far carried in a written table.

Edge cases: null text has no words; an item without words has no window; an
item_id that repeats stands for all its rows; equal windows of several items
count for each; a null id is kept; an empty document or benchmark table gives
zero hits or no rows; ``find_contamination`` reads no other columns and
``drop_contaminated`` passes them on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import alnum_words, cut, text_bytes

WINDOW = 10
BLOCK_BYTES = 8 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """Word to number; 0 for words that no item has."""

    def __missing__(self, word: bytes) -> int:
        return 0


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of every ``size`` consecutive numbers, modulo 2**64."""
    n = len(ids) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(size if n > 0 else 0):
        out = out * _BASE + ids[j:j + n]
    return out


class NgramSet:
    """The windows of one block of items: per length, sorted hashes and the
    exact tuples with the items that have them."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.numbers = Numbers()
        self.by_size: dict[int, tuple[np.ndarray, dict[bytes, set[str]]]] = {}
        tuples: dict[int, dict[bytes, set[str]]] = {}
        for item, text in items:
            words = alnum_words(text)
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
            ids = np.array([self.numbers[w] for w in words], np.uint64)
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                tuples.setdefault(size, {}).setdefault(ids[at:at + size].tobytes(), set()).add(item)
        for size, windows in tuples.items():
            ids = np.frombuffer(b"".join(windows), np.uint64).reshape(-1, size)
            hashes = np.array([window_hashes(row, size)[0] for row in ids], np.uint64)
            self.by_size[size] = (np.unique(hashes), windows)

    def plain(self) -> tuple:
        """Built-in types only, for a broadcast that needs no import to load."""
        return dict(self.numbers), self.by_size

    @classmethod
    def load(cls, plain: tuple) -> "NgramSet":
        ngrams = cls([])
        ngrams.numbers.update(plain[0])
        ngrams.by_size = plain[1]
        return ngrams

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """(which words are hit, items with an occurring window)."""
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.uint64, len(words))
        hit, items = np.zeros(len(words), bool), set()
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for size, (hashes, windows) in self.by_size.items():
            starts = np.flatnonzero(known[size:] - known[:-size] == size) if len(ids) >= size else []
            if not len(starts):
                continue
            values = window_hashes(ids, size)[starts]
            place = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
            for at in starts[hashes[place] == values]:
                found = windows.get(ids[at:at + size].tobytes())
                if found:
                    hit[at:at + size] = True
                    items |= found
        return hit, items


def _runs(hit: np.ndarray) -> list[int]:
    """Flat list of start, end (exclusive) of the runs of hit words."""
    return np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).tolist()


def ngram_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark's window sets, broadcast one block at a time, each with
    whether it is the last. Copies of an item are one row, written once; the size of
    the distinct rows is summed before any is collected, and a block's share of it
    is about ``block_bytes``, or one longer item."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), text_bytes(text_col).alias("raw"))
    rows = cut(rows.distinct(), "benchmark-items")
    size = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "raw"), F.lit(blocks)) == k)
        items = [(str(r.item), bytes(r.raw)) for r in part.toLocalIterator()]
        yield benchmark.sparkSession.sparkContext.broadcast(NgramSet(items, window).plain()), k == blocks - 1


def _scan_block(rows: DataFrame, ngrams: Broadcast) -> DataFrame:
    """Add one block's hits to those that the rows carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_in = NgramSet.load(ngrams.value)
        for batch in batches:
            n_words, runs, found = [], [], []
            for raw, before, seen in zip(*(batch.column(c).to_pylist() for c in ("raw", "hit_runs", "items"))):
                words = alnum_words(raw)
                hit, items = found_in.scan(words)
                for a, b in zip(before[::2], before[1::2]):
                    hit[a:b] = True
                n_words.append(len(words))
                runs.append(_runs(hit))
                found.append(sorted(items.union(seen)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("raw"), pa.array(n_words, pa.int64()),
                 pa.array(runs, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))],
                ["doc_id", "raw", "n_words", "hit_runs", "items"])

    return rows.mapInArrow(run, rows.schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 (the item ids sorted
    as strings, comma-joined), contaminated, and ``hit_runs``, the runs of hit
    words as start, end, start, end ... (word numbers, end exclusive)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("raw"),
                       F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("hit_runs"),
                       F.array().cast("array<string>").alias("items"))
    for ngrams, last in ngram_blocks(benchmark, item_col, item_text_col, window, block_bytes):
        rows = _scan_block(rows, ngrams)
        if not last:
            rows = cut(rows, "contamination")
    # ends minus starts: the runs alternate
    n_hit = F.aggregate(F.transform("hit_runs", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                        F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
                       (F.size("hit_runs") > 0).alias("contaminated"), "hit_runs")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window, all columns kept."""
    at = docs.columns.index(text_col)
    for ngrams, last in ngram_blocks(benchmark, item_col, item_text_col, window, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], ngrams=ngrams) -> Iterator[pa.RecordBatch]:
            found_in = NgramSet.load(ngrams.value)
            for batch in batches:
                clean = [not found_in.scan(alnum_words((t or "").encode()))[1] for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if not last:
            docs = cut(docs, "decontaminated")
    return docs


def cut_spans(text: str, hit_runs: list[int], mark: str = "") -> str:
    """``text`` with each run of hit words, from its first to its last
    character, replaced by ``mark``."""
    if not hit_runs:
        return text
    words = list(WORD.finditer(text))
    out, at = [], 0
    for a, b in zip(hit_runs[::2], hit_runs[1::2]):
        out += [text[at:words[a].start()], mark]
        at = words[b - 1].end()
    return "".join(out) + text[at:]
