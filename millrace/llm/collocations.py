"""Phrase collocations from counting quotient filters.

1. Words get ids: 64-bit fingerprints of language and word. One aggregate counts
   every word and proves that no two words share an id; else the next hash is taken.
2. For each length, a task packs the ids of consecutive words of a piece and permutes
   them invertibly. The permuted number's high bits are its quotient, all other bits its
   remainder: a filter stores run lengths per quotient and, sorted, the full remainders with
   their counts, so it is exact and its phrases can be read back. A filter covers
   a bounded number of words and is written in ranges of the quotient; the
   filters of one range from all shards are merged in order. Ranges are even,
   because the permutation spreads ids, and a phrase is one entry of a filter however
   often it occurs.
3. A phrase can only reach the least count if both its parts shorter by one word
   do, so longer phrases are counted behind a Bloom filter of the frequent shorter ones. Its
   size follows their number up to ``BLOOM_BITS``; a false hit adds an entry that the count
   drops.
4. Scores, subsumed phrases and ranks are joins and aggregates over the frequent
   phrases. Products are decimals of 38 digits, quotients whole numbers: exact for up to
   10**15 phrases and 10**16 words.

Edge cases: null and empty texts have no words; a null language is ``und``; ids are not
read, so repeated rows count as often as they are there; ties in score and
count go by phrase in byte order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, key_filter, may_hold, text_bytes, worker_keeps
from millrace.llm.minhash import Sketcher

MAX_WORDS, MIN_COUNT, TOP, PERCENT = 5, 100, 2000, 100
FLUSH_WORDS = 600_000  # words of a filter
ROWS_AT_ONCE = 250
RANGE_BYTES = 4 << 20  # text per range of the quotient
BLOOM_BITS = 1 << 27
NO_LANG = "und"

# A-Z become a-z, ends of pieces a line feed, tabs a blank
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b
                 for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xCF1BBCDCB7A56463)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def permute(columns: np.ndarray) -> np.ndarray:
    """Packed ids (one row of 64-bit numbers per word place) as well-mixed numbers of the same
    width: each row in turn is changed by a function of the next one only."""
    out, n = columns.copy(), len(columns)
    for turn in range(2):
        for j in range(n):
            out[j] ^= _mix(out[(j + 1) % n] + np.uint64(turn * 16 + j + 1))
    return out


def unpermute(columns: np.ndarray) -> np.ndarray:
    """What ``permute`` was given."""
    out, n = columns.copy(), len(columns)
    for turn in (1, 0):
        for j in range(n - 1, -1, -1):
            out[j] ^= _mix(out[(j + 1) % n] + np.uint64(turn * 16 + j + 1))
    return out


def _small(values: np.ndarray) -> bytes:
    """Counts as bytes, those over 254 apart."""
    low = np.minimum(values, 255).astype(np.uint8)
    return low.tobytes() + values[low == 255].astype("<u8").tobytes()


def _read_small(data: memoryview, n: int) -> tuple[np.ndarray, memoryview]:
    low = np.frombuffer(data, np.uint8, n)
    out, large = low.astype(np.int64), int((low == 255).sum())
    out[low == 255] = np.frombuffer(data, "<u8", large, n)
    return out, data[n + 8 * large:]


class CountingFilter:
    """Counts of permuted numbers: ``columns`` is (places, entries), sorted and distinct."""

    HEAD = "<BBBI"

    def __init__(self, columns: np.ndarray, counts: np.ndarray):
        self.columns, self.counts = columns, counts

    @classmethod
    def build(cls, columns: np.ndarray, counts: np.ndarray | None = None) -> "CountingFilter":
        """Sort and add up equal numbers."""
        counts = np.ones(columns.shape[1], np.int64) if counts is None else counts
        if not len(counts):
            return cls(columns, counts)
        order = np.argsort(columns[0], kind="stable")
        same = np.diff(columns[0][order]) == 0
        if same.any() and any((np.diff(c[order]) != 0)[same].any() for c in columns[1:]):
            order = np.lexsort(columns[::-1])  # different numbers with one first word
        columns, counts = columns[:, order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], (columns[:, 1:] != columns[:, :-1]).any(axis=0))))
        return cls(columns[:, first], np.add.reduceat(counts, first))

    @classmethod
    def merge(cls, filters: list["CountingFilter"]) -> "CountingFilter":
        return cls.build(np.concatenate([f.columns for f in filters], axis=1),
                         np.concatenate([f.counts for f in filters]))

    def ranges(self, bits: int) -> Iterator[tuple[int, "CountingFilter"]]:
        """(range, its part) by the highest ``bits`` of the quotient."""
        of = (self.columns[0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(self.counts), np.int64)
        edges = np.searchsorted(of, np.arange((1 << bits) + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            yield k, CountingFilter(self.columns[:, edges[k]:edges[k + 1]], self.counts[edges[k]:edges[k + 1]])

    def to_bytes(self, skip: int) -> bytes:
        """``skip`` highest bits are known from the range; then come the quotient's bits, about
        one quotient per entry, and the remainder."""
        n = len(self.counts)
        quotient_bits = min(max(0, n.bit_length() - 1), 64 - skip)
        rest_bits = 64 - skip - quotient_bits
        local = self.columns[0] & np.uint64((1 << (64 - skip)) - 1)
        quotients = (local >> np.uint64(rest_bits)).astype(np.int64) if rest_bits < 64 else np.zeros(n, np.int64)
        runs = np.bincount(quotients, minlength=1 << quotient_bits)
        width = -(-rest_bits // 8)
        low = local.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width].copy()
        if rest_bits % 8 and n:
            low[:, -1] &= (1 << rest_bits % 8) - 1
        return (struct.pack(self.HEAD, len(self.columns), quotient_bits, skip, n) + _small(runs) + low.tobytes()
                + self.columns[1:].astype("<u8").tobytes() + _small(self.counts))

    @classmethod
    def from_bytes(cls, number: int, data: bytes) -> "CountingFilter":
        places, quotient_bits, skip, n = struct.unpack_from(cls.HEAD, data)
        runs, rest = _read_small(memoryview(data)[struct.calcsize(cls.HEAD):], 1 << quotient_bits)
        rest_bits = 64 - skip - quotient_bits
        width = -(-rest_bits // 8)
        low = np.zeros((n, 8), np.uint8)
        low[:, :width] = np.frombuffer(rest, np.uint8, n * width).reshape(n, width)
        rest = rest[n * width:]
        columns = np.empty((places, n), np.uint64)
        high = np.repeat(np.arange(1 << quotient_bits, dtype=np.uint64), runs)
        columns[0] = low.view("<u8").ravel()
        if rest_bits < 64:
            columns[0] |= high << np.uint64(rest_bits)
        if skip:
            columns[0] |= np.uint64(number << (64 - skip))
        columns[1:] = np.frombuffer(rest, "<u8", (places - 1) * n).reshape(places - 1, n)
        return cls(columns, _read_small(rest[(places - 1) * n * 8:], n)[0])


class Words:
    """Ids of the words of many texts; ``attempt`` 0 hashes all words of a block together,
    later ones word by word with another function."""

    def __init__(self, attempt: int = 0):
        self.attempt, self.hasher = attempt, Sketcher(bands=1, rows=1, seed=77)

    def _lang(self, lang: str) -> np.uint64:
        import xxhash

        return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), seed=self.attempt))

    def read(self, lang: str, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
        """(id and piece of every word, the prepared text and where its words start and end)."""
        import xxhash

        raw = b"\n".join(texts).translate(_LETTERS)
        text = np.frombuffer(raw, np.uint8)
        gap = np.concatenate(([True], (text == 32) | (text == 10), [True]))
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        starts, ends = edges[::2], edges[1::2]
        pieces = np.cumsum(text == 10, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
        if self.attempt:
            hashes = np.array([xxhash.xxh3_64_intdigest(w, seed=self.attempt) for w in raw.split()], np.uint64)
        else:
            hashes = self.hasher.word_hashes(raw)
        return _mix(hashes ^ self._lang(lang)), pieces, raw, starts, ends


def _by_lang(whole: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for at in range(0, whole.num_rows, ROWS_AT_ONCE):
        batch, out = whole.slice(at, ROWS_AT_ONCE), {}
        for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("raw").to_pylist()):
            out.setdefault(lang, []).append(raw)
        yield from out.items()


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       text_bytes(text_col).alias("raw"))


def count_words(rows: DataFrame, attempt: int) -> DataFrame:
    """(id, lang, word, n) of all words, added up per task and then by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = worker_keeps(("collocation-words", attempt), lambda: Words(attempt))
        kept: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids, counts = (np.concatenate([k[j] for k in kept]) for j in (0, 1))
            langs, words = [x for k in kept for x in k[2]], [x for k in kept for x in k[3]]
            _, first, where = np.unique(ids, return_index=True, return_inverse=True)
            # words that share an id stay apart: the next step must see them
            alike = [words[f] == w and langs[f] == x for f, w, x in zip(first[where].tolist(), words, langs)]
            total = np.bincount(where, weights=np.where(alike, counts, 0)).astype(np.int64)
            odd = [k for k, same in enumerate(alike) if not same]
            take = np.concatenate((first, np.array(odd, np.int64))).astype(np.int64)
            numbers = np.concatenate((total, counts[odd]))
            kept.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[take].view(np.int64)), pa.array([langs[k] for k in take], pa.string()),
                 pa.array([words[k].decode() for k in take], pa.string()), pa.array(numbers)],
                ["id", "lang", "word", "n"])

        held = 0
        for batch in batches:
            for lang, texts in _by_lang(batch):
                ids, _, raw, starts, ends = reader.read(lang, texts)
                found, first, where = np.unique(ids, return_index=True, return_inverse=True)
                words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
                kept.append((found, np.bincount(where, minlength=len(found)), [lang] * len(words), words))
                held += len(found)
                if held >= FLUSH_WORDS // 3:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    counted = rows.mapInArrow(run, "id long, lang string, word string, n long")
    return counted.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))


def word_ids(rows: DataFrame, attempts: int = 8) -> tuple[DataFrame, int]:
    """The words with their counts, and the attempt whose ids are one to one."""
    for attempt in range(attempts):
        words = cut(count_words(rows, attempt), "collocation-words")
        if words.groupBy("id").agg(F.count("*").alias("m")).where("m > 1").isEmpty():
            return words, attempt
    raise ValueError("no hash gives every word an id of its own")


def gram_keys(ids: np.ndarray, places: int) -> np.ndarray:
    """A 64-bit key of every ``places`` consecutive ids, for Bloom filters."""
    n = max(0, len(ids) - places + 1)
    out = np.zeros(n, np.uint64)
    for j in range(places):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + n])
    return out


def bloom_of(phrases: DataFrame, places: int) -> Broadcast:
    """A Bloom filter of the phrases in column ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("ids").flatten().to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(gram_keys(flat, places)[::places].view(np.int64))], ["key"])

    return key_filter(phrases.select("ids").mapInArrow(run, "key long"), BLOOM_BITS)


def count_phrases(rows: DataFrame, places: int, bloom: Broadcast, attempt: int, min_count: int, range_bits: int) -> DataFrame:
    """(ids, n) of the phrases of ``places`` words that occur at least ``min_count`` times;
    ``bloom`` holds the frequent phrases that are shorter by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = worker_keeps(("collocation-words", attempt), lambda: Words(attempt))
        shorter = bloom.value
        kept: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            whole = CountingFilter.build(permute(np.concatenate(kept, axis=1)))
            parts = [(k, part.to_bytes(range_bits)) for k, part in whole.ranges(range_bits)]
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()),
                                               pa.array([b for _, b in parts], pa.binary())], ["number", "data"])

        held = 0
        for batch in batches:
            for lang, texts in _by_lang(batch):
                ids, pieces, *_ = reader.read(lang, texts)
                n = len(ids) - places + 1
                if n <= 0:
                    continue
                known = may_hold(shorter, gram_keys(ids, places - 1))
                at = np.flatnonzero(known[:-1] & known[1:] & (pieces[:n] == pieces[places - 1:]))
                kept.append(np.stack([ids[at + j] for j in range(places)]))
                held += len(at)
                if held >= FLUSH_WORDS:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        number = int(key[0])
        whole = CountingFilter.merge([CountingFilter.from_bytes(number, bytes(b)) for b in parts["data"]])
        often = whole.counts >= min_count
        ids = unpermute(whole.columns[:, often]).view(np.int64).T
        return pd.DataFrame({"ids": pd.Series(list(ids), dtype=object), "n": whole.counts[often]})

    filters = rows.mapInArrow(run, "number int, data binary")
    return filters.groupBy("number").applyInPandas(merge, "ids array<long>, n long")


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, text_col: str = "text",
                     lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases (ids, n) of one to ``max_words`` words; frequent words (id, lang, word); (lang, n)
    over all words)."""
    rows = _texts(docs, text_col, lang_col)
    words, attempt = word_ids(rows)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = cut(words.where(F.col("n") >= min_count), "frequent-words")
    size = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    range_bits = max(4, int(size // RANGE_BYTES).bit_length())
    phrases = level = often.select(F.array("id").alias("ids"), "n")
    for places in range(2, max_words + 1):
        bloom = bloom_of(level, places - 1)
        level = cut(count_phrases(rows, places, bloom, attempt, min_count, range_bits), f"phrases-{places}")
        bloom.destroy()
        phrases = phrases.unionByName(level)
    return phrases, often.select("id", "lang", "word"), totals


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 percent: int = PERCENT, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the first ``top`` phrases of two and more
    words by their lowest score over all cuts in two parts. A phrase goes if a longer
    one around it has ``percent`` of its occurrences or more."""
    phrases, words, totals = frequent_phrases(docs, max_words, min_count, text_col, lang_col)
    long = phrases.where(F.size("ids") > 1).withColumnRenamed("n", "a")
    inside = long.select(F.col("a").alias("longer"), "ids", F.explode(F.sequence(F.lit(1), F.size("ids"))).alias("at"))
    inside = inside.select("longer", "ids", "at", F.explode(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size("ids") - F.col("at") + 1))).alias("size"))
    inside = (inside.where("size < size(ids) AND at + size - 1 <= size(ids)")
              .groupBy(F.expr("slice(ids, at, size)").alias("ids")).agg(F.max("longer").alias("longer")))
    left = (long.join(inside, "ids", "left").where(f"longer IS NULL OR 100 * longer < {percent} * a").select("ids", "a"))
    named = (left.select("ids", F.posexplode("ids").alias("at", "id")).join(words, "id").groupBy("ids")
             .agg(F.first("lang").alias("lang"),
                  F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ")
                  .alias("phrase")))
    cuts = (left.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
            .select("ids", "a", "k", F.expr("slice(ids, 1, k)").alias("head"),
                    F.expr("slice(ids, k + 1, size(ids) - k)").alias("tail"))
            .join(phrases.select(F.col("ids").alias("head"), F.col("n").alias("l")), "head")
            .join(phrases.select(F.col("ids").alias("tail"), F.col("n").alias("r")), "tail")
            .join(named, "ids").join(totals, "lang"))
    score = F.expr("(CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(n AS DECIMAL(16, 0)))"
                   " div (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0)))")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
