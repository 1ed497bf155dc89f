"""Repeated byte spans by bucket-pointer refinement of sampled suffixes.

A byte is repeated if a string of ``LENGTH`` bytes over it also starts earlier: in
a smaller document, or before in the same one.

1. Suffixes are sampled by content: of the ``GRAM``-byte strings in every window of
   ``LENGTH`` bytes the one with the smallest hash is its anchor, so equal windows have their
   anchors at the same place. Consecutive windows with one anchor are a group. The
   initial bucket of a group is its anchor's string.
2. Buckets are refined by the identifiers of later offsets: within a bucket, groups with the
   same identifier of the whole stretch from the first window's start to the last
   one's end have the same windows. All but the first of them are repeated. A bucket that is
   left with one member, which holds its string once, needs no more work.
3. What is left in shared buckets is refined again by the same step: now the suffixes are
   cores of 84 bytes that ``STEP`` neighbouring windows share, bucketed by their
   identifier; members of shared buckets go on to their single windows, whose identifiers
   (two 64-bit numbers) decide.

Identifiers are names made of the content (polynomials with random letters), so pointers
to later offsets are read off prefix sums and no rank has to be sent back to a
suffix. Equal strings have equal names; different strings with one bucket name only cost a
comparison, and equality is decided by names of 128 bits.

One shuffle per refinement: a task first compares what it has itself. Of groups
with equal names it sends the first and knows the others to be repeated; a bucket that it
knows to be shared is sent as one marker, and its members are dealt by their own names. So
however frequent a string is, its bucket gets one row per ``FLUSH`` rows of input. Sorted
partitions are read as streams. Texts are shuffled only for documents with groups in shared buckets
and, at the end, for those that lose some but not all bytes.

Edge cases: null and empty texts have no bytes; a text shorter than ``LENGTH`` keeps all; a
null id comes before all others; rows that share an id are ordered by a 64-bit
digest of their texts, so equal rows are one document and both get its result; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, in_filter, key_filter, text_bytes, worker_keeps

LENGTH = 100
GRAM = 32
STEP = 17  # windows that share a core of LENGTH - STEP + 1 bytes
FLUSH = 1_000_000  # rows that a task compares at a time
BLOCK = 1 << 18  # windows named at a time
SEED = 20240311
FIRST_ID = -(2 ** 63)
_BASE = 0x9E3779B97F4A7C15 | 1
REPEATED, MARKER, MEMBER, SHARED = 0, 1, 2, 3
ROWS = "kind tinyint, bucket long, name long, doc long, copy long, start long, end long, data binary"
_FIELDS = ("kind", "bucket", "name", "doc", "copy", "start", "end")


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Namer:
    """Names of the strings of a text of at most ``BLOCK + LENGTH`` bytes."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.length, self.gram = length, gram
        self.letters = draw.integers(0, 2 ** 64, (2, 256), np.uint64)
        size = BLOCK + 2 * length + 1
        for name, base in (("power", _BASE), ("unpower", pow(_BASE, -1, 2 ** 64))):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            setattr(self, name, np.multiply.accumulate(values))

    def sums(self, text: np.ndarray, which: int) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.letters[which][text] * self.power[:len(text)])))

    def names(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((sums[ends] - sums[starts]) * self.unpower[starts])

    def grams(self, sums: np.ndarray) -> np.ndarray:
        return _mix((sums[self.gram:] - sums[:-self.gram]) * self.unpower[:len(sums) - self.gram])

    def groups(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, name, first window, end of the last window, whether windows go on after an
        anchor to its next occurrence) per group of one block."""
        sums, other = self.sums(text, 0), self.sums(text, 1)
        grams = least = self.grams(sums)
        wide = 1
        span = self.length - self.gram + 1
        while 2 * wide <= span:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if wide < span:
            least = np.minimum(least[:wide - span], least[span - wide:])
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        sizes = np.diff(np.append(first, len(least)))
        if sizes.max() > span:  # an anchor string that repeats at once: cut evenly
            parts = -(-sizes // span)
            begin = np.repeat(np.cumsum(parts) - parts, parts)
            first = np.repeat(first, parts) + (np.arange(parts.sum()) - begin) * span
        last = np.append(first[1:], len(least)) - 1
        passed = np.concatenate(([0], np.cumsum(grams[:len(least)] == least)))
        return (least[first], self.names(other, first, last + self.length), first, last + self.length,
                passed[last] > passed[first])

    def cores(self, text: np.ndarray, edges: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
        """(name of the core, name of all, first window, end of the last window) of the stretches
        of many groups' texts, one after the other with these ``edges``: windows whose anchor is the
        same and equally far in steps."""
        sums, other, span = self.sums(text, 0), self.sums(text, 1), self.length - self.gram + 1
        sizes = np.diff(edges)
        grams = np.append(self.grams(sums), np.full(self.gram - 1, 2 ** 64 - 1, np.uint64))
        here = np.repeat(edges[1:], sizes) - np.arange(len(text))  # bytes left in the group
        grams[here < self.gram] = 2 ** 64 - 1
        least = np.repeat(np.minimum.reduceat(grams, edges[:-1]), sizes)
        places = np.where(grams == least, np.arange(len(text)), len(text))
        places = np.minimum.accumulate(places[::-1])[::-1]  # the next anchor
        windows = np.flatnonzero(here >= self.length)
        anchor = places[windows]
        key = anchor * self.length + (anchor - windows) // step
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        ends = windows[np.append(first[1:], len(windows)) - 1] + self.length
        first = windows[first]
        far = (places[first] - first) // step * step
        begin = places[first] - far  # the last window of a whole stretch
        # a stretch at the far end is shorter; its core stays inside every window of it
        core = begin + self.length - np.minimum(step - 1, span - 1 - far)
        return self.names(sums, begin, core), self.names(other, first, ends), first, ends

    def windows(self, text: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(both names, place) of every window of many stretches' texts."""
        here = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(text))
        starts = np.flatnonzero(here >= self.length)
        return *(self.names(self.sums(text, j), starts, starts + self.length) for j in (0, 1)), starts


def _some(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts of at most 3 ``LENGTH`` bytes or so, some at a time: (from, to, their bytes, edges)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends, at = np.cumsum(sizes), 0
    while at < len(texts):
        before = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, before + BLOCK, "right")))
        yield at, to, np.frombuffer(b"".join(texts[at:to]), np.uint8), np.append(ends[at:to] - sizes[at:to], ends[to - 1]) - before
        at = to


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as sorted intervals that do not touch."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return starts[first], reach[np.append(first[1:], len(starts)) - 1]


def _batch(columns: dict[str, np.ndarray], data: list | None = None) -> pa.RecordBatch:
    n = len(columns["doc"])
    full = [columns[c] if c in columns else np.zeros(n, np.int64) for c in _FIELDS]
    arrays = [pa.array(full[0].astype(np.int8))] + [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in full[1:]]
    return pa.RecordBatch.from_arrays(arrays + [pa.array(data if data is not None else [None] * n, pa.binary())],
                                      [*_FIELDS, "data"])


def _repeats(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Repeated stretches, joined per document."""
    doc, copy, start, end = (columns[c] for c in ("doc", "copy", "start", "end"))
    order = np.lexsort((start, copy, doc))
    doc, copy, start, end = doc[order], copy[order], start[order], end[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1]) | (start[1:] > end[:-1])))
    first = np.flatnonzero(new)
    # ends only grow along a document's groups
    last = np.append(first[1:], len(start)) - 1
    return _batch({"kind": np.full(len(first), REPEATED), "doc": doc[first], "copy": copy[first], "start": start[first],
                   "end": end[last]})


class Comparer:
    """Rows of one task, compared ``FLUSH`` at a time before they are sent. In the ``last`` step
    a bucket and a name are one identifier, so all rows are dealt by bucket. A row that has its bucket's
    string ``twice`` shares the bucket with itself."""

    def __init__(self, with_data: bool = False, last: bool = False):
        self.last = last
        self.parts: list[dict[str, np.ndarray]] = []
        self.data: list | None = [] if with_data else None
        self.held = 0

    def add(self, data: list | None = None, **columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.held += len(columns["doc"])
        if self.data is not None:
            self.data += data

    def full(self) -> bool:
        return self.held >= FLUSH

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        rows = {c: np.concatenate([p[c] for p in self.parts]) for c in self.parts[0]}
        data, self.parts, self.data, self.held = self.data, [], None if self.data is None else [], 0
        both = _mix(rows["bucket"] + rows["name"] * np.uint64(_BASE))
        order = np.lexsort((rows["start"], rows["copy"], rows["doc"], both))
        bucket, name = rows["bucket"][order], rows["name"][order]
        again = np.concatenate(([False], (bucket[1:] == bucket[:-1]) & (name[1:] == name[:-1])))
        if again.any():
            yield _repeats({c: rows[c][order[again]] for c in ("doc", "copy", "start", "end")})
        first = order[~again]
        by_bucket = first[np.argsort(rows["bucket"][first], kind="stable")]
        same = np.diff(rows["bucket"][by_bucket]) == 0
        shared = (np.concatenate(([False], same)) | np.concatenate((same, [False]))) & (not self.last)
        if "twice" in rows:
            shared |= rows.pop("twice")[by_bucket]
        heads = by_bucket[shared & ~np.concatenate(([False], same))]
        if len(heads):
            yield _batch({"kind": np.full(len(heads), MARKER), "bucket": rows["bucket"][heads],
                          "doc": np.zeros(len(heads), np.int64)})
        yield _batch({"kind": np.where(shared, SHARED, MEMBER), **{c: rows[c][by_bucket] for c in rows}},
                     None if data is None else [data[k] for k in by_bucket.tolist()])


def refine(rows: DataFrame) -> DataFrame:
    """What a ``Comparer`` sent, compared over all tasks: repeated stretches, and the members of
    shared buckets that are the first with their name."""
    key = (F.when(F.col("kind") == REPEATED, F.xxhash64("doc", "copy"))
           .when(F.col("kind") == SHARED, F.xxhash64("bucket", "name")).otherwise(F.col("bucket")))
    dealt = rows.repartition(key).sortWithinPartitions(
        F.col("kind") == SHARED, "bucket", F.col("kind") > MARKER, "name", "doc", "copy", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows of the last bucket, one per flush and name at most
        last = None  # the last name of a bucket that is known to be shared
        for batch in batches:
            yield from _known(batch, REPEATED)
            kind = batch.column("kind").to_numpy()
            shared = batch.filter(pa.array(kind == SHARED))
            if shared.num_rows:
                bucket, name = (shared.column(c).to_numpy() for c in ("bucket", "name"))
                again = np.concatenate(([(bucket[0], name[0]) == last], (bucket[1:] == bucket[:-1]) & (name[1:] == name[:-1])))
                last = (bucket[-1], name[-1])
                yield from _told(shared, again, ~again)
            open_ = batch.filter(pa.array((kind == MARKER) | (kind == MEMBER)))
            if open_.num_rows:
                table = pa.Table.from_batches(([] if held is None else held.to_batches()) + [open_])
                bucket = table.column("bucket").to_numpy()
                whole = int(np.searchsorted(np.cumsum(bucket[::-1] != bucket[-1]), 1))  # rows of the last bucket
                yield from _closed(table.slice(0, len(bucket) - whole))
                held = table.slice(len(bucket) - whole)
        if held is not None:
            yield from _closed(held)

    def _known(batch, kind) -> Iterator[pa.RecordBatch]:
        some = batch.filter(pa.array(batch.column("kind").to_numpy() == kind))
        if some.num_rows:
            yield some

    def _told(table, again: np.ndarray, candidates: np.ndarray) -> Iterator[pa.RecordBatch]:
        if again.any():
            some = table.filter(pa.array(again))
            yield _repeats({c: some.column(c).to_numpy() for c in ("doc", "copy", "start", "end")})
        if candidates.any():
            some = table.filter(pa.array(candidates))
            columns = {c: some.column(c).to_numpy() for c in _FIELDS[1:]}
            yield _batch({"kind": np.full(some.num_rows, SHARED), **columns}, some.column("data").to_pylist())

    def _closed(table) -> Iterator[pa.RecordBatch]:
        """Whole buckets: markers first, then the members by name."""
        if not table.num_rows:
            return
        kind, bucket, name = (table.column(c).to_numpy() for c in ("kind", "bucket", "name"))
        member = kind == MEMBER
        same = (bucket[1:] == bucket[:-1])
        again = np.concatenate(([False], same & (name[1:] == name[:-1]) & member[1:] & member[:-1]))
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        # a bucket is shared if it has a marker or several names
        several = np.add.reduceat((member & ~again).astype(np.int64), first) > 1
        marked = ~member[first]
        shared = np.repeat(several | marked, np.diff(np.append(first, len(bucket))))
        yield from _told(table, again, member & ~again & shared)

    return dealt.mapInArrow(run, ROWS)


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, doc, copy, raw) of all rows and of the documents: ``doc`` and ``copy`` name a document and
    give its place. Where ids repeat, every copy is a digest of the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw"))
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(FIRST_ID)))
    repeat = not rows.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    rows = rows.withColumn("copy", F.xxhash64("raw") if repeat else F.lit(0).cast("long"))
    return rows, rows.dropDuplicates(["doc", "copy"]) if repeat else rows


def _doc_key():
    return F.xxhash64("doc", "copy")


def _with_texts(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """``wanted`` (doc, copy, ...) with the texts; those of other documents are not shuffled."""
    found = key_filter(wanted.select(_doc_key().alias("key")))
    return rows.where(in_filter(found, _doc_key())).select("doc", "copy", "raw").join(wanted, ["doc", "copy"])


def _groups(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        namer, own = worker_keeps(("spans", BLOCK), Namer), Comparer()
        for batch in batches:
            for doc, copy, raw in zip(batch.column("doc").to_pylist(), batch.column("copy").to_pylist(), batch.column("raw")):
                text = np.frombuffer(raw.as_buffer(), np.uint8) if len(raw.as_buffer()) else np.zeros(0, np.uint8)
                for at in range(0, len(text) - namer.length + 1, BLOCK):
                    bucket, name, start, end, twice = namer.groups(text[at:at + BLOCK + namer.length - 1])
                    n = len(bucket)
                    own.add(twice=twice, bucket=bucket, name=name, doc=np.full(n, doc), copy=np.full(n, copy), start=start + at, end=end + at)
                    if own.full():
                        yield from own.flush()
        yield from own.flush()

    return rows.select("doc", "copy", "raw").mapInArrow(run, ROWS)


def _cores(candidates: DataFrame, rows: DataFrame) -> DataFrame:
    wanted = candidates.groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "end")).alias("groups"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        namer, own = worker_keeps(("spans", BLOCK), Namer), Comparer(with_data=True)
        for batch in batches:
            docs, copies, begins, texts = [], [], [], []
            for doc, copy, raw, groups in zip(*(batch.column(c) for c in ("doc", "copy", "raw", "groups"))):
                raw, pairs = memoryview(raw.as_buffer()), groups.values.flatten()
                begins += pairs[0].to_pylist()
                texts += [raw[a:b] for a, b in zip(*(x.to_pylist() for x in pairs))]
                docs += [doc.as_py()] * len(groups)
                copies += [copy.as_py()] * len(groups)
            docs, copies, begins = (np.array(x, np.int64) for x in (docs, copies, begins))
            for at, to, text, edges in _some(texts):
                bucket, name, start, end = namer.cores(text, edges, STEP)
                of = np.searchsorted(edges, start, "right") - 1
                raw, shift = text.tobytes(), begins[at + of] - edges[of]
                own.add([raw[a:b] for a, b in zip(start.tolist(), end.tolist())], bucket=bucket, name=name,
                        doc=docs[at + of], copy=copies[at + of], start=start + shift, end=end + shift)
                if own.full():
                    yield from own.flush()
        yield from own.flush()

    return _with_texts(wanted, rows).mapInArrow(run, ROWS)


def _windows(stretches: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        namer, own = worker_keeps(("spans", BLOCK), Namer), Comparer(last=True)
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            if (kind == REPEATED).any():
                yield batch.filter(pa.array(kind == REPEATED))
            batch = batch.filter(pa.array(kind == SHARED))
            doc, copy, begin = (batch.column(c).to_numpy() for c in ("doc", "copy", "start"))
            for at, to, text, edges in _some(batch.column("data").to_pylist()):
                bucket, name, start = namer.windows(text, edges)
                of = np.searchsorted(edges, start, "right") - 1
                start += begin[at + of] - edges[of]
                own.add(bucket=bucket, name=name, doc=doc[at + of], copy=copy[at + of], start=start, end=start + namer.length)
                if own.full():
                    yield from own.flush()
        yield from own.flush()

    return stretches.mapInArrow(run, ROWS)


def _unions(stretches: DataFrame) -> DataFrame:
    """(doc, copy, starts, ends, n_removed) from repeated stretches."""
    lists = stretches.groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "end")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = [], []
            for parts in batch.column("parts"):
                a, b = merged(*(x.to_numpy() for x in parts.values.flatten()))
                starts.append(a)
                ends.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("copy"), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
                 pa.array([int((b - a).sum()) for a, b in zip(starts, ends)], pa.int64())],
                ["doc", "copy", "starts", "ends", "n_removed"])

    return lists.mapInArrow(run, "doc long, copy long, starts array<long>, ends array<long>, n_removed long")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc, copy, starts, ends, n_removed) of the documents (from ``numbered``) with repeated bytes:
    the longest stretches of bytes that go."""
    first = cut(refine(_groups(rows)).select("kind", "doc", "copy", "start", "end"), "span-groups")
    rest = refine(_windows(refine(_cores(first.where(F.col("kind") == SHARED), rows))))
    rest = cut(rest.where(F.col("kind") == REPEATED).select("doc", "copy", "start", "end"), "span-windows")
    found = first.where(F.col("kind") == REPEATED).select("doc", "copy", "start", "end").unionByName(rest)
    return cut(_unions(found), "spans")


def remaining(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, copy, kept): the bytes that stay, of documents with spans. A cut may go through a
    character, so they are bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for raw, starts, ends in zip(*(batch.column(c) for c in ("raw", "starts", "ends"))):
                text = raw.as_py()
                begin = [0, *ends.values.to_pylist()]
                kept.append(b"".join(text[a:b] for a, b in zip(begin, [*starts.values.to_pylist(), len(text)])))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("copy"), pa.array(kept, pa.binary())],
                                             ["doc", "copy", "kept"])

    return _with_texts(spans, rows).mapInArrow(run, "doc long, copy long, kept binary")


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the bytes that stay."""
    rows, single = numbered(docs, id_col, text_col)
    spans = repeated_spans(single)
    facts = rows.select("doc_id", "doc", "copy", F.octet_length("raw").cast("long").alias("n_bytes"),
                        F.unhex(F.sha2("raw", 256)).alias("whole"))
    told = cut(facts.join(spans.select("doc", "copy", "n_removed", F.size("starts").cast("long").alias("n_spans")),
                          ["doc", "copy"], "left"), "span-facts")
    partly = told.where("n_removed < n_bytes").select("doc", "copy").distinct()
    kept = remaining(single, spans.join(partly, ["doc", "copy"], "left_semi"))
    kept = cut(kept.select("doc", "copy", F.unhex(F.sha2("kept", 256)).alias("left")), "span-digests")
    digest = F.when(F.col("n_removed").isNull(), F.col("whole")).when(F.col("n_removed") < F.col("n_bytes"), F.col("left")) \
        .otherwise(F.unhex(F.sha2(F.lit("").cast("binary"), 256)))
    return told.join(kept, ["doc", "copy"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.lower(F.hex(digest)).alias("kept_sha256"))
