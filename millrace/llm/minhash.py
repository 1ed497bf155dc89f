"""Near-duplicates by MinHash with banding, confirmed on full shingle sets.

1. One pass turns a text into its set of 5-word shingles (64-bit hashes), the
   set's digest, ``BANDS * ROWS`` universal-hash minima cut to a byte each,
   and a key per band. Texts with equal sets become one class; only the
   smallest id of a class goes on.
2. Members of a band's bucket are paired with one member of it, the hub: the one
   whose buckets are largest together, which in a group of copies is the text
   they were made from. Pairs grow with the rows, not with the square of a
   bucket. Signatures estimate each pair's similarity.
3. Each member's best hub is checked on the full sets; the links give
   components by alternating large-star and small-star.
4. Documents that share a bucket but not a component are compared exactly: their
   shingles are put in one order, rare ones first. Two sets that the
   threshold links have a shingle in common among the first quarter of each, and
   at the first such place enough shingles are left on both sides. The longer set of a
   pair asks in bands of set sizes that its place allows, and a shorter one answers only
   from the first places that any longer one allows (a seventh of its set at 75), so
   a passage that many otherwise different texts share pairs none of them. Pairs of
   different components that pass this are checked by signature and on full
   sets, so no pair of a bucket that the threshold links is lost. Texts that
   differ have shingles of their own, which fill their first quarter, so few
   pairs remain. The components of all links are the result.

A pair at the threshold 0.75 shares no bucket with probability
``(1 - 0.75 ** 5) ** 48``, 2e-6, and its estimate falls below ``ESTIMATE_MIN``,
five standard deviations under the threshold, with less than 1e-6.

Edge cases: null and empty texts have no words, an empty set and no links;
texts under five words have their whole word sequence as one shingle; rows
with a null id have no component and are kept; rows that repeat an id share
a component and ``kept``; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, in_filter, key_filter, sha256_hex, text_blocks, text_bytes, worker_keeps
from millrace.llm.components import components

SHINGLE = 5
BANDS, ROWS = 48, 5
PERCENT = 75
ESTIMATE_MIN = 0.60
SEED = 20240229
TEXT_BLOCK = 1 << 20  # bytes of a text that are hashed at a time
SIZE_BAND = 1.04  # set sizes of a band differ by less than this factor
SET_BLOCK = 512  # shingles that are hashed by all functions at a time

_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2 ** 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (splitmix finaliser)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Sketcher:
    """Shingle sets, minima and band keys; all tables follow from the seed."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, seed: int = SEED):
        draw = np.random.default_rng(seed)
        some = lambda n: draw.integers(0, 2 ** 64, n, np.uint64)
        self.bands, self.rows, self.shingle = bands, rows, shingle
        self.letters, self.places = some(256), some(shingle) | np.uint64(1)
        self.factor, self.offset = some(bands * rows) | np.uint64(1), some(bands * rows)
        self.band_seed, self.row_factor = some(bands), some(rows) | np.uint64(1)
        power = np.full(TEXT_BLOCK + 1, _BASE, np.uint64)
        power[0] = 1
        self.power = np.multiply.accumulate(power)
        power[1:] = np.uint64(_BASE_INVERSE)
        self.unpower = np.multiply.accumulate(power)

    def _block_words(self, raw: bytes) -> np.ndarray:
        """A hash per word of one block: the sum of letter times base**place
        over the word, taken from prefix sums and moved to place 0."""
        text = np.frombuffer(raw, np.uint8)
        gap = np.concatenate(([True], _SPACE[text], [True]))
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        starts, ends = edges[::2], edges[1::2]
        if len(text) <= TEXT_BLOCK:
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.letters[text] * self.power[:len(text)])))
            return _mix((sums[ends] - sums[starts]) * self.unpower[starts])
        # a word longer than a block: place by place, in pieces
        out = []
        for a, b in zip(starts.tolist(), ends.tolist()):
            total = 0
            for at in range(a, b, TEXT_BLOCK):
                piece = text[at:min(b, at + TEXT_BLOCK)]
                part = int(np.sum(self.letters[piece] * self.power[:len(piece)], dtype=np.uint64))
                total = (total + part * pow(_BASE, at - a, 2 ** 64)) % 2 ** 64
            out.append(total)
        return _mix(np.array(out, np.uint64))

    def word_hashes(self, text: bytes) -> np.ndarray:
        raw = text.lower()  # bytes: A-Z only
        if len(raw) <= TEXT_BLOCK:
            return self._block_words(raw)
        return np.concatenate([self._block_words(block) for block in text_blocks(raw, TEXT_BLOCK)])

    def shingles(self, text: bytes) -> np.ndarray:
        """The sorted distinct shingle hashes of a text."""
        words = self.word_hashes(text)
        size = min(self.shingle, len(words))
        if not size:
            return words
        n = len(words) - size + 1
        sums = np.full(n, size, np.uint64)
        for j in range(size):
            sums += words[j:j + n] * self.places[j]
        return np.unique(_mix(sums))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(self.factor), 2 ** 64 - 1, np.uint64)
        for at in range(0, len(shingles), SET_BLOCK):
            values = self.factor[:, None] * shingles[None, at:at + SET_BLOCK]
            values += self.offset[:, None]
            np.minimum(out, values.min(axis=1), out=out)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """A signed 64-bit key per band."""
        rows = _mix(minima.reshape(self.bands, self.rows)) * self.row_factor
        return _mix(rows.sum(axis=1, dtype=np.uint64) + self.band_seed).view(np.int64)


def signature(minima: np.ndarray) -> bytes:
    """The highest well-mixed byte of each minimum."""
    return (_mix(minima) >> np.uint64(56)).astype(np.uint8).tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarities from signatures, one pair per row; bytes of different
    minima agree once in 256."""
    agree = (a == b).mean(axis=1)
    return (agree - 1 / 256) / (1 - 1 / 256)


def set_digest(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, sig, keys, text_sha256) per document; the last is of the
    text after lower-casing A-Z, as in exact dedup."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = worker_keeps(("sketcher",), Sketcher)
        for batch in batches:
            sizes, digests, sigs, keys, texts = [], [], [], [], []
            for raw in batch.column("raw"):
                shingles = sketcher.shingles(raw.as_py())
                texts.append(sha256_hex(raw.as_py().lower()))
                sizes.append(len(shingles))
                digests.append(set_digest(shingles))
                minima = sketcher.minima(shingles) if len(shingles) else None
                sigs.append(b"" if minima is None else signature(minima))
                keys.append([] if minima is None else sketcher.keys(minima))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(texts, pa.string())],
                ["doc_id", "n_shingles", "digest", "sig", "keys", "text_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sig binary, keys array<long>, "
                                "text_sha256 string")


def _with_both(pairs: DataFrame, facts: DataFrame, col: str) -> DataFrame:
    """(a, b) with the column of both ends as x and y."""
    return (pairs.join(facts.select(F.col("doc_id").alias("a"), F.col(col).alias("x")), "a")
            .join(facts.select(F.col("doc_id").alias("b"), F.col(col).alias("y")), "b"))


def _estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, estimate) of the pairs whose signatures can reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                        for c in ("x", "y"))
                value = estimate(x, y)
                out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value)],
                                                 ["a", "b", "estimate"])
                yield out.filter(pa.array(value >= ESTIMATE_MIN))

    return _with_both(pairs, reps, "sig").mapInArrow(run, "a long, b long, estimate double")


def _full_sets(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, shingles): the whole sets of some documents, from their texts. A Bloom filter of the
    ids stops the other texts before the join."""
    ids = cut(ids.distinct(), "set-ids")
    found = key_filter(ids.select(F.col("doc_id").alias("key")))
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw"))
             .where("doc_id IS NOT NULL").where(in_filter(found, F.col("doc_id"))).join(ids, "doc_id", "left_semi"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = worker_keeps(("sketcher",), Sketcher)
        for batch in batches:
            found = [sketcher.shingles(t.as_py()).view(np.int64) for t in batch.column("raw")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))],
                                             ["doc_id", "shingles"])

    return cut(texts.mapInArrow(sets, "doc_id long, shingles array<long>"), "shingle-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough, as edges (u, v)."""

    def similar(x, y) -> bool:
        both = len(np.intersect1d(x.values.to_numpy(), y.values.to_numpy(), assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similar(x, y) for x, y in zip(batch.column("x"), batch.column("y"))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             ["u", "v"]).filter(pa.array(good, pa.bool_()))

    return cut(_with_both(pairs, sets, "shingles").mapInArrow(run, "u long, v long"), "links")


def _prefix_pairs(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that can reach the threshold; ``apart`` is
    (doc_id, n_shingles, component). Places count from 0 in the order of rarity;
    a shingle that no other of these documents has takes a place but no row."""
    shingles = sets.select("doc_id", F.explode("shingles").alias("shingle"))
    common = shingles.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    each, ranked = Window.partitionBy("doc_id"), Window.partitionBy("doc_id").orderBy("df", "shingle")
    rows = (shingles.join(common, "shingle").join(apart, "doc_id")
            .withColumn("place", F.col("n_shingles") - F.count("*").over(each) + F.row_number().over(ranked) - 1)
            .where(F.expr(f"place <= n_shingles - ceil({percent} * n_shingles / 100)")))
    rows = cut(rows.select("shingle", "doc_id", "n_shingles", "component", "place"), "prefixes")

    def band(size: str):
        return F.floor(F.log(size) / float(np.log(SIZE_BAND)))

    # sets that link have percent / (100 + percent) of their sizes together in common, at
    # this place and after it; x is the longer set, of equally long ones that with the larger id
    asks = (rows.withColumn("lo", F.expr(f"ceil({percent} * n_shingles / 100)"))
            .withColumn("hi", F.expr(f"least(n_shingles, (n_shingles - place) * {100 + percent} div {percent} - n_shingles)"))
            .where("lo <= hi").withColumn("band", F.explode(F.sequence(band("lo"), band("hi")))))
    answers = (rows.where(f"(n_shingles - place) * {100 + percent} >= {2 * percent} * n_shingles")
               .withColumn("band", band("n_shingles")))
    can = F.expr(f"""x.shingle = y.shingle AND x.band = y.band AND x.component <> y.component
        AND y.n_shingles BETWEEN x.lo AND x.hi AND (x.n_shingles > y.n_shingles OR x.doc_id > y.doc_id)
        AND (y.n_shingles - y.place) * {100 + percent} >= {percent} * (x.n_shingles + y.n_shingles)""")
    pairs = asks.alias("x").join(answers.alias("y"), can)
    return pairs.select(*_pair(F.col("x.doc_id"), F.col("y.doc_id"))).distinct()


def _pair(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, digests: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, with ``digests`` also
    text_sha256."""
    sketches = cut(sketch(docs, id_col, text_col), "sketches")
    named = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = named.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"])
    reps = cut(reps.select("doc_id", "digest", "n_shingles", "sig", "keys"), "classes")

    rows = reps.select("doc_id", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(rows.join(sizes, "key"), "buckets")  # buckets of one document are gone
    weights = shared.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    hubs = (shared.join(weights, "doc_id").groupBy("key")
            .agg(F.max_by("doc_id", F.struct("weight", -F.col("doc_id"))).alias("hub")))

    starred = shared.join(hubs, "key").where("doc_id <> hub").select("doc_id", "hub").distinct()
    scored = _estimated(starred.select(F.col("doc_id").alias("a"), F.col("hub").alias("b")), reps)
    best = cut(scored.groupBy("a").agg(F.max_by("b", "estimate").alias("b")), "best-hubs")
    links = _confirmed(best, _full_sets(best.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, id_col,
                                        text_col), percent)

    joined = components(links)
    placed = (shared.select("key", "doc_id").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .withColumn("component", F.coalesce("component", "doc_id")))
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    apart = placed.join(split.select("key"), "key", "left_semi").select("doc_id", "component").distinct()
    apart = cut(apart.join(reps.select("doc_id", "n_shingles"), "doc_id"), "apart")
    sets = _full_sets(apart.select("doc_id"), docs, id_col, text_col)
    near = cut(_estimated(_prefix_pairs(apart, sets, percent), reps).select("a", "b"), "near-pairs")
    more = _confirmed(near, sets, percent)

    whole = components(links.unionByName(more))
    classed = (reps.select("digest", F.col("doc_id").alias("node")).join(whole, "node", "left")
               .select("digest", F.coalesce("component", "node").alias("component")).distinct())
    out = sketches.select("doc_id", "n_shingles", "digest", "text_sha256").join(cut(classed, "class-components"), "digest", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
                      *(["text_sha256"] if digests else []))
