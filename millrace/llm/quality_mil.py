"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage of a text is
turned into numbers that need no vocabulary (shares of byte classes and of pairs
of them, word shapes, repetition, hashed words), encoded by a learned layer, and
weighted by gated attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))``; the
weighted mean is scored. Only document labels are given: which passages matter
is learned by the attention weights.

Training uses at most ``TRAIN_DOCS`` labelled documents, those with the smallest
hash of their id, and every passage of each; a step works through a batch's
passages ``STEP_ROWS`` at a time. Scoring reads whole texts, block by block, keeping
two numbers per passage.

Edge cases: null and empty texts are one passage without words and get the score
the model gives it; a null id is scored and never trains; a null label does not
train; rows that repeat an id in the labels count with the largest label; of
documents that repeat an id with other texts, the one whose features come first as
bytes trains, whatever the order of the rows; a training set without both labels gives the constant score of its share of ones
(0.5 without any); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, text_blocks, text_bytes

PASSAGE = 64
TRAIN_DOCS = 6000
HIDDEN, GATE = 24, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 3e-3, 1e-4
SEED = 7
STEP_ROWS = 1 << 14
TEXT_BLOCK = 1 << 18

# byte classes: letters by case, digits, white space, marks one by one, non-ASCII
_GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r", b"\n",
           *(bytes([b]) for b in b".,!?;:|*$&%#@=/-_"), b"'\"", b"()[]{}<>"]
CLASSES = len(_GROUPS) + 2
_CLASS = np.full(256, CLASSES - 2, np.int64)
for _i, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _i
_CLASS[128:] = CLASSES - 1
PAIRS, WORDS, SHAPES = 64, 32, 8
FEATURES = CLASSES + PAIRS + WORDS + SHAPES
_GAP = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_ALNUM = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
_FIELD = np.random.default_rng(SEED).integers(1, 2 ** 63, 256, np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray, bits: int) -> np.ndarray:
    """A hash of 64-bit numbers in ``bits`` bits."""
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)


def block_features(raw: bytes, passage: int = PASSAGE) -> np.ndarray:
    """One row of ``FEATURES`` numbers per passage of a block of text."""
    text = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], ~_GAP[text], [False]))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(~inside[1:] & inside[:-1])
    if not len(starts):
        return np.zeros((1, FEATURES), np.float32)
    word_passage = np.arange(len(starts)) // passage
    n = int(word_passage[-1]) + 1
    # every byte belongs to the passage of the word that began last
    first = starts[::passage].copy()
    first[0] = 0
    byte_passage = np.repeat(np.arange(n), np.diff(np.append(first, len(text))))
    kind = _CLASS[text]
    sizes = np.bincount(byte_passage, minlength=n)[:, None]
    counts = np.bincount(word_passage, minlength=n)[:, None]
    out = np.empty((n, FEATURES), np.float32)
    out[:, :CLASSES] = np.bincount(byte_passage * CLASSES + kind, minlength=n * CLASSES).reshape(n, -1) / sizes
    pair = (kind[:-1] * 31 + kind[1:] * 7) % PAIRS
    out[:, CLASSES:CLASSES + PAIRS] = np.bincount(byte_passage[1:] * PAIRS + pair,
                                                  minlength=n * PAIRS).reshape(n, -1) / sizes
    # a word is its length and the sums of its letters' numbers, plain and by place
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_FIELD[text])))
    place = np.arange(len(text), dtype=np.uint64)
    placed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_FIELD[text] * place)))
    plain = sums[ends] - sums[starts]
    words = plain + (placed[ends] - placed[starts] - plain * starts.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    at = CLASSES + PAIRS
    out[:, at:at + WORDS] = np.bincount(word_passage * WORDS + _mixed(words, 5),
                                        minlength=n * WORDS).reshape(n, -1) / counts
    lengths = ends - starts
    per = lambda x: np.bincount(word_passage, x, n)[:, None] / counts
    again = np.concatenate(([False], words[1:] == words[:-1]))
    kinds = np.unique(word_passage << 31 | _mixed(words, 31)) >> 31  # the passages of their distinct words
    upper = (kind[starts] == 1) & (kind[ends - 1] != 0)
    shapes = [per(lengths) / 10, np.sqrt(per(lengths * lengths)) / 10, per(again),
              np.bincount(kinds, minlength=n)[:, None] / counts, per(~_ALNUM[text[ends - 1]]),
              per(~_ALNUM[text[starts]]), per(upper), np.log1p(counts) / 4]
    out[:, at + WORDS:] = np.concatenate(shapes, axis=1)
    return out


def passages(raw: bytes) -> Iterator[np.ndarray]:
    """The features of a whole text, block by block."""
    if not raw:
        yield np.zeros((1, FEATURES), np.float32)
    for block in text_blocks(raw, TEXT_BLOCK):
        yield block_features(block)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights by name; ``mean`` and ``scale`` put features on one scale."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    @classmethod
    def fresh(cls, bags: list[np.ndarray], seed: int = SEED) -> "Model":
        draw = np.random.default_rng(seed)
        some = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[0]), shape)
        n = sum(map(len, bags))
        mean = sum(x.sum(axis=0, dtype=np.float64) for x in bags) / n
        spread = np.sqrt(sum(((x - mean) ** 2).sum(axis=0) for x in bags) / n)
        return cls({"mean": mean.astype(np.float32), "scale": (1 / (spread + 1e-3)).astype(np.float32),
                    "E": some(len(mean), HIDDEN), "e": np.zeros(HIDDEN), "V": some(HIDDEN, GATE), "U": some(HIDDEN, GATE),
                    "w": some(GATE, 1), "c": some(HIDDEN, 1), "c0": np.zeros(1)})

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """(scaled input, encoding, tanh gate, sigmoid gate, attention logit)."""
        p = self.weights
        x = np.clip((x - p["mean"]) * p["scale"], -5, 5)
        h = np.tanh(x @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        return x, h, v, u, (v * u) @ p["w"]

    def score(self, raw: bytes) -> float:
        """The score of a whole text."""
        if self.constant is not None:
            return self.constant
        logits, values = [], []
        for x in passages(raw):
            _, h, _, _, a = self.encode(x)
            logits.append(a[:, 0])
            values.append((h @ self.weights["c"])[:, 0])
        a = np.concatenate(logits)
        a = np.exp(a - a.max())
        return float(_sigmoid((a * np.concatenate(values)).sum() / a.sum() + self.weights["c0"])[0])


def slopes(model: Model, bags: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the documents' mean log loss, by name of the weights."""
    p = model.weights
    sizes = np.array([len(x) for x in bags])
    begins, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(bags)), sizes)
    rows = np.concatenate(bags)
    starts = range(0, len(rows), STEP_ROWS)
    kept = [model.encode(rows)] if len(starts) == 1 else []
    blocks = lambda: kept or (model.encode(rows[at:at + STEP_ROWS]) for at in starts)
    passes = [(a[:, 0], (h @ p["c"])[:, 0]) for _, h, _, _, a in blocks()]
    logit, value = (np.concatenate(column) for column in zip(*passes))
    weight = np.exp(logit - np.maximum.reduceat(logit, begins)[bag])
    weight /= np.add.reduceat(weight, begins)[bag]
    bag_value = np.add.reduceat(weight * value, begins)
    off = (_sigmoid(bag_value + p["c0"]) - labels) / len(bags)
    out = {k: np.zeros_like(p[k]) for k in ("E", "e", "V", "U", "w", "c")} | {"c0": np.array([off.sum()])}
    # back through the weighted mean, the attention and the encoding
    d_value = off[bag] * weight
    d_logit = d_value * (value - bag_value[bag])
    for at, (x, h, v, u, _) in zip(starts, blocks()):
        d_a, d_c = (d[at:at + STEP_ROWS, None] for d in (d_logit, d_value))
        d_gate = d_a @ p["w"].T
        d_v, d_u = d_gate * u * (1 - v * v), d_gate * v * u * (1 - u)
        d_h = (d_c @ p["c"].T + d_v @ p["V"].T + d_u @ p["U"].T) * (1 - h * h)
        for k, slope in {"E": x.T @ d_h, "e": d_h.sum(axis=0), "V": h.T @ d_v, "U": h.T @ d_u,
                         "w": (v * u).T @ d_a, "c": h.T @ d_c}.items():
            out[k] += slope
    return out


def train(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Gradient descent (Adam) on the documents' log loss; the same bags in the
    same order give the same model."""
    if len(set(labels.tolist())) < 2:
        return Model({}, float(labels.mean()) if len(labels) else 0.5)
    model = Model.fresh(bags)
    p, names = model.weights, ["E", "e", "V", "U", "w", "c", "c0"]
    first, second = ({k: np.zeros_like(p[k]) for k in names} for _ in range(2))
    draw, step = np.random.default_rng(SEED), 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            picked = order[at:at + BATCH]
            found = slopes(model, [bags[i] for i in picked], labels[picked])
            step += 1
            for k in names:
                slope = found[k] + DECAY * p[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                p[k] = p[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def training_bags(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", docs_at_most: int = TRAIN_DOCS) -> tuple[list[np.ndarray], np.ndarray]:
    """The training sample on the driver, in order of its ids' hashes: the passages of at most
    ``docs_at_most`` whole texts, about as large as these texts."""
    named = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label")))
    picked = cut(named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(docs_at_most), "training-ids")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("raw"))
    rows = rows.join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in batch.column("raw"):
                found.append(np.concatenate(list(passages(raw.as_py()))).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary()),
                                              batch.column("label")], ["doc_id", "bag", "label"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    bags = (rows.mapInArrow(run, f"doc_id {id_type}, bag binary, label int")
            .groupBy("doc_id").agg(F.min("bag").alias("bag"), F.max("label").alias("label")))
    sample = bags.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return ([np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES) for r in sample],
            np.array([r.label for r in sample], np.float64))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("raw"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(raw.as_py()) for raw in batch.column("raw")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {id_type}, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns kept."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [model.score((t.as_py() or "").encode()) >= threshold for t in batch.column(at)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
