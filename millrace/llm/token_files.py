"""Token-ID files: ORC with run-length integers, row indexes, Bloom filters.

Documents are range-partitioned and sorted by id, encoded in a streaming pass
and written as ORC: one row per document with its ids as an integer list,
which ORC stores in run-length encoding. Stripes carry row indexes and a
Bloom filter on the id, so a reader skips stripes by id range or by membership
and stripes are read in parallel. Each row also has its part number and the
ids before it in that part; the few part totals turn those into global
offsets without a global window.

Encoding uses the tokenizers library. Its whole-text path spends most of its
time on normalisation, so texts of plain Latin letters are cut into the
tokenizer's own pre-tokens first and the library's model encodes each distinct
pre-token once per worker (bounded memo). Any other text goes through the
whole tokenizer.

Edge cases: null and empty texts have the end id only; rows with a null id
come first, ties of an id are ordered by text, and repeated rows are
documents of their own; an empty table writes files without rows; other
columns are not read.
"""

from __future__ import annotations

import array
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import Memo, spread, worker_keeps

MEMO_ENTRIES = 400_000
ROWS_AT_ONCE = 1024

# The pre-token pattern of word-end BPE vocabularies, and the
# texts on which it is applied here (printable ASCII, tab, line ends and
# the letters of Latin-1), where NFC changes nothing
PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if it prints, else the next free character from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in prints else next(spare)) for b in range(256)}


class WordEncoder:
    """Ids of texts under a ``tokenizers`` file, as little-endian 32-bit bytes."""

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        normal = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        # the short way holds only for the pre-tokens that PRETOKEN states
        self.short = (normal == ["NFC", "Replace", "Lowercase"] and len(steps) == 2
                      and steps[0].get("pattern") == {"Regex": SPLIT} and steps[1].get("type") == "ByteLevel")
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.letters, self.model = byte_letters(), self.tokenizer.model
        self.memo = Memo(self._chunk, memo_entries)
        # a word stands in several chunks: with capitals, with marks behind it
        self.pieces = Memo(self._piece, memo_entries // 2)

    def _whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
        return array.array("I", [t.id for t in tokens]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """A stretch without blanks; the tokenizer never joins over blanks."""
        if self.short and PLAIN.fullmatch(chunk):
            return b"".join([*map(self.pieces.__getitem__, PRETOKEN.findall(chunk.lower()))])
        return self._whole(chunk)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return self._whole(text)
        return b"".join(map(self.memo.__getitem__, text.replace("\n", " ").split(" ")))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has; each different
        chunk of the column is looked up once."""
        if any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.specials):
            found = [self.encode(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        chunks = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = chunks.flatten().dictionary_encode()
        data = [*map(self.memo.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist())]
        sizes, index = np.fromiter(map(len, data), np.int64, len(data)) // 4, coded.indices.to_numpy()
        ids = np.frombuffer(b"".join(data), "<u4")[spread((np.cumsum(sizes) - sizes)[index], sizes[index])]
        ends = np.concatenate(([0], np.cumsum(sizes[index])))
        edges = np.concatenate(([0], np.cumsum(pc.list_value_length(chunks).to_numpy())))
        return ids, np.diff(ends[edges])


def encode_sorted(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", parts: int | None = None) -> DataFrame:
    """(part, doc_id, part_start, n_ids, ids) in ascending order of doc_id."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    by = [F.asc_nulls_first("doc_id"), F.col("text")]
    dealt = rows.repartitionByRange(parts, by[0]) if parts else rows.repartitionByRange(by[0])
    dealt = dealt.sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = worker_keeps(("words", tokenizer_path), lambda: WordEncoder(tokenizer_path)), 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                found, sizes = encoder.encode_column(batch.column("text"))
                edges = np.concatenate(([0], np.cumsum(sizes + 1)))
                flat, inside = np.full(edges[-1], end_id, np.int32), np.ones(edges[-1], bool)
                inside[edges[1:] - 1] = False
                flat[inside] = found
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part"), batch.column("doc_id"), pa.array(start + edges[:-1]),
                     pa.array(np.diff(edges).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat))],
                    ["part", "doc_id", "part_start", "n_ids", "ids"])
                start += int(edges[-1])

    return dealt.mapInArrow(run, f"part int, doc_id {id_type}, part_start long, n_ids int, ids array<int>")


def write_token_files(encoded: DataFrame, path: str, stripe_bytes: int = 64 << 20, index_stride: int = 10_000) -> None:
    """ORC with row indexes and a Bloom filter on doc_id."""
    (encoded.write.option("orc.create.index", "true").option("orc.row.index.stride", str(index_stride))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.stripe.size", str(stripe_bytes)).option("compression", "zstd").orc(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files; filters on doc_id are pushed to stripe metadata."""
    return spark.read.orc(path)


def document_table(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), all from the rows of the files."""
    # one row per part file: bounded by the number of parts, summed on its own
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (files.groupBy("part").agg(F.sum(F.col("n_ids").cast("long")).alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_offset")))
    id_type = files.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
            crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("doc_id"), batch.column("part_start"),
                 pa.array(np.diff(edges).astype(np.int64)), pa.array(crcs, pa.int64())],
                ["part", "doc_id", "part_start", "n_tokens", "ids_crc32"])

    rows = files.select("part", "doc_id", "part_start", "ids").mapInArrow(
        run, f"part int, doc_id {id_type}, part_start long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("part_start") + F.col("part_offset")).alias("start"), "n_tokens", "ids_crc32")
