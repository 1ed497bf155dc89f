"""Token files against whole-text encoding by the library."""

import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import token_files as tf
from millrace.session import shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "Hello, World! it's DON'T we'll", "ÀÉÎ ß ÿ Straße × ÷", "tab\tand\r\nlines\n\n", "é combining",
         "漢字かな \U0001F642\U0001F642", "İstanbul ΣΑΣ ſ K", "a b  c", "x" * 3000,
         "<|endoftext|> inside <|startoftext|>", "'s 't 're 've 'm 'll 'd 12345", "***$$$ &&&%%% | | ª º ² ½",
         "word " * 5000, "nul\x00byte \x1c\x85 sep"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def _whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(tokenizer):
    encoder = tf.WordEncoder(PATH, memo_entries=8)
    assert encoder.short
    for text in TEXTS * 2:
        ids = list(struct.unpack(f"<{len(encoder.encode(text)) // 4}I", encoder.encode(text)))
        assert ids == _whole(tokenizer, text), text[:40]


def test_encoder_equals_the_library_on_documents(spark, tokenizer):
    encoder = tf.WordEncoder(PATH)
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = [x for (x,) in struct.iter_unpack("<I", encoder.encode(row.text))]
        assert ids == _whole(tokenizer, row.text), row.doc_id


def test_files_round_trip(spark, tokenizer):
    rows = [(i * 7 % 31, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (5, None), (40, "twice"), (40, "twice")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, ids string")
    path = shared_path(spark, "test-token-files")
    tf.write_token_files(tf.encode_sorted(docs.repartition(4), PATH, 1, parts=3), path)
    files = tf.read_token_files(spark, path)
    got = sorted((tuple(r) for r in tf.document_table(files).collect()), key=lambda r: (r[1], r[2]))
    start, expected = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = _whole(tokenizer, t) + [1]
        expected.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected


def test_filters_reach_the_stripes(spark):
    path = shared_path(spark, "test-token-files")
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    tf.write_token_files(tf.encode_sorted(docs, PATH, 1, parts=4), path)
    found = tf.read_token_files(spark, path).where("doc_id = 1234")
    assert "EqualTo(doc_id,1234)" in found._jdf.queryExecution().toString()
    assert [r.doc_id for r in found.collect()] == [1234]
    raw = b"".join(r.content for r in spark.read.format("binaryFile").load(path).collect())
    assert raw.count(b"ORC") >= 4


def test_empty_table(spark):
    path = shared_path(spark, "test-token-files")
    none = spark.createDataFrame([], "doc_id long, text string")
    tf.write_token_files(tf.encode_sorted(none, PATH, 1), path)
    files = spark.read.schema("part int, doc_id long, part_start long, n_ids int, ids array<int>").orc(path)
    assert tf.document_table(files).count() == 0
