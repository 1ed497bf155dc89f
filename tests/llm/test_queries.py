"""The registered queries against their oracles, and the pipeline against brute force."""

import re
import struct
import sys
import zlib

import public_tokenizers
import pytest

import __spark_entry__ as entry
from conftest import ROOT, SF001, SF01
from millrace.llm import catalog
from tools.oracle_check import _rows, duck

sys.path.insert(0, ROOT)
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    rel = duck(SF01).sql(SQL[name])
    assert {c: DUCK[t] for c, t in df.dtypes} == dict(zip(rel.columns, map(str, rel.types)))
    assert _rows(df.columns, rows, None) == _rows(list(rel.columns), rel.fetchall(), None)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_whole_tables_are_read(spark, name):
    df = QUERIES[name](spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").count()
    if name.startswith("op10"):
        assert df.agg({"n_docs": "sum"}).first()[0] == docs
    else:
        assert df.count() == docs == df.select("doc_id").distinct().count()


def test_quality_query_marks_the_held_out(spark):
    rows = QUERIES["op7_quality_mil"](spark, SF001).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline as cp
    from millrace.llm.piece_codec import PieceCodec

    assert [f.__name__ for _, f in cp.STAGES] == ["quality", "exact", "near", "clean", "tokens"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = cp.quality_model(docs, spark.read.parquet(f"{SF01}/labels.parquet"))
    left = {r.doc_id: r.text for r in docs.collect() if model.score(r.text.encode()) >= 0.3}
    # the largest id of equal texts
    last = {}
    for i in sorted(left):
        last[_lower(left[i])] = i
    left = {i: left[i] for i in last.values()}
    # the smallest id of a component
    sets, top = {}, {i: i for i in left}
    for i, t in left.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", _lower(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(left)
    for a in ids:
        for b in ids:
            if b < a and sets[a] and 4 * min(len(sets[a]), len(sets[b])) >= 3 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    lo, hi = sorted((find(a), find(b)))
                    top[hi] = lo
    left = {i: left[i] for i in ids if find(i) == i}
    # no benchmark window
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
    windows = set()
    for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set()
    sizes = {len(w) for w in windows}
    left = {i: t for i, t in left.items()
            if not any(tuple(w[k:k + n]) in windows for w in [words(t)] for n in sizes for k in range(len(w) - n + 1))}
    codec = PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    found = cp.run(spark, SF01).collect()
    assert {r.doc_id for r in found} == set(left) and len(found) == len(left) < docs.count()
    for r in found:
        assert struct.pack(f"={len(r.ids)}I", *r.ids) == codec.encode(left[r.doc_id], codec.variant(r.doc_id))
        assert r.n_tokens == len(r.ids) and codec.decode(r.ids) == left[r.doc_id]


def test_stages_keep_columns_and_stand_empty_tables(spark, tmp_path):
    import corpus_pipeline as cp
    from millrace.llm.common import cut

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (-5, None, None, None, 0), (-6, "", None, None, None)], docs.schema))
    assert cp.run(spark, str(tmp_path)).count() == 0
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, cut(empty, "empty"), str(tmp_path)).columns == docs.columns
        rows = cut(stage(spark, rows, SF001), "odd")
        assert rows.columns == docs.columns and rows.count() > 0
