"""Repeated spans against a plain search over all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest

from conftest import SF001, SF01
from millrace.llm import repeated_spans as rs
from millrace.llm.queries_repeats import op11_repeated_spans


def plain(rows, length=rs.LENGTH):
    """``rows``: distinct (id, text)."""
    seen, out = {}, []
    for doc, text in sorted(rows, key=lambda r: (-(2 ** 63) if r[0] is None else r[0])):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, np.int64)
        for at in range(len(raw) - length + 1):
            if not seen.setdefault(raw[at:at + length], (doc, at)) == (doc, at):
                gone[at] += 1
                gone[min(at + length, len(raw))] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = int(gone[0]) + int((np.diff(gone.astype(int)) == 1).sum()) if len(gone) else 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _docs(spark, rows):
    schema = "doc_id long, text string, doc long, copy long, raw string, kind string"
    return spark.createDataFrame([(i, t, 0, 0, "r", "k") for i, t in rows], schema).repartition(4)


def _got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_equals_plain_search(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = _got(op11_repeated_spans(spark, sf))
    assert got == plain(rows) and sum(r[2] for r in got) > 0


def _made(seed):
    draw = random.Random(seed)
    letters = lambda n, k: "".join(draw.choice("abcdefgh é\n"[:k]) for _ in range(n))
    shared = [letters(n, 10) for n in (40, 60, 99, 100, 101, 150, 400)]
    rows = []
    for doc in range(60):
        parts = []
        for _ in range(draw.randrange(0, 6)):
            kind = draw.randrange(5)
            if kind < 2:
                parts.append(letters(draw.randrange(1, 120), 10))
            elif kind == 2:
                text = draw.choice(shared)
                a = draw.randrange(0, 20)
                parts.append(text[a:])
            elif kind == 3:
                parts.append(letters(draw.randrange(1, 4), 3) * draw.randrange(1, 120))
            else:
                parts.append(draw.choice(shared) + draw.choice("xyz") + draw.choice(shared))
        rows.append((draw.randrange(-50, 10 ** 12) if doc % 9 else doc, "".join(parts)))
    return list({r[0]: r for r in rows}.values())


@pytest.mark.parametrize("seed,flush,block", [(1, 1_000_000, 1 << 18), (2, 300, 1 << 18), (3, 40, 256)])
def test_made_texts(spark, monkeypatch, seed, flush, block):
    """Small flushes and blocks, so that one bucket is known in parts to several tasks."""
    monkeypatch.setattr(rs, "FLUSH", flush)
    monkeypatch.setattr(rs, "BLOCK", block)
    rows = _made(seed)
    assert _got(rs.span_report(_docs(spark, rows))) == plain(rows)


def test_template_in_every_document(spark, monkeypatch):
    """A string shorter than a window with other neighbours everywhere: one bucket, many names."""
    monkeypatch.setattr(rs, "FLUSH", 500)
    draw = random.Random(9)
    word = lambda n: "".join(draw.choice("abcdefghijklmnop") for _ in range(n))
    template, passage = word(70), word(130)
    rows = [(i, word(60) + template + word(60) + (passage if i % 3 == 0 else "")) for i in range(300)]
    got = _got(rs.span_report(_docs(spark, rows)))
    assert got == plain(rows) and sum(r[2] for r in got) >= 99 * 130


def test_edges(spark):
    long = "".join(random.Random(1).choices("abcdefghij", k=400_000))
    text = long[:250]
    rows = [(1, None), (2, ""), (3, "q" * 99), (4, "q" * 100), (None, text), (5, text), (6, long), (7, "z" * 300_000),
            (8, "é" * 200)]
    assert _got(rs.span_report(_docs(spark, rows))) == plain(rows)
    # rows that repeat id and text are one document; of texts that share an id one comes first
    again = _got(rs.span_report(_docs(spark, [(1, text), (1, text), (2, text), (3, long[300:500]), (3, long[300:500] + "!"), (4, "short")])))
    assert [r[2] for r in again[:3]] == [0, 0, 250] and sorted(r[2] for r in again[3:5]) == [0, 200] and again[5][2] == 0
    assert rs.span_report(_docs(spark, rows).limit(0)).count() == 0


def test_filter_only_lets_strangers_pass(spark):
    from millrace.llm.common import key_filter, may_hold

    keys = spark.range(3000).selectExpr("id * 7 AS key")
    for limit in (1 << 27, 1024):
        words = key_filter(keys, limit).value
        inside = may_hold(words, np.arange(0, 21000, 7).astype(np.uint64))
        assert inside.all() and len(words) * 64 <= limit
    assert may_hold(key_filter(keys).value, np.arange(10 ** 6, 10 ** 6 + 10 ** 5).astype(np.uint64)).mean() < 0.02
    assert not may_hold(key_filter(keys.limit(0)).value, np.arange(100).astype(np.uint64)).any()
