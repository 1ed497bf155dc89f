"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib

import pytest

from conftest import SF001
from millrace.llm import periodic_runs as pr
from millrace.llm.queries_repeats import op13_periodic_runs, planted


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            smallest = not any(all(words[start + k] == words[start + k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and smallest:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_runs_equal_plain_search(letters):
    draw = random.Random(letters)
    for _ in range(400):
        words = []
        while len(words) < draw.choice([5, 20, 70]):
            part = [draw.randrange(letters) for _ in range(draw.randrange(1, 7))]
            words += (part * draw.randrange(1, 9))[:draw.randrange(1, 40)]
        assert pr.find_runs(words) == plain_runs(words)


def test_squares_are_those_of_primitive_roots():
    words = [0, 0, 0, 1, 0, 0, 0, 1, 2, 1, 2]
    found = set(pr.squares(words))
    for end in range(len(words)):
        for d in range(1, (end + 1) // 2 + 1):
            root = words[end - d + 1:end + 1]
            square = root == words[end - 2 * d + 1:end - d + 1]
            primitive = not any(d % p == 0 and root == root[:p] * (d // p) for p in range(1, d))
            nearest = not any(words[end - d + 1 - e:end + 1 - e] == root for e in range(1, d) if end - d + 1 - e >= 0)
            assert ((end, d) in found) == (square and primitive and nearest)


def _row(doc, words):
    runs = plain_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def test_query_equals_plain_search(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    want = sorted(_row(r.doc_id, planted((r.text or "").encode().split(), r.doc_id)) for r in docs
                  if len((r.text or "").split()) < 700)
    ids = {w[0] for w in want}
    got = sorted(tuple(r) for r in op13_periodic_runs(spark, SF001).collect())
    assert len(got) == len(docs) and [r for r in got if r[0] in ids] == want
    assert any(r[1] for r in want) and len(want) > len(docs) / 2


def test_planted_words():
    words = [b"%d" % i for i in range(50)]
    doc = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    g = zlib.crc32(str(doc).encode()) // 10
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert planted(words, doc) == [words[i] if i < a else words[a + (i - a) % p] for i in range(50)]
    assert planted([], doc) == []


def test_edges(spark):
    texts = [(1, None), (2, ""), (3, " \t\n "), (None, "a a a a a a"), (5, "a a a a a a"), (5, "a a a a a a"),
             (6, "a a a a a"), (7, "x " * 30_000), (8, "y" * 200_000), (9, "é é\x0bé é é é é é")]
    docs = spark.createDataFrame([(i, t, "r", "c") for i, t in texts], "doc_id long, text string, runs string, raw string")
    got = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in pr.collapse_runs(docs).collect()}
    assert got[(1, "")] == got[(2, "")] == got[(3, "")] == [] and got[(None, "a")] == got[(5, "a")] == [(0, 6, 1)]
    assert got[(6, "a a a a a")] == [] and got[(7, "x")] == [(0, 30_000, 1)] and got[(8, "y" * 200_000)] == []
    assert got[(9, "é é é é é é é é")] == []  # only blanks and \x09-\x0D part words
    assert pr.collapse_runs(docs).count() == len(texts) and pr.collapse_runs(docs.limit(0)).count() == 0
