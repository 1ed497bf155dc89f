"""Counting quotient filters and collocations against plain counting."""

from collections import Counter

import numpy as np
import pytest

from millrace.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, ids long, n string, rank string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, x, 1, "n", "r") for i, (t, x) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.mark.parametrize("places", [2, 3, 5])
def test_permutation_is_invertible(places):
    x = np.random.default_rng(places).integers(0, 2 ** 64, (places, 1000), np.uint64)
    x[:, :100] = np.arange(100)
    assert (co.unpermute(co.permute(x)) == x).all()
    assert len(np.unique(co.permute(x)[0] >> np.uint64(40))) > 900  # small ids spread over all quotients


@pytest.mark.parametrize("n,bits", [(0, 0), (1, 4), (5000, 0), (5000, 6)])
def test_filters_keep_every_count(n, bits):
    draw = np.random.default_rng(n)
    x = co.permute(draw.integers(0, 40, (2, n)).astype(np.uint64))
    x[0, :n // 50] = x[0, :1]  # numbers that share their first word
    x = np.concatenate([x] + [x[:, :1]] * 300 if n else [x], axis=1)
    whole = co.CountingFilter.build(x)
    want = Counter(map(tuple, x.T.tolist()))
    assert dict(zip(map(tuple, whole.columns.T.tolist()), whole.counts.tolist())) == want
    parts = [(k, p.to_bytes(bits)) for k, p in whole.ranges(bits)]
    back = [co.CountingFilter.from_bytes(k, b) for k, b in parts]
    if n:
        merged = co.CountingFilter.merge(back + back[:1])
        assert (merged.columns == whole.columns).all()
        assert merged.counts.sum() == whole.counts.sum() + back[0].counts.sum()
    else:
        assert not parts


def test_words_and_pieces():
    for attempt in (0, 1):
        reader = co.Words(attempt)
        ids, pieces, raw, starts, ends = reader.read("en", [b"A b, a\tc.\nB", b"", "É b".encode(), b"x" * (3 << 20)])
        assert [raw[a:b] for a, b in zip(starts[:-1], ends[:-1])] == [b"a", b"b", b"a", b"c", b"b", "É".encode(), b"b"]
        assert ids[0] == ids[2] and ids[1] == ids[4] == ids[6] and len(set(ids.tolist())) == 5
        assert pieces[0] == pieces[1] != pieces[2] == pieces[3] != pieces[4] != pieces[5] == pieces[6]
        assert (reader.read("de", [b"a"])[0] != ids[0]).all()


def _plain(rows, max_words, least, percent=100):
    import re

    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cands = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    inside = {}
    for (lang, w), a in cands.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    inside[lang, w[i:j]] = max(inside.get((lang, w[i:j]), 0), a)
    out = []
    for (lang, w), a in cands.items():
        if (lang, w) in inside and 100 * inside[lang, w] >= percent * a:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    ranks, rows = Counter(), []
    for lang, s, a, phrase, l, r, total in sorted(out):
        ranks[lang] += 1
        rows.append((lang, ranks[lang], phrase.decode(), -a, l, r, total, -s))
    return rows


def test_collocations_equal_plain_counting(spark, monkeypatch):
    draw = np.random.default_rng(5)
    words = ["a", "b", "É", "c", "d", "e", "f"]
    rows = [(" ".join(words[int(k)] + [",", "", "", "", "\n"][int(j)] for k, j in zip(draw.integers(0, 7, 60) ** 2 // 7, draw.integers(0, 5, 60))),
             [None, "und", "x"][i % 3]) for i in range(40)]
    rows += [("New York city hall", "x")] * 30 + [(None, None), ("", "x"), (" \t. ,", "y"), ("a a a a a a a a a", "z")]
    for least, bits in ((5, 1 << 27), (3, 64)):  # a full Bloom filter only adds entries
        monkeypatch.setattr(co, "BLOOM_BITS", max(bits, 1024))
        monkeypatch.setattr(co, "FLUSH_WORDS", 500)
        got = sorted(tuple(r) for r in co.collocations(_docs(spark, rows), min_count=least).collect())
        assert got == sorted(_plain(rows, 5, least)) and got


def test_top_and_percent(spark):
    rows = [("p q r", "x")] * 9 + [("p q", "x")] * 3 + [("s t", "x")] * 4
    phrases = lambda **k: [r.phrase for r in co.collocations(_docs(spark, rows), min_count=2, **k).orderBy("rank").collect()]
    assert phrases() == ["s t", "p q", "p q r"] and "p q" not in phrases(percent=70) and phrases(top=1) == ["s t"]


def test_empty_tables(spark):
    assert co.collocations(_docs(spark, [("a", "x")]).limit(0)).count() == 0
    assert co.collocations(_docs(spark, [(None, None), ("a b", "x")])).count() == 0


def test_clashing_ids_take_the_next_hash(spark, monkeypatch):
    real = co.Words.read
    monkeypatch.setattr(co.Words, "read", lambda self, lang, texts: (
        real(self, lang, texts) if self.attempt else (real(self, lang, texts)[0] * np.uint64(0), *real(self, lang, texts)[1:])))
    words, attempt = co.word_ids(co._texts(_docs(spark, [("a b a", "x"), ("b", None)]), "text", "lang"))
    assert attempt == 1
    assert sorted((r.lang, r.word, r.n) for r in words.collect()) == [("und", "b", 1), ("x", "a", 2), ("x", "b", 1)]
