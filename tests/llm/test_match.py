"""Equal, similar and leaked texts against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from millrace.llm import common
from millrace.llm import decontaminate as dc
from millrace.llm import exact_dedup as ed
from millrace.llm import minhash as mh
from millrace.llm.common import Memo, text_blocks
from millrace.llm.components import components

SCHEMA = "doc_id long, text string, keep_id long, digest string, n_words string, raw string"


def _docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 0, "x", "y", "z") for i, t in rows], SCHEMA).repartition(parts)


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# exact dedup

@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal_and_checked(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 256, (n, 32), np.uint8)
    if n > 10:  # keys that share the hashed bytes can only be told apart by the rest
        keys[3:6, -8:] = keys[2, -8:]
    perfect = ed.PerfectHash(keys)
    assert sorted(perfect.slots(keys).tolist()) == list(range(n))
    strangers = perfect.slots(rng.integers(0, 256, (50, 32), np.uint8))
    assert ((strangers >= -1) & (strangers < max(n, 1))).all()


def _expected_marks(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[_lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(_lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


DUPLICATES = [(1, "Same Text"), (2, "same text"), (3, "SAME TEXT"), (4, "É"), (5, "é"), (6, None), (7, ""), (8, "alone"),
              (None, "alone"), (None, "nobody"), (None, "nobody"), (9, "twice"), (9, "twice"), (10, "İ"), (11, "i̇"),
              (12, "k"), (13, "K"), (14, "L" * 500_000), (15, "l" * 500_000)] + [(100 + i, "Hot") for i in range(300)]


@pytest.mark.parametrize("shard_keys", [2, 50_000])
def test_exact_dedup(spark, shard_keys):
    for split in (0, 1, len(DUPLICATES) // 2, len(DUPLICATES)):
        marks = ed.mark_duplicates(_docs(spark, DUPLICATES[split:]), _docs(spark, DUPLICATES[:split]),
                                   shard_keys=shard_keys)
        assert sorted(map(tuple, marks.collect()), key=repr) == _expected_marks(DUPLICATES), split
    assert sorted(map(tuple, ed.mark_duplicates(_docs(spark, DUPLICATES)).collect()), key=repr) \
        == _expected_marks(DUPLICATES)


def test_drop_rows_keeps_columns(spark):
    docs = _docs(spark, DUPLICATES)
    kept = ed.drop_rows(docs, ed.mark_duplicates(*ed.earlier_batch(docs)))
    assert kept.columns == docs.columns
    ids = {(r.doc_id, r.text) for r in kept.collect()}
    assert (3, "SAME TEXT") in ids and (1, "Same Text") not in ids and (399, "Hot") in ids and (398, "Hot") not in ids


def test_drop_rows_with_clashing_and_null_ids(spark):
    docs = _docs(spark, [(7, "A"), (7, "B"), (9, "a"), (None, "C"), (None, "c"), (5, "C"), (None, "D"), (None, None)])
    kept = ed.drop_rows(docs, ed.mark_duplicates(docs))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == \
        sorted([(7, "B"), (9, "a"), (5, "C"), (None, "D"), (None, None)], key=repr)
    text = "one two three four five six seven eight"
    docs = _docs(spark, [(3, text), (7, text), (7, "a text of its own that nobody else has"), (None, text)])
    kept = ed.drop_rows(docs, mh.near_duplicates(docs, digests=True))
    assert {(r.doc_id, r.text[:3]) for r in kept.collect()} == {(3, "one"), (7, "a t"), (None, "one")}


def test_drop_rows_leaves_clashing_columns_alone(spark):
    docs = spark.createDataFrame([(1, "same", "mine", "r", 1.5), (2, "SAME", "yours", "s", 2.5), (3, "other", None, "t", 3.5)],
                                 "doc_id long, text string, _text_sha256 string, row string, gone_id double")
    kept = ed.drop_rows(docs, ed.mark_duplicates(docs))
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(2, "SAME", "yours", "s", 2.5), (3, "other", None, "t", 3.5)]


def test_drop_rows_is_exact_behind_a_full_filter(spark, monkeypatch):
    monkeypatch.setattr(ed, "key_filter", lambda keys: common.key_filter(keys, 1024))
    docs = _docs(spark, [(i, f"text {i // 2}") for i in range(2000)])
    kept = ed.drop_rows(docs, ed.mark_duplicates(docs))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(1, 2000, 2))


# near duplicates

def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _expected_components(rows):
    sets = [(i, _shingles(t)) for i, t in rows]
    top = {i: i for i, _ in rows if i is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                top[hi] = lo
    return sorted([(i, len(x), find(i) if i is not None else None, i is None or find(i) == i) for i, x in sets], key=repr)


def _near_rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    base = [word() for _ in range(150)]
    rows = [(1, " ".join(base))]
    for i in range(2, 60):  # copies around the threshold, each with changed words
        w = list(base)
        for at in rng.sample(range(150), rng.randint(0, 6)):
            w[at] = word()
        rows.append((i, " ".join(w)))
    passage = " ".join(base[:60])  # a passage that many otherwise different texts share
    rows += [(100 + i, passage + " " + " ".join(word() for _ in range(60))) for i in range(40)]
    # a chain: each link holds, the ends have little in common
    rows += [(200 + i, " ".join(f"w{j}" for j in range(5 * i, 5 * i + 60))) for i in range(12)]
    # a pair exactly at three quarters: 7 of 7 + 1 + 1.. shingles, and one just under it
    rows += [(300, " ".join(f"t{j}" for j in range(11))), (301, " ".join(f"t{j}" for j in range(9)) + " u v"),
             (302, "a b c d e f g h i j"), (303, "a b c d e f g h i z z z")]
    return rows + [(400, None), (401, ""), (402, " \t\n"), (403, "One Two"), (404, "one two"), (405, "one two three"),
                   (None, "one two"), (406, "Same"), (406, "same"), (407, "same"), (408, "x" * 3_000_000),
                   (409, "y" * 10), (410, "x" * 3_000_000 + " ")]


def test_near_duplicates_equal_brute_force(spark):
    rows = _near_rows()
    found = sorted(map(tuple, mh.near_duplicates(_docs(spark, rows)).collect()), key=repr)
    assert found == _expected_components(rows)


def test_prefix_pairs_hold_every_link_and_spare_templates(spark):
    rng = random.Random(11)
    sets = {}
    for i in range(60):  # sets around the threshold, of many sizes, and of shared frequent shingles
        base = rng.sample(range(3 * (i // 12), 3 * (i // 12) + 60), rng.randint(4, 50))
        sets[i] = sorted(set(base) | {1000 + i % 12})
    # a template of 80 shingles, each time with own ones: alike when they are few
    template = list(range(5000, 5080))
    for i in range(100, 160):
        own = 16 if i < 140 else i - 138
        sets[i] = template + [10_000 * i + j for j in range(own)]
    rows = spark.createDataFrame(list(sets.items()), "doc_id long, shingles array<long>")
    apart = spark.createDataFrame([(i, i, len(s)) for i, s in sets.items()], "doc_id long, component long, n_shingles long")
    found = {(r.a, r.b) for r in mh._prefix_pairs(apart, rows, 75).collect()}
    linked = {(a, b) for a in sets for b in sets if a < b
              and 100 * len(set(sets[a]) & set(sets[b])) >= 75 * len(set(sets[a]) | set(sets[b]))}
    assert linked and linked <= found
    assert {p for p in found if p[0] >= 100} == {p for p in linked if p[0] >= 100}  # no template pair beyond the links


def test_near_duplicates_of_nothing(spark):
    assert mh.near_duplicates(_docs(spark, [])).count() == 0


def test_words_hash_alike_in_blocks(monkeypatch):
    text = ("Some Words é and a-very-long-word-without-blanks\t\n " * 40).encode()
    whole = mh.Sketcher().word_hashes(text)
    assert len(whole) == len(text.split()) and len(set(whole.tolist())) == len(set(text.lower().split()))
    monkeypatch.setattr(mh, "TEXT_BLOCK", 16)
    assert (mh.Sketcher().word_hashes(text) == whole).all()
    assert b"".join(text_blocks(text, 10)) == text


def test_estimates_are_near_the_truth():
    s, rng = mh.Sketcher(), np.random.default_rng(1)
    pool = rng.integers(0, 2 ** 64, 4000, np.uint64)
    for share in (0.2, 0.5, 0.75, 0.9):
        n = int(4000 * share)
        a, b = pool[:n + (4000 - n) // 2], np.concatenate((pool[:n], pool[n + (4000 - n) // 2:]))
        x, y = (np.frombuffer(mh.signature(s.minima(v)), np.uint8)[None] for v in (a, b))
        assert abs(mh.estimate(x, y)[0] - share) < 0.12
        if share == 0.9:
            assert (s.keys(s.minima(a)) == s.keys(s.minima(b))).any()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(1, 400), rng.randint(1, 400)) for _ in range(230)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(2000, 2300)]
    top = {x: x for e in edges for x in e}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        top[hi] = lo
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: find(x) for x in top if find(x) != x}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_memo_turns_over_and_forgets_only_the_old():
    made = []
    memo = Memo(lambda k: made.append(k) or k * 2, 3)
    assert [memo[x] for x in (1, 2, 3, 4, 1, 5, 6, 7, 8, 9, 1)] == [2, 4, 6, 8, 2, 10, 12, 14, 16, 18, 2]
    assert len(memo) + len(memo.old) <= 6 and made.count(2) == 1


# decontamination

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs away again"), (2, "only four words here"), (3, None),
         (4, "!!!"), (5, "one two three four five six seven eight nine ten"), (10, "the QUICK, brown fox jumps over "
         "the lazy dog and... something else"), (5, "un deux trois quatre été")]
TEXTS = [(1, "He said: the quick brown fox jumps over the lazy dog and runs off."), (2, "The Quick-Brown fox jumps"),
         (3, None), (4, ""), (5, "x only four words here only four words here y"), (6, "only four\nWORDS; here"),
         (7, "one two three four five six seven eight nine"), (8, "ONE two three four five six seven eight nine ten!"),
         (None, "un deux trois quatre Été un deux trois quatre été"), (9, "un deux trois quatre eté"), (1, "only four words here"),
         (11, "clean " * 3000), (12, "clean " * 3000 + ITEMS[0][1] + " clean" * 3000)]


def _expected_hits(texts, items, window=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
    windows = {}
    for item, t in items:
        w = find(t)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(str(item))
    out = []
    for doc, t in texts:
        w, hit, found = find(t), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[i:i + size]))):
                    hit.update(range(i, i + size))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [40, 1 << 20])
def test_contamination(spark, block_bytes):
    items = spark.createDataFrame([(*x, 1) for x in ITEMS], "item_id long, text string, doc_id int")
    found = dc.find_contamination(_docs(spark, TEXTS), items, block_bytes=block_bytes).drop("hit_runs")
    assert sorted(map(tuple, found.collect()), key=repr) == _expected_hits(TEXTS, ITEMS)
    kept = dc.drop_contaminated(_docs(spark, TEXTS), items, block_bytes=block_bytes)
    clean = {(d, n) for d, n, *_, bad in _expected_hits(TEXTS, ITEMS) if not bad}
    assert len(clean) == kept.count() and set(r.doc_id for r in kept.collect()) == {d for d, _ in clean}
    assert kept.columns == _docs(spark, TEXTS).columns


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_contamination(_docs(spark, TEXTS), none).where("n_hit > 0 OR contaminated").count() == 0
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.find_contamination(_docs(spark, []), items).count() == 0


def test_spans_are_cut(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    runs = {r.doc_id: r.hit_runs for r in dc.find_contamination(_docs(spark, TEXTS[:10]), items).collect()}
    texts = dict(TEXTS[:10])
    assert dc.cut_spans(texts[5], runs[5], "[]") == "x [] y"
    assert dc.cut_spans(texts[6], runs[6]) == "" and dc.cut_spans(texts[7], runs[7]) == texts[7]
    assert dc.cut_spans(texts[1], runs[1], "#") == "He said: # off."


def test_copies_of_a_benchmark_item_cost_nothing(spark):
    item = ("i1", " ".join(f"w{k}" for k in range(300)))
    benchmark = spark.createDataFrame([item] * 400 + [("i2", "a b c")], "item_id string, text string")
    blocks = [b.value for b, _ in dc.ngram_blocks(benchmark, "item_id", "text", block_bytes=4000)]
    assert len(blocks) == 1 and len(dc.NgramSet.load(blocks[0]).by_size) == 2
