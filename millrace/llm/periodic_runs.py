"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a longest stretch of consecutive words with smallest period q, words q
apart being equal, of at least ``max(MIN_WORDS, MIN_EXPONENT * q)`` words.

A document's words are appended to a suffix automaton. Its suffix links form a
tree, kept as preferred paths in splay trees; every path has one colour, the
end at which its strings occurred last. Appending the word at place i is an
access of the node of the prefix: the way to the root crosses path segments,
each with a previous end e and the lengths (lo, hi] of the strings that ended
there, and is coloured i. With d = i - e and lo < d <= hi, the d words up to i
are equal to the d words before them and not to any nearer ones: a square of a
primitive root, which is extended in both directions to its run. Every run is
met at the end of its first square. All paths recolour O(n log n) segments.

Only stretches that can hold a run are appended. In a run of c + q + 2 words
c >= 3 q - 2 consecutive word triples occurred at most q words before. So the
places whose triple has no previous occurrence, or one further back than a third
of their stretch, cut the document, again and again until no cut is left; a
stretch with the words a third of its length before it holds its runs whole.
Triples are compared by hash there (equal ones never differ); all else compares
the words themselves.

A document is one task's work, in memory proportional to its length.

Edge cases: null and empty texts have no words, no runs and an empty collapsed
text; a null id is kept; rows are independent, so repeated rows each give their
row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_bytes

MIN_WORDS, MIN_EXPONENT = 6, 4
GRAM = 3
ROWS_AT_ONCE = 256


class SuffixAutomaton:
    """States over a sequence of numbers; state 0 is the root."""

    def __init__(self, words: list[int]):
        self.length, self.link, self.edges = [0], [-1], [{}]
        self.prefix: list[int] = []  # the state of every prefix
        for word in words:
            self.prefix.append(self._append(self.prefix[-1] if self.prefix else 0, word))

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.length.append(length)
        self.edges.append(edges)
        self.link.append(link)
        return len(self.length) - 1

    def _append(self, last: int, word: int) -> int:
        length, link, edges = self.length, self.link, self.edges
        new, p = self._state(length[last] + 1, {}, 0), last
        while p >= 0 and word not in edges[p]:
            edges[p][word] = new
            p = link[p]
        if p < 0:
            return new
        q = edges[p][word]
        if length[q] > length[p] + 1:
            clone = self._state(length[p] + 1, dict(edges[q]), link[q])
            link[q] = clone
            while p >= 0 and edges[p].get(word) == q:
                edges[p][word] = clone
                p = link[p]
            q = clone
        link[new] = q
        return new


class PathColours:
    """A rooted forest's preferred paths as splay trees, ordered by depth; the root of
    a splay tree holds its path's colour and its path's parent."""

    def __init__(self, parents: list[int]):
        n = len(parents)
        self.up = list(parents)  # parent in the splay tree, or the path's parent
        self.left, self.right = [-1] * n, [-1] * n
        self.colour = [-1] * n

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g < 0 or (left[g] != p and right[g] != p):
                self.colour[x] = self.colour[p]
            else:
                h = up[g]
                if h < 0 or (left[h] != g and right[h] != g):
                    self.colour[x] = self.colour[g]
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Colour the way from ``node`` to the root. What it was before: (deepest node,
        old colour) per segment, from below."""
        found, below, x = [], -1, node
        while x >= 0:
            self._splay(x)
            found.append((x, self.colour[x]))
            if self.right[x] >= 0:  # the deeper rest becomes a path of its own
                self.colour[self.right[x]] = self.colour[x]
            self.right[x] = below
            below, x = x, self.up[x]
        self._splay(node)
        self.colour[node] = colour
        return found


def squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(end, d): the d words up to the place ``end`` (included) are equal to the d words
    before them, and d is the smallest such number for them."""
    automaton = SuffixAutomaton(words)
    paths, length = PathColours(automaton.link), automaton.length
    for i, state in enumerate(automaton.prefix):
        segments = paths.access(state, i)
        for k, (node, end) in enumerate(segments):
            if end >= 0 and (d := i - end) <= length[node]:
                if (length[segments[k + 1][0]] if k + 1 < len(segments) else 0) < d:
                    yield i, d


def _word_numbers(words: list) -> np.ndarray:
    """Equal words have equal numbers."""
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def stretches(numbers: np.ndarray) -> list[tuple[int, int]]:
    """The word ranges that can hold runs."""
    n = len(numbers) - GRAM + 1
    if n < GRAM:
        return []
    keys = np.zeros(n, np.uint64)
    for j in range(GRAM):
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + numbers[j:j + n].astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    back = np.full(n, n + 1, np.int64)
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    back[order[same + 1]] = order[same + 1] - order[same]
    out, todo = [], [(0, n)]
    while todo:
        a, b = todo.pop()
        third = (b - a + 2) // 3
        cuts = a + np.flatnonzero(back[a:b] > third)
        if not len(cuts):
            out.append((max(0, a - third), b + GRAM - 1))
            continue
        edges = np.concatenate(([a - 1], cuts, [b]))
        wide = np.flatnonzero(np.diff(edges) > GRAM)  # at least GRAM places between two cuts
        todo += [(int(edges[k]) + 1, int(edges[k + 1])) for k in wide]
    return out


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    numbers = _word_numbers(words)
    found: set[tuple[int, int, int]] = set()
    whole = None
    for a, b in stretches(numbers):
        whole = numbers.tolist() if whole is None else whole
        reached: dict[int, int] = {}
        for i, d in squares(whole[a:b]):
            end = a + i + 1
            if end <= reached.get(d, 0):  # inside a run of this period that is known
                continue
            start = end - 2 * d
            while start > 0 and whole[start - 1] == whole[start - 1 + d]:
                start -= 1
            while end < len(whole) and whole[end] == whole[end - d]:
                end += 1
            reached[d] = end
            if end - start >= max(MIN_WORDS, MIN_EXPONENT * d):
                found.add((start, end - start, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words no run has after its first period."""
    keep = np.ones(n, bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return keep


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length/period; of equal ones the first, then the
    one with the smallest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rewrite: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, best, collapsed): the runs of each text's words, the strongest one
    (null without runs) and the text with every run cut to its first period, words joined by one
    blank. ``rewrite`` may replace the words of a document first."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw"))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def struct(run):
        return None if run is None else dict(zip(("start", "length", "period"), run))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                runs, best, texts = [], [], []
                for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw")):
                    words = raw.as_py().split()  # of bytes: at blanks and \x09-\x0D
                    words = rewrite(words, doc) if rewrite else words
                    found = find_runs(words)
                    if found:
                        keep = kept_words(len(words), found)
                        words = [w for w, stays in zip(words, keep.tolist()) if stays]
                    runs.append([struct(r) for r in found])
                    best.append(struct(strongest(found)))
                    texts.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(runs, pa.list_(run_type)), pa.array(best, run_type),
                     pa.array(texts, pa.string())], ["doc_id", "runs", "best", "collapsed"])

    one = "struct<start:long,length:long,period:long>"
    return rows.mapInArrow(run, f"doc_id long, runs array<{one}>, best {one}, collapsed string")
