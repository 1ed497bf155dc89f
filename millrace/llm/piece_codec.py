"""SentencePiece encoding with seeded merge-dropout, and decoding.

The pieces and scores of a BPE model file are read with the sentencepiece
library; encoding runs the merge agenda here, because the library draws its
dropout from a random generator that cannot be keyed. A text gets the model's
dummy blank, blanks become the blank mark, and the agenda takes candidate
merges by score, then from the left. Each candidate that comes up is skipped if
a hash of (key, piece, place) falls below the dropout rate; a skipped pair
can still merge with other neighbours. Characters without a piece become
byte pieces, and so does a blank mark that stands in the text itself, so
decoding gives back every text exactly, whatever was skipped.

The key is a hash of the seed and the document id, and a candidate's place is
counted in the document: runs with one seed are equal, and every document, and
every place of a word in it, has draws of its own. No piece of the model goes
over a blank that follows another character, nor over a character that no longer
piece has, so a text falls into stretches that are merged alone. What is
remembered does not depend on the key: the candidates that come up in a stretch
when none is skipped, the pieces they give, and the same after each skip that
occurred (a tree per stretch, bounded). The draws of all candidates of many
texts are hashed together; the first that is skipped leads to the next node.
Stretches and skips that are rarely met are merged directly with their draws.

Edge cases: null and empty texts have no ids and decode to an empty text; a
null id has a key of its own; rows are independent, so ties and repeated
rows each give their row; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import array
import hashlib
import heapq
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import sha256_hex, spread, worker_keeps

BLANK = "▁"
DROPOUT, SEED = 0.1, 42
MEMO_ENTRIES = 200_000  # nodes of the trees
ROWS_AT_ONCE, CHARACTERS = 512, 200_000
SIGHTS, SEEN = 4, 1 << 20  # sightings before a node is made, slots that count them
SHORT, TOGETHER = 40, 2048  # characters of a short stretch; stretches merged together
NEVER = 1 << 30
WHOLE = (1 << 64) - 1
STEP, PLACE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def piece_draws(key: int, pieces: int) -> list[int]:
    """A keyed number of every piece, 64 bits each."""
    return (np.uint64(key) + np.arange(1, pieces + 1, dtype=np.uint64) * np.uint64(STEP)).tolist()


def candidate_hash(draw: int, place: int) -> int:
    """32 bits for a candidate merge: its piece's keyed number and its place (splitmix64)."""
    z = draw + place * PLACE & WHOLE
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & WHOLE
    z = (z ^ z >> 27) * 0x94D049BB133111EB & WHOLE
    return z >> 32


def candidate_hashes(draws: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``candidate_hash`` of many."""
    z = draws + places.astype(np.uint64) * np.uint64(PLACE)
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z >> np.uint64(32)


class Pool:
    """Rows of numbers in a numpy array that grows at its end."""

    def __init__(self, dtype, *width: int):
        self.data, self.used = np.zeros((1024, *width), dtype), 0

    def add(self, rows) -> int:
        """Where the rows begin."""
        begin, end = self.used, self.used + len(rows)
        if end > len(self.data):
            wider = np.zeros((max(end, 2 * len(self.data)), *self.data.shape[1:]), self.data.dtype)
            wider[:begin] = self.data[:begin]  # what is not used yet takes no memory
            self.data = wider
        if end > begin:
            self.data[begin:end] = rows
        self.used = end
        return begin


class PairTable:
    """Pieces by the pair of pieces that they are merged from: open addressing in two arrays."""

    def __init__(self, keys: np.ndarray, pieces: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(len(keys) * 8).bit_length()))
        size = 1 << 64 - int(self.shift)
        self.last = size - 1
        self.keys, self.pieces = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        slots, rest = self._slots(keys), np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slots[rest]] < 0]
            self.keys[slots[free]] = keys[free]  # of several for one slot, one stays
            placed = self.keys[slots[rest]] == keys[rest]
            self.pieces[slots[rest[placed]]] = pieces[rest[placed]]
            rest = rest[~placed]
            slots[rest] = slots[rest] + 1 & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(STEP) >> self.shift).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are in the table (those below zero are not), and their pieces."""
        asked = np.flatnonzero(keys >= 0)
        wanted = keys[asked]
        slots, hits = self._slots(wanted), []
        while len(asked):
            held = self.keys[slots]
            hit = held == wanted
            hits.append((asked[hit], self.pieces[slots[hit]]))
            on = np.flatnonzero(~hit & (held >= 0))
            asked, wanted, slots = asked[on], wanted[on], slots[on] + 1 & self.last
        found, pieces = (np.concatenate(x) for x in zip(*hits)) if hits else (np.zeros(0, np.int64), np.zeros(0, np.int32))
        return found, pieces


class Trees:
    """Per stretch, what the agenda does: a node has the candidates that come up
    after the skips that lead to it, the node behind each of them and the ids if
    none of them is skipped. A node is made when it is met ``SIGHTS`` times. All but
    the stretches themselves are numbers in a few arrays."""

    def __init__(self, codec: "PieceCodec"):
        self.codec = codec
        self.roots: dict[str, int] = {}
        self.stretches: list[str] = []
        self.seen = np.zeros(SEEN, np.uint8)  # how often stretches without a node were met, by hash
        # first candidate, candidates, first id, ids, slot of the candidate skipped last
        # (below zero in a root), stretch
        self.nodes = Pool(np.int32, 6)
        # piece, place, node behind (below zero: how often it must yet be met), node
        self.candidates = Pool(np.int32, 4)
        self.ids = Pool(np.uint32)
        self.stretches.append("")
        self._node(0, -1, [], codec.mark)
        self.roots[""] = 0  # a blank mark of the text itself

    def _node(self, stretch: int, skipped: int, came: list, ids: bytes) -> int:
        number, spelt = self.nodes.used, np.frombuffer(ids, np.uint32)
        first = self.candidates.add([(piece, place, -SIGHTS, number) for piece, place in came])
        self.nodes.add([(first, len(came), self.ids.add(spelt), len(spelt), skipped, stretch)])
        return number

    def _grow(self, stretch: int, skipped: int = -1) -> int:
        skips, passed = self._skips(skipped)
        came: list[tuple[int, int]] = []

        def skip(piece: int, place: int) -> bool:
            if (piece, place) in skips:
                return True
            came.append((piece, place))
            return False

        ids = self.codec.spelt(self.codec.agenda(self.stretches[stretch], skip))
        return self._node(stretch, skipped, came[passed:], ids)

    def _skips(self, slot: int) -> tuple[list[tuple[int, int]], int]:
        """The skips that lead behind the candidate in ``slot``, its own first, and how many
        candidates were passed before it."""
        skips, passed = [], 0
        while slot >= 0:
            piece, place, _, owner = self.candidates.data[slot].tolist()
            first, _, _, _, before, _ = self.nodes.data[owner].tolist()
            skips.append((piece, place))
            passed += slot - first
            slot = before
        return skips, passed

    def roots_of(self, stretches: list[str], times: np.ndarray) -> np.ndarray:
        """The node of each stretch, which now occurs so many times; below zero where it
        is long or not met often enough."""
        number = np.array([self.roots.get(t, -1) for t in stretches], np.int64)
        due = self._due([k for k in np.flatnonzero(number < 0).tolist() if len(stretches[k]) < SHORT], stretches, times)
        together = [due[k] for k in self.codec.together([stretches[k] for k in due])]
        for at in range(0, len(together), TOGETHER):
            some = together[at:at + TOGETHER]
            number[some] = self._grow_many([stretches[k] for k in some])
        for k in due:
            if number[k] < 0:
                self.stretches.append(stretches[k])
                number[k] = self._grow(len(self.stretches) - 1)
            self.roots[stretches[k]] = int(number[k])
        return number

    def _due(self, new: list[int], stretches: list[str], times: np.ndarray) -> list[int]:
        """Those of the stretches without a node that are now met often enough. Stretches of
        one hash are counted together: a node may be made early, which changes no id."""
        if not new:
            return []
        if np.count_nonzero(self.seen) >= min(self.codec.memo_entries, SEEN // 4):
            self.seen.fill(0)
        slots = np.fromiter((hash(stretches[k]) % SEEN for k in new), np.int64, len(new))
        met = np.minimum(self.seen[slots] + times[new], SIGHTS)
        self.seen[slots] = np.where(met < SIGHTS, met, 0)
        return [k for k, often in zip(new, (met == SIGHTS).tolist()) if often]

    def _grow_many(self, stretches: list[str]) -> np.ndarray:
        """Root nodes of many stretches."""
        merges: list[tuple] = []
        spelt = self.codec.merge_many(stretches, None, merges=merges)
        rows, pieces, places = (np.concatenate(x) for x in zip(*merges)) if merges else (np.zeros(0, np.int64),) * 3
        order, came = np.argsort(rows, kind="stable"), np.bincount(rows, minlength=len(stretches))
        numbers = np.arange(len(stretches)) + self.nodes.used
        named = np.arange(len(stretches)) + len(self.stretches)
        self.stretches += stretches
        rows = rows[order]
        first = self.candidates.add(np.stack([pieces[order], places[order], np.full(len(rows), -SIGHTS), numbers[rows]], 1))
        sizes = np.fromiter(map(len, spelt), np.int64, len(spelt)) // 4
        begin = self.ids.add(np.frombuffer(b"".join(spelt), np.uint32))
        self.nodes.add(np.stack([first + np.cumsum(came) - came, came, begin + np.cumsum(sizes) - sizes, sizes,
                                 np.full(len(stretches), -1), named], 1))
        return numbers

    def after(self, slot: int) -> int:
        """Make the node behind the candidate in ``slot``, which is skipped."""
        number, owner = self.candidates.data[slot, 2:].tolist()
        if number < 0:
            number = self._grow(int(self.nodes.data[owner, 5]), slot)
            self.candidates.data[slot, 2] = number
        return number


class PieceTexts:
    """Decoder of one model file."""

    def __init__(self, path: str):
        self._read(path)

    def _read(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [(i, model.id_to_piece(i)) for i in range(model.vocab_size())]
        self.bytes = {int(p[3:5], 16): i for i, p in pieces if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces")
        self.ids = {p: i for i, p in pieces
                    if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.texts = {i: p.replace(BLANK, " ").encode() for p, i in self.ids.items()}
        self.texts |= {i: bytes([b]) for b, i in self.bytes.items()}
        return model

    def spelled(self, ids) -> bytes | None:
        """The text of ids in UTF-8; None for ids that no text gives: unknown ones, or pieces
        that do not spell a text behind the dummy blank."""
        raw = b"".join([self.texts.get(i, b"\xff") for i in ids])
        if not raw:
            return raw
        try:
            raw.decode("utf-8")
        except UnicodeDecodeError:
            return None
        return raw[1:] if raw[:1] == b" " else None

    def decode(self, ids) -> str:
        """The text of ids that ``encode`` made; other ids raise ``ValueError``."""
        raw = self.spelled(ids)
        if raw is None:
            raise ValueError("ids that no text gives")
        return raw.decode("utf-8")


class PieceCodec(PieceTexts):
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED, memo_entries: int = MEMO_ENTRIES):
        model = self._read(path)
        # candidates in order of falling score; equal scores are told apart by place
        scores = sorted({model.get_score(i) for i in self.ids.values()}, reverse=True)
        rank = {x: k for k, x in enumerate(scores)}
        self.rank = {p: rank[model.get_score(i)] for p, i in self.ids.items()}
        long = [p for p in self.ids if len(p) > 1]
        if any(BLANK in p.lstrip(BLANK) for p in long):
            raise ValueError("a piece goes over a blank")
        joined = set("".join(long))
        alone = "".join(sorted(c for c in ("\n", "\t", "\r") if c not in joined))
        self.stretches = re.compile(f"[{alone}]|{BLANK}*[^{BLANK}{alone}]+|{BLANK}+" if alone
                                    else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.pieces = model.vocab_size()
        splits = {(self.ids[p[:k]], self.ids[p[k:]]): i for p, i in self.ids.items() for k in range(1, len(p))
                  if p[:k] in self.ids and p[k:] in self.ids}
        self.pairs = PairTable(np.array([a * self.pieces + b for a, b in splits], np.int64),
                               np.array(list(splits.values()), np.int32))
        self.piece_rank = np.full(self.pieces, NEVER, np.int32)
        self.piece_rank[list(self.ids.values())] = [self.rank[p] for p in self.ids]
        self.rank_piece = np.zeros(len(scores), np.int32)
        worded = [p for p in long if p.strip(BLANK)]
        for p in worded:
            self.rank_piece[self.rank[p]] = self.ids[p]
        # a rank must name one piece to merge many words together
        self.one_by_one = len({self.rank[p] for p in worded}) < len(worded)
        # single characters: their piece, or the byte piece where one byte spells them
        self.char_id = np.full(0x110000, -1, np.int32)
        self.char_id[:128] = [self.bytes[b] for b in range(128)]
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        self.limit = int(dropout * 2 ** 32)
        self.seed, self.memo_entries = seed, memo_entries
        self.piece_step = np.arange(1, self.pieces + 1, dtype=np.uint64) * np.uint64(STEP)
        self.spell = {p: array.array("I", [i]).tobytes() for p, i in self.ids.items()}
        self.mark = self._bytes(BLANK)
        self.newline_alone = "\n" in alone
        self.trees = Trees(self)

    def variant(self, doc_id) -> int:
        """The dropout key of a document."""
        named = f"{self.seed}" if doc_id is None else f"{self.seed}:{doc_id}"
        return int.from_bytes(hashlib.blake2b(named.encode(), digest_size=8).digest(), "little")

    def draws(self, variant: int) -> list[int]:
        return piece_draws(variant, self.pieces)

    def merge(self, text: str, draws: list[int], start: int = 0) -> list[str]:
        """The pieces of one stretch that begins at place ``start`` of its document."""
        return self.agenda(text, lambda piece, place: candidate_hash(draws[piece], start + place) < self.limit)

    def _merge_keyed(self, text: str, key: int, start: int) -> list[str]:
        """``merge`` without a table of draws."""
        return self.agenda(text, lambda piece, place: candidate_hash(
            key + (piece + 1) * STEP & WHOLE, start + place) < self.limit)

    def agenda(self, text: str, skip: Callable[[int, int], bool]) -> list[str]:
        """The pieces of one stretch. An entry of the agenda is the rank of the
        merged piece and the place of its left part, in one number."""
        symbols: list[str | None] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank, ids = self.rank, self.ids
        agenda = [rank[p] * n + i for i, p in enumerate(map(str.__add__, symbols, symbols[1:])) if p in rank]
        heapq.heapify(agenda)
        while agenda:
            wanted, i = divmod(heapq.heappop(agenda), n)
            left, j = symbols[i], after[i]
            # stale unless both parts still give the piece of this entry
            if left is None or j >= n or rank.get(joined := left + symbols[j]) != wanted:
                continue
            if skip(ids[joined], i):
                continue
            symbols[i], symbols[j] = joined, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (wider := joined + symbols[k]) in rank:
                    heapq.heappush(agenda, rank[wider] * n + i)
            h = before[i]
            if h >= 0 and (wider := symbols[h] + joined) in rank:
                heapq.heappush(agenda, rank[wider] * n + h)
        return [s for s in symbols if s is not None]

    def _bytes(self, piece: str) -> bytes:
        return array.array("I", [self.bytes[b] for b in piece.encode()]).tobytes()

    def spelt(self, pieces: list[str]) -> bytes:
        return b"".join([self.spell.get(p) or self._bytes(p) for p in pieces])

    def _ranks(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, draws: np.ndarray | None,
               keys_of: np.ndarray | None) -> np.ndarray:
        """Rank of merging ``left`` and ``right``; NEVER if no piece is spelt so or it is
        skipped at this place. ``draws`` by piece are of one key, or of each row's; without
        draws nothing is skipped."""
        keys = left.astype(np.int64) * self.pieces + right
        keys[(left < 0) | (right < 0)] = -1
        found, piece = self.pairs.look_up(keys.ravel())
        if draws is not None:
            draw = draws[piece]
            if keys_of is not None:
                draw = draw + (np.repeat(keys_of, keys.shape[1]) if keys.ndim == 2 else keys_of)[found]
            taken = candidate_hashes(draw, place.ravel()[found]) >= np.uint64(self.limit)
            found, piece = found[taken], piece[taken]
        out = np.full(keys.shape, NEVER, np.int32)
        out.ravel()[found] = self.piece_rank[piece]
        return out

    def together(self, stretches: list[str]) -> list[int]:
        """Which stretches ``merge_many`` can take, by length: not those of several blanks
        (their pieces share ranks) or with characters of several bytes."""
        if self.one_by_one:
            return []
        short = [k for k, t in enumerate(stretches) if 0 < len(t) < SHORT and BLANK * 2 not in t]
        if not short:
            return []
        lengths = np.fromiter((len(stretches[k]) for k in short), np.int64, len(short))
        points = np.frombuffer("".join([stretches[k] for k in short]).encode("utf-32-le"), np.uint32)
        known = np.minimum.reduceat(self.char_id[points], np.cumsum(lengths) - lengths) >= 0
        order = np.argsort(lengths, kind="stable")
        return np.array(short)[order[known[order]]].tolist()

    def merge_many(self, stretches: list[str], draws: np.ndarray | None, keys_of: np.ndarray | None = None,
                   starts: np.ndarray | int = 0, merges: list | None = None) -> list[bytes]:
        """``merge`` and spelling of many short stretches together: in each round every
        stretch takes the first candidate of its agenda. With ``keys_of``, the key of each
        stretch's document, ``draws`` are those of key 0. The merges of each round (stretches,
        pieces, places) are added to ``merges``."""
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        width = int(lengths.max()) + 1
        columns = np.arange(width, dtype=np.int32)
        inside = columns < lengths[:, None]
        symbols = np.full((len(stretches), width), -1, np.int32)
        symbols[inside] = self.char_id[np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)]
        places = columns + np.broadcast_to(np.asarray(starts, np.int32), len(stretches))[:, None]
        ranks = np.full(symbols.shape, NEVER, np.int32)
        ranks[:, :-1] = self._ranks(symbols[:, :-1], symbols[:, 1:], places[:, :-1], draws, keys_of)
        rows, ended, sizes, flat = np.arange(len(stretches)), [], [], []
        while len(rows):
            line = np.arange(len(rows))
            at = ranks.argmin(axis=1)
            best = ranks[line, at]
            going = best < NEVER
            if not going.all():
                rest = symbols[~going]
                ended.append(rows[~going])
                sizes.append((rest >= 0).sum(axis=1))
                flat.append(rest[rest >= 0])
                rows, at, best, line = rows[going], at[going], best[going], line[:int(going.sum())]
                symbols, places, ranks = symbols[going], places[going], ranks[going]
                keys_of = None if keys_of is None else keys_of[going]
            piece = self.rank_piece[best]
            if merges is not None and len(rows):
                merges.append((rows, piece, places[line, at]))
            # the right part goes, all behind it move up
            moved = columns[:-1] > at[:, None]
            for table, fill in ((symbols, -1), (places, 0), (ranks, NEVER)):
                np.copyto(table[:, :-1], table[:, 1:].copy(), where=moved)
                table[:, -1] = fill
            symbols[line, at] = piece
            ranks[line, at] = self._ranks(piece, symbols[line, at + 1], places[line, at], draws, keys_of)
            has = np.flatnonzero(at)
            before = at[has] - 1
            ranks[has, before] = self._ranks(symbols[has, before], piece[has], places[has, before], draws,
                                             None if keys_of is None else keys_of[has])
        spelt = np.concatenate(flat).astype("<u4").tobytes()
        ends = np.cumsum(np.concatenate(sizes)) * 4
        out = [b""] * len(stretches)
        begin = 0
        for row, end in zip(np.concatenate(ended).tolist(), ends.tolist()):
            out[row] = spelt[begin:end]
            begin = end
        return out

    def cut(self, text: str) -> list[str]:
        """The stretches of a text, in order; an empty one is a blank mark that stands in
        the text itself."""
        return self.parted(text).split(" ") if text else []

    def parted(self, text: str) -> str:
        """The stretches of a text that is not empty, with a blank between two (none has one)."""
        lines = text.replace("\n", " \n")
        if self.newline_alone and not ("  " in lines or BLANK in lines or lines[0] == " " or lines[-1] == " "):
            return BLANK + text.replace(" ", " " + BLANK).replace("\n", " \n")
        out: list[str] = []
        for k, part in enumerate((" " + text).split(BLANK)):
            out += [""] * (k > 0) + self.stretches.findall(part.replace(" ", BLANK))
        return " ".join(out)

    def _direct(self, stretches: list[str], keys: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """Stretches merged with their draws."""
        out: list[bytes | None] = [None] * len(stretches)
        together = self.together(stretches)
        for at in range(0, len(together), TOGETHER):
            some = together[at:at + TOGETHER]
            for k, data in zip(some, self.merge_many([stretches[k] for k in some], self.piece_step, keys[some], starts[some])):
                out[k] = data
        return [self.spelt(self._merge_keyed(t, int(keys[k]), int(starts[k]))) if out[k] is None else out[k]
                for k, t in enumerate(stretches)]

    def encode_all(self, texts: list[str], variants: list[int]) -> list[bytes]:
        """``encode`` of many texts, some ``CHARACTERS`` at a time."""
        out: list[bytes] = []
        begin = size = 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= CHARACTERS or k == len(texts) - 1:
                out += self._encode_some(texts[begin:k + 1], variants[begin:k + 1])
                begin, size = k + 1, 0
        return out

    def _encode_some(self, texts: list[str], variants: list[int]) -> list[bytes]:
        if self.trees.nodes.used >= self.memo_entries:
            self.trees = Trees(self)
        trees, parted = self.trees, [self.parted(t) if t else "" for t in texts]
        counts = np.array([t.count(" ") + 1 if t else 0 for t in parted], np.int64)
        if not counts.any():
            return [b""] * len(texts)
        # each different stretch is looked up once
        units = pc.split_pattern(pa.array([" ".join([t for t in parted if t])], pa.large_string()), " ").values.dictionary_encode()
        words, word = units.dictionary.to_numpy(zero_copy_only=False).tolist(), units.indices.to_numpy().astype(np.int64)
        keys = np.repeat(np.array(variants, np.uint64), counts)
        lengths = np.maximum(pc.utf8_length(units.dictionary).to_numpy(), 1)[word]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        edges = np.concatenate(([0], np.cumsum(counts)))
        starts = ends[:-1] - np.repeat(ends[edges[:-1]], counts)
        node = trees.roots_of(words, np.bincount(word))[word]
        going = np.flatnonzero(node >= 0)
        while len(going):
            at = trees.nodes.data[node[going]]
            slots, unit = spread(at[:, 0], at[:, 1]), np.repeat(going, at[:, 1])
            came = trees.candidates.data[slots]
            hashes = candidate_hashes(keys[unit] + self.piece_step[came[:, 0]], starts[unit] + came[:, 1])
            skipped = np.flatnonzero(hashes < np.uint64(self.limit))
            # the first skip of each stretch
            slots, unit = slots[skipped], unit[skipped]
            first = np.flatnonzero(np.diff(unit, prepend=-1))
            slots, going = slots[first], unit[first]
            behind = trees.candidates.data[slots, 2]
            trees.candidates.data[slots[behind < -1], 2] += 1
            for k in np.flatnonzero(behind == -1).tolist():
                behind[k] = trees.after(int(slots[k]))
            node[going] = behind
            going = going[behind >= 0]
        direct = np.flatnonzero(node < 0)
        begin, sizes = trees.nodes.data[node, 2], trees.nodes.data[node, 3]
        data = self._direct([words[k] for k in word[direct].tolist()], keys[direct], starts[direct])
        # the pool's end is free for them until nodes are added
        used = trees.ids.used
        sizes[direct] = [len(x) // 4 for x in data]
        begin[direct] = trees.ids.add(np.frombuffer(b"".join(data), np.uint32)) + np.cumsum(sizes[direct]) - sizes[direct]
        trees.ids.used = used
        spelt = trees.ids.data[spread(begin, sizes)].tobytes()
        bounds = (np.concatenate(([0], np.cumsum(sizes)))[edges] * 4).tolist()
        return [spelt[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, text: str, variant: int) -> bytes:
        """The ids of a text as native 32-bit bytes."""
        return self.encode_all([text], [variant])[0]


def encode_pieces(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED,
                  id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) per document, with ``digests`` also source_sha256 of the
    text; ``model_path`` must be readable on every executor."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_keeps(("pieces", model_path, dropout, seed), lambda: PieceCodec(model_path, dropout, seed))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                keys = [codec.variant(doc) for doc in batch.column("doc_id").to_pylist()]
                texts = batch.column("text").to_pylist()
                ids = codec.encode_all(texts, keys)
                edges = [0]
                for x in ids:
                    edges.append(edges[-1] + len(x) // 4)
                values = pa.Array.from_buffers(pa.int32(), edges[-1], [None, pa.py_buffer(b"".join(ids))])
                columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                           "ids": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)}
                if digests:
                    columns["source_sha256"] = pa.array([sha256_hex(t.encode()) for t in texts], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids array<int>"
                                + (", source_sha256 string" if digests else ""))


def checked_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text_sha256): the ids as they are, and the digest of the text
    that they decode to. A text that differs from the encoded one (source_sha256) raises."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_keeps(("texts", model_path), lambda: PieceTexts(model_path))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                texts = (codec.spelled(cell.values.to_numpy().tolist()) for cell in batch.column("ids"))
                found = [None if raw is None else sha256_hex(raw) for raw in texts]
                for doc, got, want in zip(batch.column("doc_id"), found, batch.column("source_sha256").to_pylist()):
                    if got != want:
                        raise ValueError(f"the ids of document {doc} do not decode to its text")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), batch.column("ids"),
                                                  pa.array(found, pa.string())],
                                                 ["doc_id", "n_tokens", "ids", "text_sha256"])

    return encoded.select("doc_id", "n_tokens", "ids", "source_sha256").mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids array<int>, text_sha256 string")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, n_chars, text_sha256, text) from the ids alone. For ids that no
    text gives, the last three are null."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_keeps(("texts", model_path), lambda: PieceTexts(model_path))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                raws, crcs, sizes = [], [], []
                for cell in batch.column("ids"):
                    ids = cell.values.to_numpy()
                    raws.append(codec.spelled(ids.tolist()))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    sizes.append(len(ids))
                texts = pa.array(raws, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()),
                     pc.utf8_length(texts).cast(pa.int64()),
                     pa.array([None if t is None else sha256_hex(t) for t in raws], pa.string()), texts],
                    ["doc_id", "n_tokens", "ids_crc32", "n_chars", "text_sha256", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids_crc32 long, n_chars long, text_sha256 string, text string")
