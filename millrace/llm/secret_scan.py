"""Secret scan: keyword automaton, anchored expressions at the hits, checksums.

Every text is lower-cased (A-Z only) and run once through an Aho-Corasick
automaton of the keywords. An expression is tried only where a keyword
ended, anchored at the keyword's start, so texts without keywords never
meet a regular expression. Long hexadecimal runs have no keyword: one probe
per ``HEX_MIN`` bytes decides whether a text can hold such a run at all.
Tokens that embed a checksum are accepted only if the checksum is right.

Kinds, in the order that breaks ties between spans of one start:

* ``assign``, ``access``, ``hex``: the base kinds, leftmost non-overlapping per
  kind; a match that fails its length test is dropped but still consumes text.
* ``github``, ``npm``: ``gh[opusr]_`` or ``npm_``, 30 characters of entropy, then
  six base-62 digits of the CRC-32 of those 30 characters.
* ``card``: 13 to 19 digits after the word ``card``, valid by the Luhn sum.

Edge cases: null text counts as empty and gives no spans; a null id is kept;
rows are independent, so ties and repeated rows each give their own row; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import sha256_hex, text_bytes

KINDS = ("assign", "access", "hex", "github", "npm", "card")
BASE_KINDS = 3
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SEALED = re.compile(r"(?:gh[opusr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
CARD = re.compile(r"card[^0-9\n]{0,16}([0-9](?:[ -]?[0-9]){12,18})(?![0-9])", re.IGNORECASE | re.ASCII)

KEYWORDS = {**dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign"),
            "akia": "access", "npm_": "npm", "card": "card",
            **{f"gh{c}_": "github" for c in "opusr"}}

BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
_HEX_BYTE = np.array([chr(b) in "0123456789abcdef" for b in range(256)])

SCHEMA = ("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def crc_seal(body: str) -> str:
    """Six base-62 digits of the CRC-32 of ``body``."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def may_hold_hex(raw: bytes) -> bool:
    """Whether a run of ``HEX_MIN`` hex digits is possible: such a run covers
    one byte of every ``HEX_MIN``, and that byte's neighbour."""
    probes = _HEX_BYTE[np.frombuffer(raw, np.uint8)]
    at = np.arange(HEX_MIN - 1, len(raw), HEX_MIN)
    at = at[probes[at]]
    if not len(at):
        return False
    # a run through a probe holds at least 12 digits on one side of it
    half = HEX_MIN // 2
    left = np.add.accumulate(np.concatenate(([0], probes)))
    return bool(np.any((left[at + 1] - left[np.maximum(at + 1 - half, 0)] >= half)
                       | (left[np.minimum(at + half, len(raw))] - left[at] >= half)))


def _anchored(pattern: re.Pattern, text: str, starts: list[int]) -> Iterator[re.Match]:
    """The leftmost non-overlapping matches, given every place one can start."""
    end = 0
    for at in starts:
        if at >= end and (m := pattern.match(text, at)):
            end = m.end()
            yield m


def find_spans(text: str, raw: bytes, automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, sorted."""
    starts: dict[str, list[int]] = {}
    for end, (kind, size) in automaton.iter(raw.lower().decode("utf-8")):
        starts.setdefault(kind, []).append(end + 1 - size)
    spans = [(m.start(), 0, m.end()) for m in _anchored(ASSIGN, text, starts.get("assign", []))
             if len(m[2]) >= ASSIGN_MIN]
    spans += [(m.start(), 1, m.end()) for m in _anchored(ACCESS, text, starts.get("access", []))
              if len(m[0]) >= ACCESS_MIN]
    if len(raw) >= HEX_MIN and may_hold_hex(raw):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= HEX_MIN]
    for kind in ("github", "npm"):
        spans += [(m.start(), KINDS.index(kind), m.end())
                  for m in _anchored(SEALED, text, starts.get(kind, [])) if crc_seal(m[1]) == m[2]]
    spans += [(m.start(1), 5, m.end(1)) for m in _anchored(CARD, text, starts.get("card", []))
              if luhn(re.sub("[ -]", "", m[1]))]
    return sorted(spans)


def keyword_automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = keyword_automaton()
    for batch in batches:
        rows = []
        for cell in batch.column(1):
            raw = cell.as_py()
            spans = find_spans(raw.decode("utf-8"), raw, automaton)
            base = [s for s in spans if s[1] < BASE_KINDS]
            counts = [sum(s[1] == k for s in base) for k in range(BASE_KINDS)]
            rows.append((*counts, sha256_hex(_digest(base).encode()), _digest(spans)))
        columns = list(zip(*rows)) or [[]] * 5
        types = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, types)],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base
    spans, and all spans as ``kind:start:end`` (code points, end exclusive)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("raw"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan, f"doc_id {id_type}, {SCHEMA}")


def redact(text: str, spans: str, mark: str = "[SECRET]") -> str:
    """``text`` with the union of its spans (as from ``scan_secrets``) replaced."""
    cuts = sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s)
    out, at = [], 0
    for start, end in cuts:
        if end > at:
            out += [text[at:start], mark] if start >= at else []
            at = end
    return "".join(out) + text[at:]
