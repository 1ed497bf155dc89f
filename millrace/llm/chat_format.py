"""Chat formatting with layouts chosen by a fingerprint of field paths.

A record is JSON text of unknown layout. The set of its nested field paths
(``messages[].role``) is hashed; the hash selects a declarative mapping that
says where the turns, roles and texts are. Optional fields make a mapping
answer to several fingerprints, all computed from its declaration. A record of
unknown fingerprint is hashed again by the paths that layouts know; one that still has no
layout is a row of its own without role and layout. ``unknown_layouts`` counts them by paths.

Turns are formatted as ``<|im_start|>role\\n text <|im_end|>\\n``. Where a text
holds a control string, possibly with backslashes after its first character,
one more backslash is put there; reading takes one away, so the text comes back
exactly and never looks like a turn mark. The loss mask is the span of each
assistant text in its segment.

The output has one segment per turn; a conversation is its segments in
order. Reading back sorts by conversation and streams, holding one turn at a
time, so a conversation of any length needs no more memory.

Edge cases: null text counts as empty; a null role is the role ``""`` and line
ends in roles become spaces; rows of a null conversation id are one
conversation; null turn numbers come first and ties are ordered by their
text; repeated rows are turns of their own; records that are null, not JSON or
not an object have the layout of no field; an empty table gives no turns;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_REST = "|".join(re.escape(c[1:]) for c in CONTROL)
_FIRST = "".join(sorted({re.escape(c[0]) for c in CONTROL}))
_QUOTE = re.compile(rf"([{_FIRST}])(\\*)(?={_REST})")
_UNQUOTE = re.compile(rf"([{_FIRST}])\\(\\*)(?={_REST})")
_SEGMENT = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n", re.DOTALL)

# The role names of layouts that use their own
SHARED_NAMES = (("human", "user"), ("gpt", "assistant"))


def escape(text: str) -> str:
    return _QUOTE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNQUOTE.sub(r"\1\2", text)


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``turns`` is the path of the list of messages ("" for a record that is one
    message) with ``role`` and ``text`` paths inside a message; or ``fields``
    states the turns outright as (role, field paths joined by a blank line).
    ``names`` are role names that the layout has for others.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, tuple[str, ...]], ...] = field(default=())
    names: tuple[tuple[str, str], ...] = ()

    def fingerprints(self) -> Iterator[str]:
        for k in range(len(self.optional) + 1):
            for more in itertools.combinations(self.optional, k):
                yield fingerprint(self.paths + more)


def fingerprint(paths) -> str:
    """Hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def field_paths(value, at: str = "") -> Iterator[str]:
    """Paths of the leaves: names joined by dots, ``[]`` for list elements."""
    if isinstance(value, dict) and value:
        for name, x in value.items():
            yield from field_paths(x, f"{at}.{name}" if at else name)
    elif isinstance(value, list) and value:
        for x in value:
            yield from field_paths(x, f"{at}[]")
    elif at:
        yield f"{at}[]" if isinstance(value, list) else at


LAYOUTS = (
    Layout("flat turn", ("role", "text"), turns="", text="text"),
    Layout("flat content", ("role", "content"), turns="", text="content"),
    Layout("message", ("message.role", "message.content"), turns="", role="message.role", text="message.content"),
    Layout("from and value", ("from", "value"), turns="", role="from", text="value", names=SHARED_NAMES),
    Layout("speaker", ("turn.speaker", "turn.utterance"), turns="", role="turn.speaker", text="turn.utterance"),
    Layout("author and parts", ("author.role", "content.content_type", "content.parts[]"), turns="",
           role="author.role", text="content.parts"),
    Layout("messages", ("messages[].role", "messages[].content"), ("id", "source"), turns="messages"),
    Layout("conversations", ("conversations[].from", "conversations[].value"), ("id",), turns="conversations",
           role="from", text="value", names=SHARED_NAMES),
    Layout("no messages", ("messages[]",), ("id", "source"), turns="messages"),
    Layout("prompt and completion", ("prompt", "completion"), ("system",),
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt and response", ("prompt", "response"), ("system",),
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction", ("instruction", "output"), ("input", "system"),
           fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("question and answer", ("question", "answer"), ("context",),
           fields=(("user", ("context", "question")), ("assistant", ("answer",)))),
)


def registry(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """Fingerprint to layout; layouts that claim one fingerprint are an error."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        for mark in layout.fingerprints():
            if found.setdefault(mark, layout) is not layout:
                raise ValueError(f"layouts {found[mark].name!r} and {layout.name!r} have the same paths")
    return found


def known_paths(layouts: dict[str, Layout]) -> set[str]:
    """All field paths that some layout keeps turns in."""
    return {p for layout in set(layouts.values()) for p in layout.paths + layout.optional}


def _get(value, path: str):
    for name in path.split(".") if path else ():
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    if isinstance(value, list):
        return "".join(map(_text, value))
    if value is None:
        return ""
    # JSON can spell half a surrogate pair, which UTF-8 cannot
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text.encode("utf-8", "replace").decode()


def _role(value, names: dict[str, str]) -> str:
    name = " ".join(_text(value).split("\n"))
    return names.get(name, name)


def read_turns(record: str | None, layouts: dict[str, Layout]) -> tuple[str, str | None, list[tuple[str, str]]]:
    """(fingerprint, layout name or None, turns as (role, text)) of a record."""
    try:
        value = json.loads(record or "null")
    except ValueError:
        value = None
    paths = set(field_paths(value)) if isinstance(value, dict) else set()
    mark = fingerprint(paths)
    # fields that no layout knows are left out of a second hash
    layout = layouts.get(mark) or layouts.get(fingerprint(paths & known_paths(layouts)))
    if layout is None:
        return mark, None, []
    if layout.turns is None:
        turns = [(role, "\n\n".join(t for t in (_text(_get(value, p)) for p in paths) if t or len(paths) == 1))
                 for role, paths in layout.fields
                 if any(_get(value, p) is not None for p in paths) or role != "system"]
        return mark, layout.name, turns
    messages = [value] if layout.turns == "" else _get(value, layout.turns) or []
    names = dict(layout.names)
    return mark, layout.name, [(_role(_get(m, layout.role), names), _text(_get(m, layout.text))) for m in messages]


def canonical_turns(records: DataFrame, record_col: str = "record", conv_col: str = "conv_id",
                    turn_col: str = "turn", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, part, role, text, layout, fingerprint) of every turn of
    every record; ``part`` numbers the turns of one record. Fields that no layout knows
    are ignored. A record that no layout answers to is one row with the record as its
    text and without role and layout, so no record goes unseen."""
    rows = records.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                          F.col(record_col).alias("record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = registry(layouts)
        for batch in batches:
            out = []
            for conv, turn, record in zip(*(batch.column(i).to_pylist() for i in range(3))):
                mark, name, turns = read_turns(record, known)
                turns = turns if name else [(None, record)]
                out += [(conv, turn, i, role, text, name, mark) for i, (role, text) in enumerate(turns)]
            types = [pa.int64()] * 3 + [pa.string()] * 4
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             ["conv_id", "turn", "part", "role", "text", "layout", "fingerprint"])

    return rows.mapInArrow(run, "conv_id long, turn long, part long, role string, text string, "
                                "layout string, fingerprint string")


def unknown_layouts(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(fingerprint, paths, n) of the records that no layout answers to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = registry(layouts)
        for batch in batches:
            found = []
            for record in batch.column(0).to_pylist():
                mark, name, _ = read_turns(record, known)
                if name is None:
                    try:
                        value = json.loads(record or "null")
                    except ValueError:
                        value = None
                    found.append((mark, sorted(set(field_paths(value))) if isinstance(value, dict) else []))
            marks, paths = zip(*found) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.string()), pa.array(paths, pa.list_(pa.string()))],
                                             ["fingerprint", "paths"])

    rows = records.select(F.col(record_col).alias("record")).mapInArrow(run, "fingerprint string, paths array<string>")
    return rows.groupBy("fingerprint", "paths").agg(F.count("*").alias("n"))


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, part, segment, loss_start, loss_end): the formatted turns
    with the span, in code points, that counts for the loss (empty at 0 for
    turns that are not the assistant's)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, starts, ends = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                head, body = f"{START}{escape(role or '')}\n", escape(text or "")
                segments.append(f"{head}{body}{END}\n")
                learnt = role == "assistant"
                starts.append(len(head) if learnt else 0)
                ends.append(len(head) + len(body) if learnt else 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "turn", "part")), pa.array(segments, pa.string()),
                 pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                ["conv_id", "turn", "part", "segment", "loss_start", "loss_end"])

    return turns.select("conv_id", "turn", "part", "role", "text").mapInArrow(
        run, "conv_id long, turn long, part long, segment string, loss_start long, loss_end long")


def parse_segment(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    found = _SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError("a segment is not one formatted turn")
    return unescape(found[1]), unescape(found[2])


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Per conversation, from its formatted segments alone: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "part")] + [F.col("segment")]
    dealt = segments.repartitionByRange(order[0]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def close() -> tuple:
            return (current[0], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(),
                    state["size"])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, types)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            done = []
            for conv, segment, a, b in zip(*(batch.column(c).to_pylist()
                                             for c in ("conv_id", "segment", "loss_start", "loss_end"))):
                if current != (conv,):
                    if current:
                        done.append(close())
                    current = (conv,)
                    state = {"n": 0, "chars": 0, "size": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256()}
                role, text = parse_segment(segment)
                learnt = unescape(segment[a:b])
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["loss"].update(learnt.encode())
                state["n"] += 1
                state["chars"] += len(learnt)
                state["size"] += len(segment)
            yield batch_of(done)
        if current:
            yield batch_of([close()])

    return dealt.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")
