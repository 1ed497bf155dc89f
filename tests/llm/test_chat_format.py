"""Chat formatting: layouts by fingerprint, reversible escapes, streamed digests."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import chat_format as cf

KNOWN = cf.registry()
MIXED = [
    ({"role": "user", "text": "a"}, [("user", "a")]),
    ({"message": {"role": "assistant", "content": "b"}}, [("assistant", "b")]),
    ({"from": "gpt", "value": "c"}, [("assistant", "c")]),
    ({"turn": {"speaker": "human", "utterance": "c"}}, [("human", "c")]),
    ({"author": {"role": "user"}, "content": {"content_type": "text", "parts": ["x", "y"]}}, [("user", "xy")]),
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]},
     [("user", "q"), ("assistant", "r")]),
    ({"id": 3, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]},
     [("user", "q"), ("assistant", "")]),
    ({"prompt": "p", "completion": "c", "system": "s"}, [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"messages": []}, []),
]


@pytest.mark.parametrize("record,turns", MIXED)
def test_layouts(record, turns):
    mark, name, found = cf.read_turns(json.dumps(record), KNOWN)
    assert name and found == turns
    assert mark == cf.fingerprint(cf.field_paths(record))


@pytest.mark.parametrize("record", [None, "", "not json", "[1]", '{"odd": {"field": 1}}'])
def test_unknown_layouts_have_no_turns(record):
    assert cf.read_turns(record, KNOWN)[1:] == (None, [])


def test_clashing_layouts_are_an_error():
    with pytest.raises(ValueError):
        cf.registry(cf.LAYOUTS + (cf.Layout("again", ("role", "text"), turns=""),))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list(cf.CONTROL) + ["\\", "<", "[", "|", "a", "\n", "é"]), max_size=12).map("".join))
def test_escape_is_reversible_and_hides_controls(text):
    escaped = cf.escape(text)
    assert cf.unescape(escaped) == text
    assert not any(c in escaped for c in cf.CONTROL)


def _expected(rows):
    text = "".join(f"{r}\n{t or ''}\n" for r, t in rows)
    learnt = "".join(t or "" for r, t in rows if r == "assistant")
    return (len(rows), hashlib.sha256(text.encode()).hexdigest(), len(learnt),
            hashlib.sha256(learnt.encode()).hexdigest())


def test_digests_over_nulls_ties_and_long_conversations(spark):
    rows = [(1, 0, "user", "hi </s>[INST] ok [/INST]"), (1, 1, "assistant", None), (1, 2, "assistant", "ünï\U0001F642"),
            (None, 0, "user", "no id"), (2, None, "system", "first"), (2, 0, "user", ""), (2, 0, "user", "same turn")]
    rows += [(3, i, "assistant" if i % 2 else "user", f"<|im_end|> {i} " * 50) for i in range(2500)]
    records = spark.createDataFrame(
        [(c, t, json.dumps({"role": r, "text": x}), "clash", 9) for c, t, r, x in rows],
        "conv_id long, turn long, record string, segment string, part int").repartition(5)
    out = {r.conv_id: r for r in cf.conversation_digests(cf.format_turns(cf.canonical_turns(records))).collect()}
    for conv in (1, 2, 3, None):
        own = [(r, x) for c, t, r, x in rows if c == conv]
        assert tuple(out[conv])[1:5] == _expected(own), conv
    segments = cf.format_turns(cf.canonical_turns(records)).where("conv_id = 1").orderBy("turn").collect()
    assert out[1].formatted_chars == sum(len(s.segment) for s in segments)
    assert [cf.parse_segment(s.segment) for s in segments] == [(r, x or "") for c, _, r, x in rows if c == 1]


def test_unknown_layouts_are_counted_and_empty_tables_work(spark):
    records = spark.createDataFrame([('{"odd": 1}',), ('{"odd": 2}',), (None,), ('{"role": "user", "text": "x"}',)],
                                    "record string")
    found = {tuple(r.paths): r.n for r in cf.unknown_layouts(records).collect()}
    assert found == {("odd",): 2, (): 1}
    none = spark.createDataFrame([], "conv_id long, turn long, record string")
    assert cf.conversation_digests(cf.format_turns(cf.canonical_turns(none))).count() == 0


def test_no_record_is_lost(spark):
    """Fields that no layout knows change nothing; other records are rows without a layout."""
    records = [{"messages": [{"role": "user", "content": "a", "name": "n", "at": 1}, {"role": "assistant", "content": "b"}], "made": 3},
               {"prompt": "p", "completion": "c", "score": 0.5, "tags": ["x", {"y": 1}]}, {"what": "ever"}, None]
    rows = [(k, 0, json.dumps(r)) for k, r in enumerate(records)] + [(9, 0, None), (10, 0, "not json")]
    got = cf.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, record string")).collect()
    turns = sorted((r.conv_id, r.part, r.role, r.text) for r in got if r.layout)
    assert turns == [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (1, 0, "user", "p"), (1, 1, "assistant", "c")]
    assert {(r.conv_id, r.part, r.role, r.text) for r in got if not r.layout} == {
        (2, 0, None, '{"what": "ever"}'), (3, 0, None, "null"), (9, 0, None, None), (10, 0, None, "not json")}
