import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.text import jvm_split_space, text_lines
from millrace.operators.aggregates import token_count, tokenize


def java_split_space(s):
    """Reference behaviour of Java's ``s.split(" ")``."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def reader_lines(t):
    if t == "":
        return []
    parts = re.split(r"\r\n|\r|\n", t)
    if re.search(r"[\r\n]$", t):
        parts = parts[:-1]
    return parts


def test_split_edge_cases(spark):
    cases = ["", " ", "   ", "a", " a", "a ", "a  b", "  a b  ", "a\tb"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", jvm_split_space("s").alias("t")).collect()}
    for c in cases:
        assert got[c] == java_split_space(c), repr(c)


def test_null_line_gives_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(jvm_split_space("s").alias("t")).first()["t"] is None


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=" ab\r\n", max_size=12), min_size=1, max_size=8))
def test_split_and_lines_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", text_lines("s").alias("lines"),
                     F.transform(text_lines("s"), lambda x: jvm_split_space(x)).alias("toks")
                     ).collect()
    for r in rows:
        assert r["lines"] == reader_lines(r["s"])
        assert r["toks"] == [java_split_space(x) for x in reader_lines(r["s"])]


def test_token_count_and_positions(spark):
    df = spark.createDataFrame([(1, "the cat\nthe  dog "), (2, "")], "id long, text string")
    counts = {r["word"]: r["n"] for r in token_count(df).collect()}
    assert counts == {"the": 2, "cat": 1, "": 1, "dog": 1}
    toks = tokenize(df, keep=["id"], positions=True).orderBy("id", "line_no", "token_no").collect()
    assert [(t.line_no, t.token_no, t.word) for t in toks] == [
        (0, 0, "the"), (0, 1, "cat"), (1, 0, "the"), (1, 1, ""), (1, 2, "dog")]


def test_token_count_plan_has_partial_aggregate(spark):
    df = spark.createDataFrame([(1, "a b")], "id long, text string")
    plan = token_count(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "partial_count" in plan


def test_line_break_at_end_uses_end_of_input(spark):
    df = spark.createDataFrame([("a\n ",), ("a\n",)], "s string")
    got = [r.l for r in df.select(text_lines("s").alias("l")).collect()]
    assert got == [["a", " "], ["a"]]
