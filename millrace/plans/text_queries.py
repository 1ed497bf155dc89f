"""Queries for tokenising and counting text (documents table)."""

from __future__ import annotations

from millrace.operators.aggregates import token_count, tokenize
from millrace.plans.registry import query, table

# DuckDB form of the two split rules: lines as a line reader yields them,
# tokens as Java's String.split(" ") yields them.
_LINES_SQL = """
    CASE WHEN text = '' THEN []::VARCHAR[]
         WHEN regexp_matches(text, '(\\r|\\n)$')
              THEN list_slice(string_split_regex(text, '\\r\\n|\\r|\\n'), 1,
                              len(string_split_regex(text, '\\r\\n|\\r|\\n')) - 1)
         ELSE string_split_regex(text, '\\r\\n|\\r|\\n') END
"""
_TOKENS_SQL = """
    CASE WHEN line = '' THEN ['']
         WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
         ELSE string_split(rtrim(line, ' '), ' ') END
"""


@query("token_count", sql=f"""
WITH lines AS (SELECT unnest({_LINES_SQL}) AS line FROM documents),
     words AS (SELECT unnest({_TOKENS_SQL}) AS word FROM lines)
SELECT word, count(*) AS n FROM words GROUP BY word
""")
def q_token_count(spark, sf_dir):
    return token_count(table(spark, sf_dir, "documents"), "text")


@query("tokenize", sql=f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, {_LINES_SQL} AS l FROM documents)),
tokens AS (
  SELECT doc_id, line_no, {_TOKENS_SQL} AS t FROM lines)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
       CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS token_no, unnest(t) AS word
FROM tokens
""")
def q_tokenize(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return tokenize(docs, "text", keep=["doc_id"], positions=True)
