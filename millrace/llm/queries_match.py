"""Queries of the operators that find equal, similar or leaked texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, exact_dedup, minhash
from millrace.llm.common import table

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


OP3_SQL = rf"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {minhash.SHINGLE - 1}], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {minhash.SHINGLE - 1}, 1) + 1)) AS i
            FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter
      FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
      WHERE 100 * inter >= {minhash.PERCENT} * (na.n + nb.n - inter)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(node, comp) AS (SELECT doc_id, doc_id FROM documents
                  UNION SELECT e2.b, r.comp FROM r JOIN e2 ON e2.a = r.node WHERE r.comp < e2.b)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, c.comp AS component_id, doc_id = c.comp AS kept
FROM documents JOIN (SELECT node, min(comp) AS comp FROM r GROUP BY node) c ON c.node = doc_id
LEFT JOIN n USING (doc_id)
"""


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by a hash of the id, plays the earlier batch whose
    digests are under perfect hashes; the other half is looked up. Rows of both
    halves are read, grouped together and returned."""
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.mark_duplicates(*exact_dedup.earlier_batch(docs))


OP5_SQL = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("hit_runs")


_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
     bw AS (SELECT DISTINCT item, least(len(w), {decontaminate.WINDOW}) AS n,
                   array_to_string(w[i:i + least(len(w), {decontaminate.WINDOW}) - 1], ' ') AS win
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {decontaminate.WINDOW - 1}, 1) + 1)) AS i
                  FROM b WHERE len(w) > 0)),
     d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
     h AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, win)),
     nh AS (SELECT doc_id, count(DISTINCT j) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
     it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN it USING (doc_id)
"""

QUERIES = {"op3_minhash_dedup": op3_minhash_dedup, "op5_exact_dedup": op5_exact_dedup,
           "op8_decontaminate": op8_decontaminate}
ORACLES = {"op3_minhash_dedup": OP3_SQL, "op5_exact_dedup": OP5_SQL, "op8_decontaminate": OP8_SQL}
