"""Queries of the operators that find what repeats: spans, phrases, runs."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import collocations, periodic_runs, repeated_spans
from millrace.llm.common import table


def op11_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.span_report(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH p AS (SELECT coalesce(lang, '{collocations.NO_LANG}') AS lang, unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
     g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
           FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                 FROM w, range(1, {collocations.MAX_WORDS + 1}) t(k) WHERE len(w) >= k) GROUP BY ALL),
     n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
     c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM g
           WHERE k > 1 AND f >= {collocations.MIN_COUNT}),
     b AS (SELECT lang, array_to_string(w[i:i + z - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT lang, w, a, i, unnest(range(2, k)) AS z, k FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM c))
           WHERE i + z - 1 <= k GROUP BY ALL),
     d AS (SELECT c.* FROM c LEFT JOIN b USING (lang, phrase)
           WHERE longer IS NULL OR 100 * longer < {collocations.PERCENT} * a),
     x AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
           FROM (SELECT *, unnest(range(1, k)) AS j FROM d)),
     s AS (SELECT x.lang, x.phrase, x.a, x.j, h.f AS l, t.f AS r, n.n,
                  CAST((1000::HUGEINT * x.a * n.n) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
           FROM x JOIN g h ON h.lang = x.lang AND h.phrase = x.head JOIN g t ON t.lang = x.lang AND t.phrase = x.tail
           JOIN n ON n.lang = x.lang),
     m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM m QUALIFY rank <= {collocations.TOP}
"""


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """A tenth of the documents, by their id's checksum, go on with copies of a
    stretch of their own words."""
    checksum, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if checksum % 10 or not n:
        return words
    g = checksum // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    copies = -(-(n - a) // period)
    return words[:a] + (words[a:a + period] * copies)[:n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {"op11_repeated_spans": op11_repeated_spans, "op12_collocations": op12_collocations, "op13_periodic_runs": op13_periodic_runs}
ORACLES = {"op12_collocations": OP12_SQL}
