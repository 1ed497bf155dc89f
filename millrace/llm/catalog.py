"""The registered queries of this package with their DuckDB SQL."""

from __future__ import annotations

from millrace.llm import queries_format, queries_match, queries_repeats, queries_text

MODULES = (queries_format, queries_match, queries_repeats, queries_text)


def queries():
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
