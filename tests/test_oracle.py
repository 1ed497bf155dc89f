"""Every registered query against its DuckDB oracle (sf0.001 here; the
driver runs sf0.01). Rows-only queries must run and return rows."""

import pytest

import __spark_entry__ as entry
from millrace import plans
from conftest import SF001
from tools.oracle_check import _rows, duck

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "float": "FLOAT", "boolean": "BOOLEAN", "binary": "BLOB"}
QUERIES = plans.queries()
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle_or_rows_note():
    from millrace.plans.registry import REGISTRY
    for name, reg in REGISTRY.items():
        assert reg.sql or reg.note, name


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    dcols, drows = list(rel.columns), rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    assert spark_types == dict(zip(dcols, [str(t) for t in rel.types]))
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows, None) == _rows(dcols, drows, None)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF001).count() > 0


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "prediction", "n"]
    n_lines = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert len(rows) == 9 and sum(r["n"] for r in rows) == n_lines
