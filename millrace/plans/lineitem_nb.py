"""Naive Bayes over lineitem: the Spark pipeline and its closed-form SQL.

Label: ``l_returnflag`` indexed by frequency. Features (non-negative):
quantity, discount, tax, line number. Multinomial model, smoothing 1:

    pi_c      = ln(n_c + 1) - ln(N + K)
    theta_cf  = ln(s_cf + 1) - ln(sum_f s_cf + F)
    predict   = argmax_c  pi_c + sum_f theta_cf * x_f
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.features import assembler, indexer
from millrace.operators.models import fit_pipeline, naive_bayes
from millrace.operators.quality import Imputer
from millrace.plans.registry import table

NB_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def nb_input(spark, sf_dir, impute: bool = False):
    """lineitem with the model columns; with ``impute`` the quantity of line
    2 of every order is nulled first (to be filled by the mean)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                                  "l_quantity", "l_discount", "l_tax")
    if impute:
        li = li.withColumn("l_quantity", F.when(F.col("l_linenumber") == 2, F.lit(None))
                           .otherwise(F.col("l_quantity")))
    return li


def nb_stages(impute: bool = False):
    stages = []
    if impute:
        stages.append(Imputer(inputCols=["l_quantity"], outputCols=["l_quantity"],
                              strategy="mean"))
    stages += [indexer(["l_returnflag"], ["label"]), assembler(NB_FEATURES), naive_bayes()]
    return stages


def nb_fit(spark, sf_dir, impute: bool = False):
    df = nb_input(spark, sf_dir, impute)
    return fit_pipeline(nb_stages(impute), df), df


def nb_scored(spark, sf_dir, impute: bool = False):
    model, df = nb_fit(spark, sf_dir, impute)
    return model.transform(df)


def nb_sql(final: str, impute: bool = False) -> str:
    """DuckDB CTEs ending in ``scored`` (one row per lineitem row with
    ``label`` and ``prediction``), followed by ``final``."""
    q = "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END" if impute else "l_quantity"
    denom = "ln(s0 + s1 + s2 + s3 + 4)"
    return f"""
WITH src AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_returnflag,
                    {q} AS q0, l_discount AS f1, l_tax AS f2,
                    CAST(l_linenumber AS DOUBLE) AS f3 FROM lineitem),
imp AS (SELECT *, coalesce(q0, avg(q0) OVER ()) AS f0 FROM src),
lab AS (SELECT l_returnflag,
               CAST(row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS DOUBLE) AS label
        FROM lineitem GROUP BY l_returnflag),
d AS (SELECT imp.*, lab.label FROM imp JOIN lab USING (l_returnflag)),
cls AS (SELECT label AS c, count(*) AS n, sum(f0) AS s0, sum(f1) AS s1, sum(f2) AS s2,
               sum(f3) AS s3 FROM d GROUP BY label),
tot AS (SELECT sum(n) AS nn, count(*) AS k FROM cls),
par AS (SELECT c, ln(n + 1) - ln(nn + k) AS pi,
               ln(s0 + 1) - {denom} AS t0, ln(s1 + 1) - {denom} AS t1,
               ln(s2 + 1) - {denom} AS t2, ln(s3 + 1) - {denom} AS t3 FROM cls, tot),
sc AS (SELECT d.rid, par.c, par.pi + par.t0 * d.f0 + par.t1 * d.f1 + par.t2 * d.f2
                             + par.t3 * d.f3 AS score FROM d, par),
pred AS (SELECT rid, arg_max(c, score) AS prediction FROM sc GROUP BY rid),
scored AS (SELECT d.*, pred.prediction FROM d JOIN pred USING (rid))
{final}
"""
