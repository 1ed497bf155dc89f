"""Search and split queries whose fits are sums over the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.fold_search import naive_bayes_search
from millrace.operators.tree_splits import tree_splits
from millrace.plans.column_queries import LINE_KEYS, split_sql
from millrace.plans.lineitem_nb import NB_FEATURES
from millrace.plans.model_queries import SMOOTHING, cv_sql, signal_frame
from millrace.plans.registry import query


@query("cross_validate_folds", sql=cv_sql("SELECT s AS smoothing, round(avg_metric, 9) AS avg_metric FROM m"))
def q_cross_validate_folds(spark, sf_dir):
    """The search of ``cross_validate`` (10 folds x 12 smoothings) in two passes."""
    train = (signal_frame(spark, sf_dir).where("split = 'train'")
             .withColumn("fold", F.expr("CAST(pmod(l_orderkey, 10) AS INT)")))
    found = naive_bayes_search(train, "label", NB_FEATURES, SMOOTHING, "fold")
    return found.select("smoothing", F.round("avg_metric", 9).alias("avg_metric"))


TREE_DEPTH = 2


def _gini(positive: str, rows: str) -> str:
    share = f"(({positive}) / CAST({rows} AS DOUBLE))"
    return f"(1 - {share} * {share} - (1 - {share}) * (1 - {share}))"


def tree_sql(depth: int) -> str:
    """The best split of every node, level by level."""
    parts = [f"""
WITH tagged AS ({split_sql(24, [0.8, 0.2], ["train", "test"], ", ".join(LINE_KEYS), "lineitem", "*")}),
n0 AS (SELECT CAST(1 AS BIGINT) AS node,
              CASE WHEN l_quantity + 200 * l_discount + (l_orderkey * 7919) % 20 > 45 THEN 1 ELSE 0 END AS y,
              [CAST(l_quantity AS DOUBLE), l_discount, l_tax, CAST(l_linenumber AS DOUBLE)] AS x
       FROM tagged WHERE split = 'train')"""]
    for k in range(depth):
        gain = (f"{_gini('tp', 'tn')} - ln / CAST(tn AS DOUBLE) * {_gini('lp', 'ln')} "
                f"- (tn - ln) / CAST(tn AS DOUBLE) * {_gini('tp - lp', '(tn - ln)')}")
        parts.append(f"""
h{k} AS (SELECT node, feature, v, count(*) AS n, sum(y) AS p
         FROM (SELECT node, y, unnest(range({len(NB_FEATURES)})) AS feature, unnest(x) AS v FROM n{k}) GROUP BY ALL),
c{k} AS (SELECT node, feature, v, lead(v) OVER w AS nv, sum(n) OVER w AS ln, sum(p) OVER w AS lp,
                sum(n) OVER g AS tn, sum(p) OVER g AS tp FROM h{k}
         WINDOW w AS (PARTITION BY node, feature ORDER BY v), g AS (PARTITION BY node, feature)),
b{k} AS (SELECT node, CAST(feature AS INTEGER) AS feature, (v + nv) / 2 AS threshold, {gain} AS gain, CAST(tn AS BIGINT) AS n
         FROM c{k} WHERE nv IS NOT NULL AND round({gain}, 12) > 0
         QUALIFY row_number() OVER (PARTITION BY node ORDER BY round({gain}, 12) DESC, feature, v) = 1),
n{k + 1} AS (SELECT CAST(2 * node + CASE WHEN x[feature + 1] > threshold THEN 1 ELSE 0 END AS BIGINT) AS node, y, x
             FROM n{k} JOIN b{k} USING (node))""")
    union = " UNION ALL ".join(f"SELECT * FROM b{k}" for k in range(depth))
    return ",".join(parts) + f"""
SELECT node, feature, round(threshold, 9) AS threshold, round(gain, 9) AS gain, n FROM ({union})"""


@query("decision_tree_splits", sql=tree_sql(TREE_DEPTH))
def q_decision_tree_splits(spark, sf_dir):
    train = signal_frame(spark, sf_dir).where("split = 'train'")
    found = tree_splits(train, "label", NB_FEATURES, [0.0, 1.0], TREE_DEPTH)
    return found.select("node", "feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 9).alias("gain"), "n")
