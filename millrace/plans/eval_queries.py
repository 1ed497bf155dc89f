"""Evaluation queries. Multiclass metrics use the Naive Bayes predictions on
lineitem (SQL closed form on the oracle side); binary curve metrics use
``events``: label = error event, score = value."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import class_totals
from millrace.operators.evaluation import (accuracy, auc_hard, auc_pr, auc_score,
                                           confusion_matrix, curve_areas, outcome_counts, per_class_metrics,
                                           regression_metrics)
from millrace.plans.lineitem_nb import nb_fit, nb_scored, nb_sql
from millrace.plans.registry import query, table

# The value threshold that turns an event's value into a hard
# 0/1 prediction.
HARD_THRESHOLD = 100.0


def events_binary(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select((F.col("event_type") == "error").cast("double").alias("label"),
                     F.col("value").alias("score"),
                     (F.col("value") > HARD_THRESHOLD).cast("double").alias("prediction"))


_EVENTS_SQL = f"""(SELECT CAST(event_type = 'error' AS DOUBLE) AS label, value AS score,
                          CAST(value > {HARD_THRESHOLD} AS DOUBLE) AS prediction FROM events)"""


@query("outcome_counts", sql=f"""
SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
       count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
       count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn
FROM {_EVENTS_SQL}
""")
def q_outcome_counts(spark, sf_dir):
    return outcome_counts(events_binary(spark, sf_dir))


@query("auc_hard", sql=f"""
WITH c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
                  count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
                  count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
                  count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn
           FROM {_EVENTS_SQL})
SELECT round((1 + CAST(tp AS DOUBLE) / (tp + fn) - CAST(fp AS DOUBLE) / (fp + tn)) / 2, 12) AS auc
FROM c
""")
def q_auc_hard(spark, sf_dir):
    return auc_hard(events_binary(spark, sf_dir)).select(F.round("auc", 12).alias("auc"))


@query("auc_score", sql=f"""
WITH s AS {_EVENTS_SQL},
r AS (SELECT label, rank() OVER (ORDER BY score)
                    + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS avg_rank FROM s),
t AS (SELECT sum(label) AS p, count(*) - sum(label) AS n,
             sum(avg_rank) FILTER (WHERE label = 1) AS rank_sum FROM r)
SELECT round((rank_sum - p * (p + 1) / 2) / (p * n), 9) AS auc FROM t
""")
def q_auc_score(spark, sf_dir):
    return auc_score(events_binary(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))


@query("auc_pr", sql=f"""
WITH s AS {_EVENTS_SQL},
t AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM s GROUP BY score),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp,
             sum(neg) OVER (ORDER BY score DESC) AS fp FROM t),
tot AS (SELECT sum(pos) AS p FROM t),
pts AS (SELECT score, tp / p AS recall, tp / (tp + fp) AS precision FROM c, tot),
seq AS (SELECT recall, precision,
               lag(recall, 1, 0.0) OVER (ORDER BY score DESC) AS r0,
               lag(precision) OVER (ORDER BY score DESC) AS p0 FROM pts)
SELECT round(sum((recall - r0) * (precision + coalesce(p0, precision)) / 2), 9) AS auc_pr
FROM seq
""")
def q_auc_pr(spark, sf_dir):
    return auc_pr(events_binary(spark, sf_dir)).select(F.round("auc_pr", 9).alias("auc_pr"))


@query("curve_areas", sql=f"""
WITH s AS {_EVENTS_SQL},
t AS (SELECT round(score) AS score, sum(label) AS pos, count(*) - sum(label) AS neg FROM s GROUP BY 1),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER w - pos AS tp0, sum(neg) OVER w - neg AS fp0
      FROM t WINDOW w AS (ORDER BY score DESC))
SELECT round(sum(neg * (tp0 + pos / 2)) / (sum(pos) * sum(neg)), 9) AS auc,
       round(sum(pos * (tp / (tp + fp) + coalesce(tp0 / nullif(tp0 + fp0, 0), tp / (tp + fp))) / 2) / sum(pos), 9) AS auc_pr
FROM c
""")
def q_curve_areas(spark, sf_dir):
    """Both areas from one curve over scores with many ties."""
    rounded = events_binary(spark, sf_dir).withColumn("score", F.round("score"))
    return curve_areas(rounded).select(F.round("auc", 9).alias("auc"), F.round("auc_pr", 9).alias("auc_pr"))


@query("accuracy", sql=nb_sql("""
SELECT avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM scored
"""))
def q_accuracy(spark, sf_dir):
    return accuracy(nb_scored(spark, sf_dir))


_CONFUSION_SQL = """
, k AS (SELECT CAST(greatest(max(label), max(prediction)) AS INTEGER) + 1 AS k FROM scored),
g AS (SELECT CAST(a.i AS DOUBLE) AS label, CAST(b.i AS DOUBLE) AS prediction
      FROM k, LATERAL (SELECT unnest(range(k.k)) AS i) a, LATERAL (SELECT unnest(range(k.k)) AS i) b),
cells AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction)
SELECT g.label, g.prediction, coalesce(cells.n, 0) AS n
FROM g LEFT JOIN cells ON g.label = cells.label AND g.prediction = cells.prediction
"""


@query("confusion_matrix", sql=nb_sql(_CONFUSION_SQL, impute=True))
def q_confusion_matrix(spark, sf_dir):
    """Flagship: impute -> index -> assemble -> Naive Bayes -> confusion."""
    model, df = nb_fit(spark, sf_dir, impute=True)
    classes = range(len(model.stages[-1].pi))
    return confusion_matrix(model.transform(df), dense=True, labels=classes)


@query("precision_recall_f1", sql=nb_sql("""
, cells AS (SELECT label AS l, prediction AS p, count(*) AS n FROM scored GROUP BY 1, 2),
sup AS (SELECT l AS class, CAST(sum(n) AS BIGINT) AS support FROM cells GROUP BY 1),
prd AS (SELECT p AS class, CAST(sum(n) AS BIGINT) AS predicted FROM cells GROUP BY 1),
tp AS (SELECT l AS class, n AS tp FROM cells WHERE l = p),
per AS (SELECT coalesce(sup.class, prd.class) AS class, coalesce(tp.tp, 0) AS tp,
               coalesce(sup.support, 0) AS support, coalesce(prd.predicted, 0) AS predicted
        FROM sup FULL JOIN prd ON sup.class = prd.class
        LEFT JOIN tp ON tp.class = coalesce(sup.class, prd.class)),
m AS (SELECT class, support,
             CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS recall
      FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0
                     THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m),
w AS (SELECT CAST(NULL AS DOUBLE) AS class, sum(precision * support) / sum(support) AS precision,
             sum(recall * support) / sum(support) AS recall, CAST(sum(support) AS BIGINT) AS support,
             sum(f1 * support) / sum(support) AS f1 FROM f)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall,
       support, round(f1, 9) AS f1 FROM f
UNION ALL
SELECT class, round(precision, 9), round(recall, 9), support, round(f1, 9) FROM w
"""))
def q_precision_recall_f1(spark, sf_dir):
    m = per_class_metrics(nb_scored(spark, sf_dir))
    return m.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall")],
                    "support", F.round("f1", 9).alias("f1"))


@query("regression_metrics", sql=nb_sql("""
SELECT round(avg((label - prediction) * (label - prediction)), 9) AS mse,
       round(sqrt(avg((label - prediction) * (label - prediction))), 9) AS rmse,
       round(avg(abs(label - prediction)), 9) AS mae,
       round(1 - sum((label - prediction) * (label - prediction))
                 / sum((label - my) * (label - my)), 9) AS r2,
       round(avg((prediction - my) * (prediction - my)), 9) AS explained_variance
FROM (SELECT label, prediction, avg(label) OVER () AS my FROM scored)
"""))
def q_regression_metrics(spark, sf_dir):
    m = regression_metrics(nb_scored(spark, sf_dir))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("class_totals", sql=nb_sql("""
SELECT coalesce(a.class, b.class) AS class, coalesce(a.n_label, 0) AS n_label,
       coalesce(b.n_predicted, 0) AS n_predicted
FROM (SELECT label AS class, count(*) AS n_label FROM scored GROUP BY 1) a
FULL JOIN (SELECT prediction AS class, count(*) AS n_predicted FROM scored GROUP BY 1) b
  ON a.class = b.class
"""))
def q_class_totals(spark, sf_dir):
    return class_totals(nb_scored(spark, sf_dir))


@query("confusion_cells", sql=f"""
SELECT label, prediction, count(*) AS n FROM {_EVENTS_SQL} GROUP BY label, prediction
""")
def q_confusion_cells(spark, sf_dir):
    """The observed cells alone, for any number of classes."""
    return confusion_matrix(events_binary(spark, sf_dir))
