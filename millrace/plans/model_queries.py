"""Model queries: Naive Bayes (closed form, SQL-checked), k-means, logistic
regression, trees, perceptron, cross validation, persistence, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.features import assembler, scaler, to_vector
from millrace.operators.models import (accuracy_evaluator, cross_validate, cv_results,
                                       decision_tree, fit_pipeline, kmeans, lloyd_step,
                                       load_model, logistic_regression, model_params, naive_bayes,
                                       nearest_centre, param_grid, perceptron, probability_of,
                                       random_forest, save_model, tree_rules)
from millrace.operators.evaluation import accuracy
from millrace.operators.sampling import tag_split, union_all
from millrace.plans.column_queries import LINE_KEYS, split_sql
from millrace.plans.lineitem_nb import NB_FEATURES, nb_fit, nb_input, nb_scored, nb_sql
from millrace.plans.registry import query, table
from millrace.session import shared_path


@query("naive_bayes_params", sql=nb_sql("""
SELECT c AS label, round(pi, 9) AS pi, round(t0, 9) AS theta_0, round(t1, 9) AS theta_1,
       round(t2, 9) AS theta_2, round(t3, 9) AS theta_3 FROM par
"""))
def q_naive_bayes_params(spark, sf_dir):
    model, _ = nb_fit(spark, sf_dir)
    nb = model.stages[-1]
    theta = nb.theta.toArray()
    # K x F parameters (bounded by the model, not the data)
    rows = [(float(c), float(nb.pi[c]), *[float(t) for t in theta[c]]) for c in range(len(nb.pi))]
    cols = ["label", "pi"] + [f"theta_{i}" for i in range(theta.shape[1])]
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in cols])
    params = spark.createDataFrame(rows, schema)
    return params.select("label", *[F.round(c, 9).alias(c) for c in cols[1:]])


@query("naive_bayes_predict", sql=nb_sql("""
SELECT l_orderkey, l_linenumber, l_returnflag, label, prediction FROM scored
"""))
def q_naive_bayes_predict(spark, sf_dir):
    return nb_scored(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_returnflag",
                                           "label", "prediction")


@query("score_unlabelled", sql=nb_sql("""
SELECT l_orderkey, l_linenumber, prediction FROM scored
"""))
def q_score_unlabelled(spark, sf_dir):
    model, df = nb_fit(spark, sf_dir)
    unlabelled = df.drop("l_returnflag")  # the indexer stage is skipped
    return model.transform(unlabelled).select("l_orderkey", "l_linenumber", "prediction")


@query("model_round_trip", sql=nb_sql("""
SELECT l_orderkey, l_linenumber, label, prediction FROM scored
"""))
def q_model_round_trip(spark, sf_dir):
    model, df = nb_fit(spark, sf_dir)
    path = save_model(model, shared_path(spark, "nb-model"))
    return load_model(path).transform(df).select("l_orderkey", "l_linenumber", "label",
                                                 "prediction")


# --- k-means ---------------------------------------------------------------

KMEANS_K = 4


def embedding_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double"))
                    .alias("embedding"))


@query("kmeans_step", sql=f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cid, v AS ce FROM e
      ORDER BY vec_id LIMIT {KMEANS_K}),
d AS (SELECT e.vec_id, c.cid,
             list_sum(list_transform(range(len(e.v)), lambda i: (e.v[i + 1] - c.ce[i + 1]) * (e.v[i + 1] - c.ce[i + 1]))) AS dist
      FROM e, c),
a AS (SELECT vec_id, arg_min(cid, dist) AS cluster FROM d GROUP BY vec_id),
x AS (SELECT a.cluster, unnest(range(len(e.v))) AS dim, unnest(e.v) AS val
      FROM a JOIN e USING (vec_id))
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(dim AS INTEGER) AS dim,
       round(avg(val), 6) AS centre, count(*) AS n
FROM x GROUP BY cluster, dim
""")
def q_kmeans_step(spark, sf_dir):
    """One Lloyd step from fixed starting centres (the k lowest ids): assign
    each vector to its nearest centre, then average per cluster."""
    e = embedding_vectors(spark, sf_dir)
    # k rows, k fixed: a bounded read to the driver.
    centres = [r["embedding"] for r in e.orderBy("vec_id").limit(KMEANS_K).collect()]
    step = lloyd_step(e, "embedding", centres)
    return (step.select("cluster", F.posexplode("centre").alias("dim", "centre"), "n")
            .select("cluster", "dim", F.round("centre", 6).alias("centre"), "n"))


@query("kmeans_assign", note="rows only: k-means++ initialisation has no SQL form")
def q_kmeans_assign(spark, sf_dir):
    e = embedding_vectors(spark, sf_dir).withColumn("features", to_vector("embedding"))
    model = fit_pipeline([kmeans(k=10, seed=1, features="features")], e)
    return model.transform(e).select("vec_id", "label", "cluster")


@query("kmeans_nearest", sql="SELECT vec_id, true AS nearest FROM embeddings")
def q_kmeans_nearest(spark, sf_dir):
    """Every vector's cluster is the one with the nearest of the fitted centres."""
    e = embedding_vectors(spark, sf_dir).withColumn("features", to_vector("embedding"))
    model = fit_pipeline([kmeans(k=10, seed=1, features="features")], e)
    centres = [c.tolist() for c in model.stages[-1].clusterCenters()]  # k x d numbers
    return model.transform(e).select("vec_id", (F.col("cluster") == nearest_centre("embedding", centres))
                                     .alias("nearest"))


# --- supervised models on a label with signal --------------------------------

SIGNAL_SQL = "l_quantity + 200 * l_discount + pmod(l_orderkey * 7919, 20) > 45"


def signal_frame(spark, sf_dir, seed: int = 24):
    """lineitem with a binary label that depends on the features plus
    key-based noise, tagged train (80%) / test (20%)."""
    li = nb_input(spark, sf_dir).drop("l_returnflag")
    label = F.expr(SIGNAL_SQL).cast("double")
    return tag_split(li.withColumn("label", label), [0.8, 0.2], seed, ["train", "test"], keys=LINE_KEYS)


def _fit_and_score(spark, sf_dir, estimator):
    df = signal_frame(spark, sf_dir)
    stages = [assembler(NB_FEATURES, "raw"), scaler("raw", "features"), estimator]
    model = fit_pipeline(stages, df.filter(F.col("split") == "train"))
    scored = model.transform(df)
    return scored.select("l_orderkey", "l_linenumber", "split", "label", "prediction",
                         probability_of("probability", 1).alias("p1"))


@query("logistic_regression", note="rows only: iterative fit")
def q_logistic_regression(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, logistic_regression(max_iter=10))


@query("random_forest", note="rows only: randomised trees")
def q_random_forest(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, random_forest(num_trees=10, max_depth=5, seed=24))


@query("decision_tree", note="rows only")
def q_decision_tree(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, decision_tree(max_depth=5, seed=24))


NETS = ([4, 8, 2], [4, 8, 6, 2])  # one and two hidden layers


@query("multilayer_perceptron", note="rows only: iterative fit")
def q_multilayer_perceptron(spark, sf_dir):
    nets = [_fit_and_score(spark, sf_dir, perceptron(layers, max_iter=200, seed=24))
            .withColumn("net", F.lit("-".join(map(str, layers)))) for layers in NETS]
    return union_all(nets)


LR_TERMS = ["intercept", *NB_FEATURES]


@query("logistic_gradient", sql="SELECT unnest([" + ", ".join(f"'{t}'" for t in LR_TERMS)
       + "]) AS term, true AS at_optimum")
def q_logistic_gradient(spark, sf_dir):
    """At the optimum of an unregularised fit the gradient of the mean log loss over
    the training rows is zero in every term."""
    train = signal_frame(spark, sf_dir).filter(F.col("split") == "train")
    lr = logistic_regression(max_iter=300).setTol(1e-12)
    model = fit_pipeline([assembler(NB_FEATURES, "features"), lr], train)
    off = probability_of("probability", 1) - F.col("label")
    slopes = [F.avg(off * (F.lit(1.0) if t == "intercept" else F.col(t))).alias(t) for t in LR_TERMS]
    gradient = model.transform(train).agg(*slopes)
    return gradient.select(F.inline(F.array(*[F.struct(F.lit(t).alias("term"), (F.abs(F.col(t)) < 1e-5)
                                                       .alias("at_optimum")) for t in LR_TERMS])))


@query("tree_rules", note="rows only: the rule text of a fitted tree")
def q_tree_rules(spark, sf_dir):
    train = signal_frame(spark, sf_dir).filter(F.col("split") == "train")
    model = fit_pipeline([assembler(NB_FEATURES, "features"), decision_tree(max_depth=3, seed=24)], train)
    return tree_rules(spark, model.stages[-1])


# --- cross validation ---------------------------------------------------------

FOLDS = 10
SMOOTHING = [0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0, 100.0, 1000.0, 10000.0, 100000.0]


def _cv_model(spark, sf_dir):
    """Naive Bayes over 12 smoothings, 10 folds by key, accuracy; with the test rows."""
    df = signal_frame(spark, sf_dir).withColumn("fold", F.expr("CAST(pmod(l_orderkey, 10) AS INT)"))
    nb = naive_bayes()
    pipe = Pipeline(stages=[assembler(NB_FEATURES, "features"), nb])
    grid = param_grid(nb, {"smoothing": SMOOTHING})
    model = cross_validate(pipe, grid, accuracy_evaluator(), df.filter(F.col("split") == "train"), folds=FOLDS,
                           parallelism=8, fold_col="fold")
    return model, df.filter(F.col("split") == "test")


def cv_sql(final: str) -> str:
    """Closed form of the whole search. ``m`` has the mean fold accuracy of each
    smoothing, ``best`` the first one with the highest, ``held`` its accuracy on the
    test rows after a fit on all training rows."""
    values = ", ".join(f"({i}, CAST({x!r} AS DOUBLE))" for i, x in enumerate(SMOOTHING))
    thetas = ", ".join(f"ln(s{i} + s) - ln(s0 + s1 + s2 + s3 + 4 * s) AS t{i}" for i in range(4))
    score = "pi + t0 * f0 + t1 * f1 + t2 * f2 + t3 * f3"
    sums = ", ".join(f"sum(f{i}) AS s{i}" for i in range(4))
    return f"""
WITH tagged AS ({split_sql(24, [0.8, 0.2], ["train", "test"], ", ".join(LINE_KEYS), "lineitem", "*")}),
d AS (SELECT row_number() OVER () AS rid, split, l_orderkey % {FOLDS} AS fold,
             CASE WHEN l_quantity + 200 * l_discount + (l_orderkey * 7919) % 20 > 45 THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
             l_quantity AS f0, l_discount AS f1, l_tax AS f2, CAST(l_linenumber AS DOUBLE) AS f3
      FROM tagged),
g(idx, s) AS (VALUES {values}),
k AS (SELECT unnest(range({FOLDS} + 1)) AS k),
cls AS (SELECT k, label AS c, count(*) AS n, {sums} FROM d, k
        WHERE split = 'train' AND fold <> k GROUP BY k, label),
tot AS (SELECT k, sum(n) AS nn, count(*) AS kk FROM cls GROUP BY k),
par AS (SELECT k, idx, c, ln(n + s) - ln(nn + kk * s) AS pi, {thetas} FROM cls JOIN tot USING (k), g),
hit AS (SELECT k, idx, rid, arg_max(c, {score}) = any_value(label) AS ok FROM d JOIN par
        ON split = 'train' AND fold = k GROUP BY k, idx, rid),
m AS (SELECT idx, s, avg(acc) AS avg_metric
      FROM (SELECT k, idx, avg(CAST(ok AS DOUBLE)) AS acc FROM hit GROUP BY k, idx) JOIN g USING (idx) GROUP BY idx, s),
best AS (SELECT idx, s FROM m ORDER BY round(avg_metric, 12) DESC, idx LIMIT 1),
held AS (SELECT avg(CAST(ok AS DOUBLE)) AS accuracy
         FROM (SELECT rid, arg_max(c, {score}) = any_value(label) AS ok
               FROM d JOIN par ON split = 'test' AND k = {FOLDS} JOIN best USING (idx) GROUP BY rid))
{final}
"""


@query("cross_validate", sql=cv_sql("SELECT 'smoothing=' || CAST(s AS VARCHAR) AS params, "
                                    "round(avg_metric, 9) AS avg_metric FROM m"))
def q_cross_validate(spark, sf_dir):
    model, _ = _cv_model(spark, sf_dir)
    return cv_results(spark, model).select("params", F.round("avg_metric", 9).alias("avg_metric"))


@query("best_model_params", sql=cv_sql("""
SELECT * FROM (VALUES ('featuresCol', 'features'), ('labelCol', 'label'), ('modelType', 'multinomial'),
                      ('predictionCol', 'prediction'), ('probabilityCol', 'probability'),
                      ('rawPredictionCol', 'rawPrediction')) v(param, value)
UNION ALL SELECT 'smoothing', CAST(s AS VARCHAR) FROM best
"""))
def q_best_model_params(spark, sf_dir):
    model, _ = _cv_model(spark, sf_dir)
    return model_params(spark, model.bestModel.stages[-1])


@query("best_model_held_out", sql=cv_sql("SELECT round(accuracy, 9) AS accuracy FROM held"))
def q_best_model_held_out(spark, sf_dir):
    """The best model, fitted on all training rows, on the rows kept out of the search."""
    model, test = _cv_model(spark, sf_dir)
    return accuracy(model.transform(test)).select(F.round("accuracy", 9).alias("accuracy"))
