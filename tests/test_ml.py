import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from millrace.operators.evaluation import (accuracy, auc_hard, auc_pr, auc_score,
                                           confusion_matrix, per_class_metrics,
                                           regression_metrics)
from millrace.operators.features import (bucketize, index_category, normalize, one_hot,
                                         to_array, to_vector)
from millrace.operators.models import load_model, save_model, tree_rules
from millrace.plans import model_queries as mq
from millrace.plans.feature_queries import FARE_SPLITS


def test_indexer_frequency_then_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacd"], "c string")
    got = {r.c: r.i for r in index_category(df, ["c"], ["i"]).collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}


def test_one_hot_drops_last(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "i double")
    got = [r.a for r in one_hot(df, ["i"], ["v"]).select(to_array("v").alias("a")).collect()]
    assert got == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_bucketize_edges_and_null(spark):
    df = spark.createDataFrame([(0.0,), (9.99,), (10.0,), (40.0,), (1e9,), (None,)], "f double")
    got = [r.b for r in bucketize(df, "f", "b", FARE_SPLITS).collect()]
    assert got == [0.0, 0.0, 1.0, 4.0, 4.0, None]


def test_normalize_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1.0, 3.0],)], "a array<double>").select(
        to_vector("a").alias("v"))
    got = [r.a for r in normalize(df, "v", "n").select(to_array("n").alias("a")).collect()]
    assert got == [[0.0, 0.0], [0.25, 0.75]]


def _held_out(df):
    test = df.filter(F.col("split") == "test")
    acc = accuracy(test).first()[0]
    auc = auc_score(test, score="p1").first()[0]
    return acc, auc


def test_supervised_models_meet_floors(spark):
    for fn in (mq.q_logistic_regression, mq.q_random_forest, mq.q_decision_tree,
               mq.q_multilayer_perceptron):
        acc, auc = _held_out(fn(spark, SF01).cache())
        assert acc >= 0.85 and auc >= 0.88, (fn.__name__, acc, auc)


def test_kmeans_rows_nearest_centre(spark):
    e = mq.embedding_vectors(spark, SF01).withColumn("features", mq.to_vector("embedding"))
    model = mq.fit_pipeline([mq.kmeans(k=10, seed=1, features="features")], e)
    centres = np.array(model.stages[-1].clusterCenters())
    for r in model.transform(e).select("embedding", "cluster").collect():
        d = ((centres - np.array(r.embedding)) ** 2).sum(axis=1)
        assert d[r.cluster] <= d.min() + 1e-9


def test_folds_by_column_do_not_depend_on_the_partitions(spark):
    from pyspark.ml import Pipeline

    from millrace.operators.models import accuracy_evaluator, cross_validate, naive_bayes, param_grid
    df = mq.signal_frame(spark, "/root/testdata/sf0.001").withColumn("fold", F.expr("CAST(pmod(l_orderkey, 3) AS INT)"))
    nb = naive_bayes()
    pipe, grid = Pipeline(stages=[mq.assembler(mq.NB_FEATURES, "features"), nb]), param_grid(nb, {"smoothing": [0.1, 1.0]})
    scores = [cross_validate(pipe, grid, accuracy_evaluator(), df.repartition(n), folds=3, fold_col="fold").avgMetrics
              for n in (1, 5)]
    assert np.allclose(scores[0], scores[1], atol=1e-12) and len(scores[0]) == 2


def test_confusion_matrix_of_many_classes(spark):
    df = spark.range(15000).selectExpr("CAST(id % 5000 AS DOUBLE) AS label", "CAST(id % 4999 AS DOUBLE) AS prediction")
    cells = confusion_matrix(df)
    assert cells.agg(F.sum("n")).first()[0] == 15000
    assert cells.select("label").distinct().count() == 5000


def test_regression_metrics_with_a_large_offset(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    for offset in (0.0, 1e9):
        label = F.lit(offset) + F.col("id") % 2
        off = F.when(F.col("id") % 10 == 0, 0.5).otherwise(0.0)
        df = spark.range(1000).select(label.alias("label"), (label + off).alias("prediction"))
        ours = regression_metrics(df).first()
        assert abs(ours.r2 - 0.9) < 1e-9 and abs(ours.mse - 0.025) < 1e-9
        y = np.array([i % 2 for i in range(1000)])
        p = y + np.where(np.arange(1000) % 10 == 0, 0.5, 0)
        assert abs(ours.explained_variance - ((p - y.mean()) ** 2).mean()) < 1e-8  # a double at 1e9 ends at 1e-7
        for name, key in (("mse", "mse"), ("r2", "r2"), ("mae", "mae")):
            assert abs(ours[key] - RegressionEvaluator(metricName=name).evaluate(df)) < 1e-9, (offset, name)


def test_areas_skip_missing_scores_and_read_vectors(spark):
    from pyspark.ml.functions import array_to_vector
    rows = [(1.0, 0.9), (0.0, 0.8), (1.0, 0.3), (0.0, 0.1)]
    df = spark.createDataFrame(rows + [(1.0, None), (None, 0.5)], "label double, score double")
    plain = spark.createDataFrame(rows, "label double, score double")
    assert auc_score(df).first() == auc_score(plain).first() and auc_pr(df).first() == auc_pr(plain).first()
    vectors = plain.select("label", array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("rawPrediction"))
    assert auc_score(vectors, score="rawPrediction").first() == auc_score(plain).first()


def test_model_save_load_same_scores(spark, scratch):
    from millrace.plans.lineitem_nb import nb_fit
    model, df = nb_fit(spark, "/root/testdata/sf0.001")
    path = save_model(model, scratch("m"))
    a = model.transform(df).select("prediction").collect()
    b = load_model(path).transform(df).select("prediction").collect()
    assert a == b


def test_tree_rules_text(spark):
    df = mq.signal_frame(spark, "/root/testdata/sf0.001")
    from millrace.operators.features import assembler
    from millrace.operators.models import decision_tree, fit_pipeline
    model = fit_pipeline([assembler(mq.NB_FEATURES, "features"), decision_tree(max_depth=2)], df)
    rules = [r.rule for r in tree_rules(spark, model.stages[-1]).collect()]
    assert rules[0].startswith("DecisionTreeClassificationModel") and any("If" in r for r in rules)


def test_evaluation_small(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.9), (0.0, 1.0, 0.8), (1.0, 0.0, 0.3), (0.0, 0.0, 0.1)],
                               "label double, prediction double, score double")
    assert auc_hard(df).first().auc == 0.5
    assert abs(auc_score(df).first().auc - 0.75) < 1e-12
    assert 0 < auc_pr(df).first().auc_pr <= 1
    cm = {(r.label, r.prediction): r.n for r in confusion_matrix(df, dense=True, labels=range(3)).collect()}
    assert len(cm) == 9 and cm[(1.0, 1.0)] == 1 and cm[(2.0, 2.0)] == 0
    m = regression_metrics(df).first()
    assert abs(m.mse - 0.5) < 1e-12 and abs(m.mae - 0.5) < 1e-12 and abs(m.r2 - (-1.0)) < 1e-12
    pc = {r["class"]: r for r in per_class_metrics(df).collect()}
    assert pc[1.0].precision == 0.5 and pc[None].support == 4


def test_auc_hard_single_class_raises(spark):
    import pytest
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "label double, prediction double")
    with pytest.raises(Exception, match="single class"):
        auc_hard(df).collect()
    assert auc_hard(df, require_both_classes=False).first().auc is None


def test_metrics_equal_mllib_evaluators(spark):
    from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                       MulticlassClassificationEvaluator, RegressionEvaluator)
    from millrace.plans.lineitem_nb import nb_scored
    scored = nb_scored(spark, "/root/testdata/sf0.001").select("label", "prediction").cache()
    ours = regression_metrics(scored).first()
    for name, key in (("mse", "mse"), ("rmse", "rmse"), ("mae", "mae"), ("r2", "r2"),
                      ("var", "explained_variance")):
        ref = RegressionEvaluator(metricName=name).evaluate(scored)
        assert abs(ours[key] - ref) < 1e-9, name
    weighted = [r for r in per_class_metrics(scored).collect() if r["class"] is None][0]
    mc = lambda m: MulticlassClassificationEvaluator(metricName=m).evaluate(scored)
    assert abs(weighted.precision - mc("weightedPrecision")) < 1e-12
    assert abs(weighted.recall - mc("weightedRecall")) < 1e-12
    assert abs(weighted.f1 - mc("f1")) < 1e-12
    assert abs(accuracy(scored).first().accuracy - mc("accuracy")) < 1e-12
    binary = scored.select((F.col("label") == 0).cast("double").alias("label"),
                           (F.col("prediction") == 0).cast("double").alias("prediction"))
    ref_auc = BinaryClassificationEvaluator(rawPredictionCol="prediction",
                                            numBins=0).evaluate(binary)
    assert abs(auc_hard(binary).first().auc - ref_auc) < 1e-12
    scored.unpersist()


def test_layer_grid_gives_one_net_per_option(spark):
    from millrace.operators.models import param_grid, perceptron
    mlp = perceptron([4, 8, 2])
    hidden = [35, 32]  # one hidden layer each: two candidate nets, not one deep net
    grid = param_grid(mlp, {"layers": [[4, h, 2] for h in hidden], "maxIter": [200],
                            "blockSize": [128]})
    assert len(grid) == 2
    assert sorted(pm[mlp.getParam("layers")][1] for pm in grid) == [32, 35]
    assert len(param_grid(mlp, {})) == 1  # the empty grid is one (default) map


def test_assembler_nulls_and_unseen_categories(spark):
    import pytest
    from millrace.operators.features import assemble, indexer
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception):
        assemble(df, ["a", "b"], "v").collect()
    assert assemble(df, ["a", "b"], "v", handle_invalid="skip").count() == 1
    kept = assemble(df, ["a", "b"], "v", handle_invalid="keep").select(to_array("v").alias("x"))
    assert any(x != x for r in kept.collect() for x in r.x)  # NaN for the null
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("z",), (None,)], "c string")
    with pytest.raises(Exception):
        indexer(["c"], ["i"]).fit(train).transform(test).collect()
    got = [r.i for r in indexer(["c"], ["i"], handle_invalid="keep").fit(train)
           .transform(test).collect()]
    assert got == [2.0, 2.0]  # unseen and null go to the extra index K


def test_confusion_orientation_and_positive_cells(spark):
    from millrace.operators.evaluation import outcome_counts
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 0.0), (0.0, 1.0), (1.0, 1.0)],
                               "label double, prediction double")
    cm = {(r.label, r.prediction): r.n for r in confusion_matrix(df, dense=True, labels=[0, 1]).collect()}
    assert cm == {(0.0, 0.0): 0, (0.0, 1.0): 1, (1.0, 0.0): 2, (1.0, 1.0): 1}  # rows = actual
    one = outcome_counts(df).first()
    assert (one.tp, one.fp, one.fn, one.tn) == (1, 1, 2, 0)
    zero = outcome_counts(df, positive=0.0).first()  # correct 0-predictions are tn for 1, tp for 0
    assert (zero.tp, zero.fp, zero.fn, zero.tn) == (0, 2, 1, 1)


def test_perceptron_grid_is_not_self_evaluated(spark):
    from pyspark.ml import Pipeline
    from millrace.operators.features import assembler
    from millrace.operators.models import auc_evaluator, cross_validate, param_grid, perceptron
    df = mq.signal_frame(spark, "/root/testdata/sf0.001")
    mlp = perceptron([4, 3, 2], max_iter=20, seed=1)
    pipe = Pipeline(stages=[assembler(mq.NB_FEATURES, "raw"), mq.scaler("raw", "features"), mlp])
    grid = param_grid(mlp, {"layers": [[4, 3, 2], [4, 5, 2]]})
    ev = auc_evaluator()
    assert ev.getRawPredictionCol() == "rawPrediction"
    cv = cross_validate(pipe, grid, ev, df, folds=2, parallelism=2)
    assert all(m < 1.0 for m in cv.avgMetrics)  # scored on raw predictions, not the label


def test_logistic_regression_matches_newton_on_fixture(spark):
    from millrace.operators.features import assembler
    from millrace.operators.models import fit_pipeline, logistic_regression
    df = mq.signal_frame(spark, "/root/testdata/sf0.001").select(*mq.NB_FEATURES, "label")
    lr = logistic_regression(max_iter=200)
    lr.setTol(1e-10)
    model = fit_pipeline([assembler(mq.NB_FEATURES, "features"), lr], df).stages[-1]
    pdf = df.toPandas()  # small fixture: brute force on the driver is the reference
    x = np.column_stack([np.ones(len(pdf))] + [pdf[c].to_numpy(float) for c in mq.NB_FEATURES])
    y = pdf["label"].to_numpy(float)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (y - p)
        hess = x.T @ (x * (p * (1 - p))[:, None])
        w += np.linalg.solve(hess, grad)
    spark_w = np.concatenate([[model.intercept], model.coefficients.toArray()])
    assert np.allclose(spark_w, w, rtol=1e-3, atol=1e-3), (spark_w, w)


def test_metric_edge_cases_after_review(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, None), (None, 2.0)],
                               "label double, prediction double")
    m = regression_metrics(df).first()  # only the complete pair (1, 1) counts
    assert (m.mse, m.mae) == (0.0, 0.0)
    nan = spark.createDataFrame([(0.0, 0.0), (1.0, float("nan"))], "label double, prediction double")
    cells = {(r.label, r.prediction): r.n for r in confusion_matrix(nan, dense=True, labels=[0, 1]).collect()
             if r.prediction == r.prediction}
    assert cells[(0.0, 0.0)] == 1 and cells[(1.0, 1.0)] == 0 and len(cells) == 4
    assert confusion_matrix(nan, dense=True, labels=[0, 1]).count() == 5  # the NaN cell is still reported
    nulls = spark.createDataFrame([(0.0, 0.0), (None, 1.0)], "label double, prediction double")
    rows = per_class_metrics(nulls).collect()
    assert sum(1 for r in rows if r["class"] is None) == 1  # only the weighted summary
