"""Model fitting, tuning, scoring and persistence with Spark ML.

Every fit below is distributed: Naive Bayes is one aggregation per class,
k-means/LR/MLP iterate tree-aggregated gradient or centre sums, trees grow
from per-node histograms aggregated on executors. Only model parameters
(size bounded by the parameter count, not the data) reach the driver.
Fits read only the columns that their stages name.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.fold_search import naive_bayes_fold_accuracies


def needed_columns(stages: Sequence, df: DataFrame) -> list[str]:
    """The columns of ``df`` that the stages read: their column parameters that name
    one. A stage of an unknown kind keeps all columns."""
    wanted: set[str] = set()
    for stage in stages:
        if not hasattr(stage, "params"):
            return df.columns
        for param in stage.params:
            if param.name.lower().endswith(("col", "cols")) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                wanted |= {value} if isinstance(value, str) else set(value)
    return [c for c in df.columns if c in wanted]


def fit_pipeline(stages: Sequence, df: DataFrame) -> PipelineModel:
    """Fit a pipeline on the columns that it reads. Nothing is persisted here: the
    iterative estimators of Spark ML keep their own training blocks, and a second
    copy of the input would only take their memory."""
    return Pipeline(stages=list(stages)).fit(df.select(*needed_columns(stages, df)))


def naive_bayes(label: str = "label", features: str = "features", smoothing: float = 1.0,
                model_type: str = "multinomial") -> NaiveBayes:
    """Multinomial Naive Bayes (features must be non-negative)."""
    return NaiveBayes(labelCol=label, featuresCol=features, smoothing=smoothing,
                      modelType=model_type)


def kmeans(k: int, seed: int, features: str = "features", max_iter: int = 20,
           prediction: str = "cluster") -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=features, maxIter=max_iter,
                  predictionCol=prediction)


def nearest_centre(vec_col: str, centres: Sequence[Sequence[float]]):
    """Index of the nearest centre (squared Euclidean; first on ties) of an
    ``array<double>`` column, as built-in higher-order functions.

    The centres travel as one constant (a folded ``from_json`` literal of
    k x d doubles, bounded by k and d, not by the data), so the assignment
    runs inside each task with no join and no pairs emitted.
    """
    cs = F.from_json(F.lit(json.dumps([[float(v) for v in c] for c in centres])),
                     "array<array<double>>")
    # the smallest (distance, index): each distance is written and computed once
    by_distance = F.transform(cs, lambda c, i: F.struct(
        F.aggregate(F.zip_with(F.col(vec_col), c, lambda a, b: (a - b) * (a - b)),
                    F.lit(0.0), lambda acc, x: acc + x).alias("distance"), i.alias("index")))
    return F.array_min(by_distance)["index"].cast("int")


def lloyd_step(df: DataFrame, vec_col: str, centres: Sequence[Sequence[float]],
               cluster_col: str = "cluster") -> DataFrame:
    """One k-means (Lloyd) iteration from given centres: assign every vector
    to its nearest centre, then average per cluster. Returns
    ``(cluster, centre array<double>, n)``; the per-cluster mean is a
    partial/final vector aggregate, so a cluster holding most rows is
    reduced per task before the shuffle."""
    assigned = df.select(nearest_centre(vec_col, centres).alias(cluster_col),
                         array_to_vector(F.col(vec_col)).alias("_v"))
    means = assigned.groupBy(cluster_col).agg(Summarizer.mean(F.col("_v")).alias("_m"),
                                              F.count(F.lit(1)).alias("n"))
    return means.select(cluster_col, vector_to_array(F.col("_m")).alias("centre"), "n")


def logistic_regression(label: str = "label", features: str = "features",
                        max_iter: int = 10, reg: float = 0.0,
                        elastic_net: float = 0.0) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=max_iter,
                              regParam=reg, elasticNetParam=elastic_net)


def random_forest(label: str = "label", features: str = "features", num_trees: int = 10,
                  impurity: str = "gini", max_depth: int = 5, max_bins: int = 32,
                  min_info_gain: float = 0.0, subset: str = "auto",
                  seed: int | None = None) -> RandomForestClassifier:
    kw = {"seed": seed} if seed is not None else {}
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees,
                                  impurity=impurity, maxDepth=max_depth, maxBins=max_bins,
                                  minInfoGain=min_info_gain, featureSubsetStrategy=subset, **kw)


def decision_tree(label: str = "label", features: str = "features", max_depth: int = 5,
                  impurity: str = "gini", seed: int | None = None) -> DecisionTreeClassifier:
    kw = {"seed": seed} if seed is not None else {}
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=max_depth,
                                  impurity=impurity, **kw)


def perceptron(layers: Sequence[int], label: str = "label", features: str = "features",
               max_iter: int = 200, block_size: int = 128,
               seed: int | None = None) -> MultilayerPerceptronClassifier:
    kw = {"seed": seed} if seed is not None else {}
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features,
                                          layers=list(layers), maxIter=max_iter,
                                          blockSize=block_size, **kw)


def param_grid(estimator, grid: Mapping[str, Sequence]) -> list:
    """Cartesian grid over named params of ``estimator`` (empty grid = one map)."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def cross_validate(estimator, grid: list, evaluator, df: DataFrame, folds: int = 10,
                   parallelism: int = 4, seed: int = 7, fold_col: str | None = None):
    """k-fold cross validation of a whole pipeline over a parameter grid;
    candidate fits run ``parallelism`` at a time. With ``fold_col`` the rows say
    their fold (0 to folds - 1), so the folds do not depend on how the input is
    partitioned; without it they are drawn from ``seed``. Accuracies of multinomial Naive
    Bayes over smoothings, with ``fold_col``, come from statistics of the folds: three passes in all, the
    best model's fit included, instead of a fit for every fold and map."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                        numFolds=folds, parallelism=parallelism, seed=seed)
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    columns = needed_columns([*stages, evaluator], df)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
        columns += [fold_col] if fold_col not in columns else []
    df = df.select(*columns)
    metrics = _counted_metrics(cv, df) or _fitted_metrics(cv, df)
    means = np.mean(metrics, axis=0)
    best = int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))
    model = CrossValidatorModel(estimator.fit(df, grid[best]), means.tolist(), stdMetrics=np.std(metrics, axis=0).tolist())
    return cv._copyValues(model)


def _counted_metrics(cv: CrossValidator, df: DataFrame) -> list[list[float]] | None:
    """What ``_fitted_metrics`` gives, from statistics of the folds; None unless the search is the
    accuracy of multinomial Naive Bayes over smoothings, with a column of folds."""
    estimator, evaluator, fold = cv.getEstimator(), cv.getEvaluator(), cv.getFoldCol()
    *before, nb = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    if not (fold and isinstance(df.schema[fold].dataType, T.IntegralType) and all(isinstance(x, Transformer) for x in before)
            and isinstance(nb, NaiveBayes) and nb.getModelType() == "multinomial"
            and not nb.isDefined(nb.weightCol) and not nb.isDefined(nb.thresholds)
            and isinstance(evaluator, MulticlassClassificationEvaluator) and evaluator.getMetricName() == "accuracy"
            and not evaluator.isDefined(evaluator.weightCol) and evaluator.getLabelCol() == nb.getLabelCol()
            and evaluator.getPredictionCol() == nb.getPredictionCol()):
        return None
    if any(p != nb.smoothing for params in cv.getEstimatorParamMaps() for p in params):
        return None
    smoothings = [float(params.get(nb.smoothing, nb.getSmoothing())) for params in cv.getEstimatorParamMaps()]
    if min(smoothings) <= 0:
        return None
    for stage in before:
        df = stage.transform(df)
    return naive_bayes_fold_accuracies(df, nb.getLabelCol(), nb.getFeaturesCol(), smoothings, fold, cv.getNumFolds())


def _fitted_metrics(cv: CrossValidator, df: DataFrame) -> list[list[float]]:
    """The metric of every parameter map in every fold, each from a fit of its own.

    As in ``CrossValidator.fit``, but a candidate's thread has local properties of its own. There the
    candidates of a fold share one set (Spark 4.1), so one may take away the execution id that
    another reads ("Cannot parse null string")."""
    estimator, grid, evaluator = cv.getEstimator(), cv.getEstimatorParamMaps(), cv.getEvaluator()

    def candidate(train: DataFrame, validation: DataFrame, params) -> float:
        return evaluator.evaluate(estimator.fit(train, params).transform(validation, params))

    metrics = []
    with ThreadPool(min(cv.getParallelism(), len(grid))) as pool:
        for train, validation in cv._kFold(df):
            train, validation = train.persist(), validation.persist()
            try:
                tasks = [inheritable_thread_target(df.sparkSession)(partial(candidate, train, validation, p)) for p in grid]
                metrics.append(pool.map(lambda task: task(), tasks, chunksize=1))
            finally:
                train.unpersist()
                validation.unpersist()
    return metrics


def accuracy_evaluator(label: str = "label", prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="accuracy")


def auc_evaluator(label: str = "label", raw: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Area under ROC from raw scores, exact (no down-sampling bins)."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw,
                                         metricName="areaUnderROC", numBins=0)


def cv_results(spark: SparkSession, cv_model) -> DataFrame:
    """One row per parameter map: the params (as text) and the mean metric."""
    rows = []
    for pm, metric in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics):
        desc = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((desc, float(metric)))
    schema = T.StructType([T.StructField("params", T.StringType()),
                           T.StructField("avg_metric", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def model_params(spark: SparkSession, model) -> DataFrame:
    """The explicitly set and default params of a fitted model as
    ``(param, value)`` text rows (e.g. ``best_model.stages[-1]``)."""
    rows = [(p.name, str(model.getOrDefault(p))) for p in model.params if model.isDefined(p)]
    schema = T.StructType([T.StructField("param", T.StringType()),
                           T.StructField("value", T.StringType())])
    return spark.createDataFrame(sorted(rows), schema)


def tree_rules(spark: SparkSession, tree_model) -> DataFrame:
    """The rule text of a fitted tree, one line per row."""
    lines = tree_model.toDebugString.splitlines()
    return spark.createDataFrame([(i, s) for i, s in enumerate(lines)],
                                 "line_no INT, rule STRING")


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model, df: DataFrame) -> DataFrame:
    """Apply a fitted model (batch or streaming frame)."""
    return model.transform(df)


def probability_of(col: str = "probability", index: int = 1):
    """One class probability out of the probability vector."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[index]
