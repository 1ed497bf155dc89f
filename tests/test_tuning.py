import math
import threading

import pytest
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param
from pyspark.sql import functions as F

from conftest import SF001
from millrace.operators import models
from millrace.operators.fold_search import fold_statistics, naive_bayes_search
from millrace.operators.models import cross_validate, decision_tree
from millrace.operators.tree_splits import tree_splits
from millrace.plans import queries
from millrace.plans.lineitem_nb import NB_FEATURES
from millrace.plans.model_queries import signal_frame

ROWS = "fold int, label double, a double, b double, models string, x string"


def frame(spark, rows):
    # columns whose names the operators use inside
    return spark.createDataFrame([(*r, "m", "x") for r in rows], ROWS)


def plain_accuracy(rows, smoothing):
    """Accuracy by fold of models fitted on the other folds."""
    means = []
    for fold in sorted({r[0] for r in rows}):
        train, test = [r for r in rows if r[0] != fold], [r for r in rows if r[0] == fold]
        labels, hits = sorted({r[1] for r in train}), 0
        for r in test:
            def score(c):
                mine = [t for t in train if t[1] == c]
                sums = [sum(t[i] for t in mine) for i in (2, 3)]
                prior = math.log(len(mine) + smoothing) - math.log(len(train) + len(labels) * smoothing)
                return prior + sum(v * (math.log(s + smoothing) - math.log(sum(sums) + 2 * smoothing))
                                   for v, s in zip(r[2:], sums))
            hits += max(labels, key=lambda c: (score(c), -c)) == r[1]
        means.append(hits / len(test))
    return sum(means) / len(means)


def test_search_is_that_of_separate_fits(spark):
    rows = [(i % 4, float(i * 7 % 3), float(i * 5 % 11), float(i * 3 % 7)) for i in range(60)]
    rows += [(0, 5.0, 3.0, 1.0)] * 3  # a class that only one fold has; repeated rows
    found = naive_bayes_search(frame(spark, rows), "label", ["a", "b"], [0.1, 1.0, 30.0], "fold")
    got = {r.smoothing: r.avg_metric for r in found.collect()}
    assert got == pytest.approx({s: plain_accuracy(rows, s) for s in (0.1, 1.0, 30.0)}, abs=1e-12)


def test_search_leaves_incomplete_rows_out(spark):
    rows = [(i % 2, float(i % 3), float(i), 1.0) for i in range(12)]
    bad = [(None, 1.0, 1.0, 1.0), (0, None, 1.0, 1.0), (0, 1.0, None, 1.0), (0, 1.0, float("nan"), 1.0)]
    whole, more = (naive_bayes_search(frame(spark, r), "label", ["a", "b"], [1.0], "fold").collect()
                   for r in (rows, rows + bad))
    assert whole == more
    assert fold_statistics(frame(spark, rows + bad), "label", ["a", "b"], "fold").agg(F.sum("n")).first()[0] == 12


def test_search_of_nothing_and_of_wrong_input(spark):
    assert [r.avg_metric for r in naive_bayes_search(frame(spark, []), "label", ["a"], [1.0, 2.0], "fold").collect()] == [None, None]
    with pytest.raises(ValueError):
        naive_bayes_search(frame(spark, []), "label", ["a"], [0.0], "fold")
    with pytest.raises(Exception, match="not negative"):
        naive_bayes_search(frame(spark, [(0, 1.0, -1.0, 0.0), (1, 1.0, 1.0, 0.0)]), "label", ["a"], [1.0], "fold").collect()


def impurity(labels, kind):
    shares = [labels.count(c) / len(labels) for c in set(labels)]
    return 1 - sum(p * p for p in shares) if kind == "gini" else -sum(p * math.log2(p) for p in shares)


def plain_tree(rows, depth, kind, node=1):
    options = []
    for f in (0, 1):
        values = sorted({r[1][f] for r in rows})
        for low, high in zip(values, values[1:]):
            t = (low + high) / 2
            sides = [[r for r in rows if (r[1][f] <= t) == first] for first in (True, False)]
            gain = impurity([r[0] for r in rows], kind) - sum(
                len(s) / len(rows) * impurity([r[0] for r in s], kind) for s in sides)
            options.append((-round(gain, 12), f, t, gain, sides))
    if not depth or not options or min(o[:3] for o in options)[0] >= 0:
        return []
    _, f, t, gain, sides = min(options, key=lambda o: o[:3])
    return sorted([(node, f, t, round(gain, 9), len(rows)), *plain_tree(sides[0], depth - 1, kind, 2 * node),
                   *plain_tree(sides[1], depth - 1, kind, 2 * node + 1)])


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_tree_is_that_of_plain_search(spark, kind):
    # values of both signs over many ranges, with zero, ties and repeated rows; three classes
    rows = [(float(i * i % 3 if i % 5 else 2), ((i * 37 % 101 - 50) * 10.0 ** (i % 3), float(i * 11 % 6))) for i in range(150)]
    rows += rows[:40]
    df = spark.createDataFrame([(y, *x, "n") for y, x in rows] + [(None, 1.0, 1.0, "n"), (1.0, float("nan"), 1.0, "n")],
                               "label double, a double, b double, node string")
    got = tree_splits(df, "label", ["a", "b"], [0.0, 1.0, 2.0], 3, kind).collect()
    assert [(r.node, r.feature, r.threshold, round(r.gain, 9), r.n) for r in got] == plain_tree(rows, 3, kind)


def test_tree_without_splits(spark):
    schema = "label double, a double"
    assert tree_splits(spark.createDataFrame([], schema), "label", ["a"], [0.0, 1.0], 2).count() == 0
    assert tree_splits(spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], schema), "label", ["a"], [0.0, 1.0], 2).count() == 0
    with pytest.raises(Exception, match="not among the classes"):
        tree_splits(spark.createDataFrame([(7.0, 1.0), (0.0, 2.0)], schema), "label", ["a"], [0.0, 1.0], 1)


def test_root_is_that_of_the_fitted_tree(spark):
    train = signal_frame(spark, SF001).where("split = 'train'")
    found = tree_splits(train, "label", NB_FEATURES, [0.0, 1.0], 1).first()
    tree = decision_tree(max_depth=1).setMaxBins(128).fit(VectorAssembler(inputCols=NB_FEATURES, outputCol="features").transform(train))
    root = tree._call_java("rootNode")
    assert found.feature == root.split().featureIndex()
    assert found.threshold == pytest.approx(root.split().threshold())
    assert found.gain == pytest.approx(root.gain(), abs=1e-9)


class Plain(Model):
    def _transform(self, dataset):
        return dataset


class Both(Estimator):
    """Each of two fits sets a local property and reads it when the other has set its own."""
    here, got = threading.Barrier(2, timeout=60), []

    def __init__(self):
        super().__init__()
        self.mine = Param(self, "mine", "")

    def _fit(self, dataset):
        mine, context = self.getOrDefault(self.mine), dataset.sparkSession.sparkContext
        if threading.current_thread() is not threading.main_thread():
            context.setLocalProperty("millrace.mine", mine)
            self.here.wait()
            self.got.append((mine, context.getLocalProperty("millrace.mine")))
        return Plain()


class One(Evaluator):
    def _evaluate(self, dataset):
        return 1.0


def test_candidates_of_a_fold_do_not_share_local_properties(spark):
    both = Both()
    df = spark.createDataFrame([(k % 2,) for k in range(8)], "fold int")
    cross_validate(both, [{both.mine: "a"}, {both.mine: "b"}], One(), df, folds=2, parallelism=2, fold_col="fold")
    assert sorted(both.got) == [("a", "a")] * 2 + [("b", "b")] * 2


def search_of(rows, spark, smoothings=(0.1, 1.0, 30.0), folds=4):
    """The search over rows, and that by separate fits."""
    nb = models.naive_bayes()
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), nb])
    grid = models.param_grid(nb, {"smoothing": list(smoothings)})
    df = frame(spark, rows)

    def run():
        return cross_validate(pipe, grid, models.accuracy_evaluator(), df, folds=folds, fold_col="fold")

    counted = run()
    with pytest.MonkeyPatch.context() as m:
        m.setattr(models, "_counted_metrics", lambda cv, df: None)
        return counted, run()


def test_cross_validation_of_naive_bayes_is_that_of_fits(spark):
    rows = [(i % 4, float(i * 7 % 3), float(i * 5 % 11), float(i * 3 % 7)) for i in range(60)]
    rows += [(1, 2.0, 5.0, 3.0)] * 9  # repeated rows
    counted, fitted = search_of(rows, spark)
    assert counted.avgMetrics == pytest.approx(fitted.avgMetrics, abs=1e-12)
    assert counted.avgMetrics == pytest.approx([plain_accuracy(rows, s) for s in (0.1, 1.0, 30.0)], abs=1e-12)
    assert counted.stdMetrics == pytest.approx(fitted.stdMetrics, abs=1e-12)
    best, other = (m.bestModel.stages[-1] for m in (counted, fitted))
    assert best.getSmoothing() == other.getSmoothing() and best.pi == other.pi


def test_the_queries_search_without_fits_by_fold(spark, monkeypatch):
    monkeypatch.setattr(models, "_fitted_metrics", None)
    assert len(queries()["cross_validate"](spark, SF001).collect()) == 12


def test_cross_validation_of_odd_rows_is_that_of_fits(spark):
    rows = [(i % 2, float(i % 3), float(i), 1.0) for i in range(30)]
    counted, fitted = search_of([(f, c + 1, a, b) for f, c, a, b in rows], spark, [1.0], 2)  # no class 0
    assert counted.avgMetrics == fitted.avgMetrics
    for bad in ((0, None, 1.0, 1.0), (0, 1.0, None, 1.0), (0, 1.0, float("nan"), 1.0), (0, 1.0, -1.0, 1.0),
                (0, 0.5, 1.0, 1.0), (2, 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0)):
        with pytest.raises(Exception):
            search_of([*rows, bad], spark, [1.0], 2)
    with pytest.raises(ValueError, match="empty"):
        search_of(rows, spark, [1.0], 3)
