"""Exact splits of a classification tree: every distinct value is a candidate.

Spark ML's trees choose among at most ``maxBins`` thresholds that they take from a sample. Here
each level is one histogram of (node, feature, value) with the rows of every class, summed
in the map tasks first; running sums over the values give the gain of every threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.evaluation import score_range

SCHEMA = "node long, feature int, threshold double, gain double, n long"


def _impurity(counts: Sequence[Column], kind: str) -> Column:
    total = reduce(Column.__add__, counts)
    shares = [c / total for c in counts]
    if kind == "gini":
        return 1 - reduce(Column.__add__, [p * p for p in shares])
    return -reduce(Column.__add__, [F.when(p > 0, p * F.log2(p)).otherwise(0.0) for p in shares])


def split_gains(rows: DataFrame, n_classes: int, impurity: str = "gini") -> DataFrame:
    """(node, feature, threshold, gain, n) for every threshold, halfway between neighbouring values,
    of rows (node, feature, value, class). Values are summed in ranges of values; a range's
    offset is the total of the ranges below it (one row per range)."""
    kinds = [f"c{k}" for k in range(n_classes)]
    each = (rows.groupBy("node", "feature", "value")
            .agg(*[F.count_if(F.col("class") == k).alias(c) for k, c in enumerate(kinds)])
            .withColumn("range", score_range(F.col("value"))))
    below = Window.partitionBy("node", "feature").orderBy("range")
    earlier, whole = below.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("node", "feature")
    ranges = (each.groupBy("node", "feature", "range")
              .agg(F.min("value").alias("least"), *[F.sum(c).alias(c) for c in kinds])
              .select("node", "feature", "range", F.lead("least").over(below).alias("next_range"),
                      *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in kinds],
                      *[F.sum(c).over(whole).alias(f"{c}_all") for c in kinds]))
    inside = Window.partitionBy("node", "feature", "range").orderBy("value")
    running = each.select("node", "feature", "range", "value", F.lead("value").over(inside).alias("next_value"),
                          *[F.sum(c).over(inside).alias(c) for c in kinds])
    left = [F.col(c) + F.col(f"{c}_before") for c in kinds]
    every = [F.col(f"{c}_all") for c in kinds]
    right = [a - b for a, b in zip(every, left)]
    n, n_left, n_right = (reduce(Column.__add__, x) for x in (every, left, right))
    following = F.coalesce("next_value", "next_range")
    gain = (_impurity(every, impurity) - n_left / n * _impurity(left, impurity)
            - n_right / n * _impurity(right, impurity))
    return (running.join(ranges, ["node", "feature", "range"]).where(following.isNotNull())
            .select("node", "feature", ((F.col("value") + following) / 2).alias("threshold"),
                    gain.alias("gain"), n.cast("long").alias("n")))


def tree_splits(df: DataFrame, label: str, features: Sequence[str], classes: Sequence[float], depth: int,
                impurity: str = "gini", min_gain: float = 0.0) -> DataFrame:
    """(node, feature, threshold, gain, n) of each inner node of the tree: node 1 is the root, node k
    has the children 2k (feature <= threshold) and 2k + 1.

    ``classes`` are the labels; another one raises. The highest gain (to 12 decimals) wins, ties go to the first
    feature, then to the smallest threshold; a node without a gain above ``min_gain`` is a leaf. Rows with
    a null or NaN label or feature do not take part; an empty table has no splits. One pass per level; only the
    chosen splits (below 2 ** depth) come to the driver."""
    if impurity not in ("gini", "entropy"):
        raise ValueError(f"unknown impurity {impurity}")
    spark = df.sparkSession
    number = F.lit(None).cast("int")
    for k, c in reversed(list(enumerate(classes))):
        number = F.when(F.col("y") == float(c), F.lit(k)).otherwise(number)
    number = F.coalesce(number, F.raise_error(F.lit("a label that is not among the classes")).cast("int"))
    rows = df.select(F.col(label).cast("double").alias("y"),
                     F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    rows = rows.where(~(F.isnull("y") | F.isnan("y") | F.exists("x", lambda v: F.isnull(v) | F.isnan(v))))
    rows = rows.select(number.alias("class"), "x")
    found: list[tuple] = []
    node = F.lit(1).cast("long")
    for _ in range(depth):
        melted = rows.select(node.alias("node"), "class", F.posexplode("x").alias("feature", "value")).where("node IS NOT NULL")
        gains = split_gains(melted, len(classes), impurity).where(F.round("gain", 12) > min_gain)
        best = gains.groupBy("node").agg(F.min(F.struct(
            (-F.round("gain", 12)).alias("loss"), "feature", "threshold", "gain", "n")).alias("best"))
        level = [(r.node, r.best.feature, r.best.threshold, r.best.gain, r.best.n) for r in best.collect()]
        if not level:
            break
        found += level
        # rows of the split nodes go on to a child, the others are done
        onward = F.lit(None).cast("long")
        for number_of, feature, threshold, _, _ in level:
            onward = F.when(node == number_of, 2 * number_of + (F.col("x")[feature] > threshold).cast("long")).otherwise(onward)
        node = onward
    return spark.createDataFrame(sorted(found), SCHEMA)
