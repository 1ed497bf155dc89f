from pyspark.sql import functions as F

from millrace.functions import scalar
from millrace.operators.aggregates import class_totals, filtered_counts, match_counts, ratios
from millrace.operators.projection import filter_equal, filter_not_equal
from millrace.operators.quality import (fill_all_numeric, fill_constants, fit_imputer,
                                        missing_profile)
from millrace.operators.sampling import random_split, tag_split, union_all


def test_class_code_case_insensitive_and_null(spark):
    df = spark.createDataFrame([("iris-SETOSA",), ("Iris-versicolor",), ("x",), (None,)], "c string")
    got = [r[0] for r in df.select(scalar.class_code("c")).collect()]
    assert got == [0.0, 1.0, 2.0, None]


def test_age_band_sum_flag_add(spark):
    df = spark.createDataFrame([("male", 10.0, 2, 2), ("female", 30.0, 1, 1), ("male", None, None, 5)],
                               "sex string, age double, a int, b int")
    got = df.select(scalar.age_band("sex", "age").alias("s"), scalar.sum_flag("a", "b").alias("f"),
                    scalar.add("a", "b").alias("t")).collect()
    assert [tuple(r) for r in got] == [("Child", 1.0, 4), ("female", 0.0, 2), (None, None, None)]


def test_title_fold_and_default(spark):
    names = ["Braund, Mr. Owen", "Oliva y Ocana, Dona. Fermina", "Smith, Mlle. Ann",
             "Brown, Capt. Joe", "Rev. Mrs. X", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(scalar.title("n")).collect()]
    assert got == ["Mr.", "Other.", "Miss.", "Sir.", "Rev.", None]


def test_filters_and_counts_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (None, 1.0), (0.0, 0.0)], "l double, p double")
    assert filter_equal(df, "l", "p").count() == 2
    assert filter_not_equal(df, "l", "p").count() == 1  # the null row passes neither
    c = ratios(match_counts(df, "l", "p"), ["n_match"], "n_total").first()
    assert (c.n_total, c.n_match, c.n_mismatch, c.n_match_ratio) == (4, 2, 1, 0.5)
    fc = filtered_counts(df, {"pos": F.col("p") == 1.0}).first()
    assert fc.pos == 3


def test_class_totals(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (2.0, 1.0)], "label double, prediction double")
    got = {r["class"]: (r.n_label, r.n_predicted) for r in class_totals(df).collect()}
    assert got == {0.0: (2, 1), 1.0: (0, 2), 2.0: (1, 0)}


def test_fill_all_numeric_truncates_int(spark):
    df = spark.createDataFrame([(None, None, "a")], "i int, d double, s string")
    r = fill_all_numeric(df, 33750.7).first()
    assert (r.i, r.d, r.s) == (33750, 33750.7, "a")
    r2 = fill_constants(df, {"s": "x", "d": 0.0}).first()
    assert (r2.i, r2.d, r2.s) == (None, 0.0, "a")


def test_imputer_fitted_on_train_reused(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "age double")
    test = spark.createDataFrame([(None,), (10.0,)], "age double")
    model = fit_imputer(train, ["age"])
    assert [r.age for r in model.transform(test).collect()] == [2.0, 10.0]


def test_missing_profile(spark):
    df = spark.createDataFrame([("", float("nan"), None), ("a", 1.0, 2), (None, None, 3)],
                               "s string, d double, i int")
    r = missing_profile(df).first()
    assert (r.s_missing, r.d_missing, r.i_missing) == (2, 2, 1)


def test_union_by_position_and_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert union_all([a, a]).count() == 2
    assert sorted(tuple(r) for r in union_all([a, b], by_name=True).collect()) == [(1, "x"), (2, "y")]


def test_random_split_property(spark):
    df = spark.range(20000)
    for weights in ([0.8, 0.2], [0.3, 0.3], [0.8, 0.18, 0.02]):
        parts = random_split(df, weights, seed=11)
        counts = [p.count() for p in parts]
        assert sum(counts) == 20000
        ids = parts[0].select("id")
        for p in parts[1:]:
            assert ids.intersect(p.select("id")).count() == 0
        total = sum(weights)
        for c, w in zip(counts, weights):
            share = w / total
            sigma = (20000 * share * (1 - share)) ** 0.5
            assert abs(c - 20000 * share) <= 4 * sigma + 1
    tagged = tag_split(df, [0.8, 0.2], seed=3, names=["train", "test"])
    n_train = tagged.filter("split = 'train'").count()
    assert 15500 < n_train < 16500


def test_random_split_deals_copies_and_complex_columns_row_by_row(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.sql import functions as F
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"),
                                     F.when(F.col("id") % 3 > 0, F.lit("b")).alias("t"))
    train, test = random_split(rows, [0.8, 0.2], seed=11)
    assert train.schema.names == rows.schema.names
    hot = [p.where("id = -1").count() for p in (train, test)]
    assert sum(hot) == 10000 and 1800 < hot[1] < 2200
    both = train.unionAll(test)
    assert both.exceptAll(rows).count() == rows.exceptAll(both).count() == 0
    again = random_split(rows.repartition(7), [0.8, 0.2], seed=11)[1]
    assert test.exceptAll(again).count() == again.exceptAll(test).count() == 0
    data = [(float(i % 2), Vectors.dense([float(i), -0.0]), [i, None]) for i in range(1000)]
    frame = spark.createDataFrame(data, ["label", "features", "parts"])
    parts = [p.collect() for p in random_split(frame, [0.5, 0.5], seed=3)]
    assert 400 < len(parts[0]) < 600 and sorted((r.features[0], r.parts) for p in parts for r in p) == \
        [(float(i), [i, None]) for i in range(1000)]


def test_random_split_deals_many_copies_to_many_tasks(spark, monkeypatch):
    from millrace.operators import sampling
    monkeypatch.setattr(sampling, "COPIES_AT_ONCE", 100)
    monkeypatch.setattr(sampling, "ROWS_A_TASK", 1000, raising=False)
    rows = spark.range(20000).select(F.lit("a").alias("t"), F.lit(-0.0).alias("x"))
    part = random_split(rows, [0.5, 0.5], seed=1)[0]
    files = [r["count"] for r in part.groupBy(F.input_file_name()).count().collect()]
    assert len(files) > 10 and max(files) < 2000
    assert {r.x for r in part.select(F.col("x").cast("string").alias("x")).collect()} == {"-0.0"}


def test_zero_fill_then_mean_reproduces_the_chain(spark):
    from millrace.operators.quality import impute_mean
    df = spark.createDataFrame([(360.0,), (None,), (180.0,)], "term double")
    theirs = impute_mean(fill_constants(df, {"term": 0.0}), ["term"])  # fill 0, then mean: no-op
    assert [r.term for r in theirs.collect()] == [360.0, 0.0, 180.0]
    ours = impute_mean(df, ["term"])  # mean of the known values
    assert [r.term for r in ours.collect()] == [360.0, 270.0, 180.0]


def test_tag_split_three_way_proportions(spark):
    df = spark.range(300000)
    counts = {r.split: r["count"] for r in
              tag_split(df, [1, 1, 1], seed=3, names=["a", "b", "c"]).groupBy("split").count()
              .collect()}
    sigma = (300000 * (1 / 3) * (2 / 3)) ** 0.5
    assert all(abs(counts[k] - 100000) <= 4 * sigma for k in "abc"), counts


def test_random_split_keeps_columns_of_any_name(spark):
    names = ["_row", "_number", "_draw", "_part", "__row", "part"]
    df = spark.createDataFrame([(i % 3, i, "a", "b", None, 1.5) for i in range(60)] * 2,
                               "_row int, _number int, _draw string, _part string, __row string, part double")
    for keys in (None, ["_number"]):
        parts = random_split(df, [0.6, 0.4], seed=5, keys=keys)
        assert all(p.columns == names for p in parts)
        assert union_all(parts).exceptAll(df).count() == 0 and df.exceptAll(union_all(parts)).count() == 0


def test_unkeyed_split_shuffles_once(spark):
    df = spark.range(1000).selectExpr("id % 3 AS a")
    parts = random_split(df, [0.5, 0.3, 0.2], seed=5)
    for k, p in enumerate(parts):
        plan = p._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "PartitionFilters" in plan and f"part{k}" in plan
    assert sum(p.count() for p in parts) == 1000
    assert [p.count() for p in random_split(df.limit(0), [0.5, 0.5], seed=5)] == [0, 0]
