"""Plan-shape guards for the scale properties the operators rely on."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF001

Q = entry.queries()


def plan_of(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(plan):
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_token_count_prunes_and_partially_aggregates(spark):
    plan = plan_of(Q["token_count"](spark, SF001))
    assert read_schemas(plan) == ["struct<text:string>"]
    assert "partial_count" in plan
    assert not re.search(r"Python|ArrowEval|MapInArrow", plan)


def test_filters_reach_the_scan(spark):
    plan = plan_of(Q["filter_match"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_discount)]" in plan
    assert read_schemas(plan) == [
        "struct<l_orderkey:bigint,l_linenumber:int,l_discount:double,l_tax:double>"]


def test_dimension_join_broadcasts_and_prunes(spark):
    plan = plan_of(Q["literal_rows"](spark, SF001))
    assert plan.count("BroadcastHashJoin") == 2  # sized by Spark
    assert "struct<c_nationkey:int>" in read_schemas(plan)
    # partial aggregate below the only shuffle
    assert re.search(r"Exchange hashpartitioning\(code.*\n.*partial_count", plan)


def test_scalar_functions_stay_jvm_side(spark):
    for name in ("fn_class_code", "fn_age_band", "fn_regex_title", "fn_sum_flag", "bucketize",
                 "derive_columns", "impute_mean", "fill_constants"):
        plan = plan_of(Q[name](spark, SF001))
        assert "Exchange" not in plan, name
        assert not re.search(r"BatchEvalPython|ArrowEvalPython", plan), name


def test_kmeans_step_uses_constant_centres_and_partial_vector_mean(spark):
    plan = plan_of(Q["kmeans_step"](spark, SF001))
    assert "partial_aggregate_metrics" in plan and "Join" not in plan


def test_confusion_cells_are_one_exchange_without_a_join(spark):
    plan = plan_of(Q["confusion_cells"](spark, SF001))
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert "Join" not in plan_of(Q["confusion_matrix"](spark, SF001))


def test_tokens_have_no_forced_shuffle(spark):
    assert "Exchange" not in plan_of(Q["tokenize"](spark, SF001))
    assert plan_of(Q["token_count"](spark, SF001)).count("Exchange") == 1
    assert "Exchange" not in plan_of(Q["payload_round_trip"](spark, SF001))
    assert "Exchange" not in plan_of(Q["random_split"](spark, SF001))


def test_hot_key_is_reduced_before_the_shuffle(spark):
    # one key holds a third of the rows: the partial aggregate leaves at most
    # one row per key per task for the exchange
    df = spark.range(0, 30000, 1, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("word"))
    from millrace.operators.aggregates import count_by_key
    out = count_by_key(df, "word")
    plan = plan_of(out, final=True)
    assert "partial_count" in plan
    assert out.filter("word = 'hot'").first().n == 10000


def test_fits_read_only_the_columns_they_need(spark):
    from millrace.operators.features import assembler, indexer, scaler
    from millrace.operators.models import fit_pipeline, logistic_regression, needed_columns
    df = spark.range(40).selectExpr("id", "CAST(id % 2 AS DOUBLE) AS label", "id * 0.5 AS x", "'wide' AS other",
                                    "id % 3 AS kind")
    stages = [assembler(["x"], "raw"), scaler("raw", "features"), logistic_regression(max_iter=2)]
    assert needed_columns(stages, df) == ["label", "x"]
    assert needed_columns([indexer(["other"], ["o"])], df) == ["other"]
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    fit_pipeline(stages, df)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
