"""Distributed ranks, lazy areas, headers, keyed tables, one file, committed batches."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.evaluation import auc_pr, auc_score, curve_areas, score_curve
from millrace.operators.features import index_category, index_distributed, label_ranks
from millrace.operators.ranking import global_row_number
from millrace.sinks.keyed import read_table, upsert_table
from millrace.sinks.single import write_single_csv
from millrace.sources.headers import read_by_header
from millrace.streaming.payload import encode_payload
from millrace.streaming.recovery import (REASON, check_payload, committed, current_version, get_text, put_text,
                                         read_committed)


def test_row_numbers_are_global(spark):
    rows = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(97)).alias("range"), F.col("id").alias("place")).repartition(7)
    got = global_row_number(rows, [F.asc("range"), F.desc("place")], "n").orderBy("n").collect()
    want = sorted(((r["range"], -r["place"]) for r in rows.collect()))
    assert [(r["range"], -r["place"], r["n"]) for r in got] == [(a, b, k) for k, (a, b) in enumerate(want)]
    assert global_row_number(rows.limit(0), [F.asc("range")]).count() == 0


def test_index_distributed_equals_the_indexer(spark):
    draw = random.Random(4)
    rows = spark.createDataFrame([(k, "hot" if k % 3 == 0 else draw.choice("abcdefgh") * draw.randrange(1, 4)) for k in range(900)],
                                 "id int, word string")
    want = sorted(map(tuple, index_category(rows, ["word"], ["i"]).collect()))
    assert sorted(map(tuple, index_distributed(rows, ["word"], ["i"]).collect())) == want
    n, labels = label_ranks(rows, "word").count(), [label_ranks(rows, "word")]
    odd = spark.createDataFrame([(1, "hot"), (2, None), (3, "new")], "id int, word string")
    kept = {r.id: r.i for r in index_distributed(odd, ["word"], ["i"], "keep", labels).collect()}
    assert kept == {1: 0.0, 2: float(n), 3: float(n)}
    assert [r.id for r in index_distributed(odd, ["word"], ["i"], "skip", labels).collect()] == [1]
    with pytest.raises(Exception, match="no label"):
        index_distributed(odd, ["word"], ["i"], labels=labels).collect()


def _areas(pairs):
    scores = sorted({s for _, s in pairs}, reverse=True)
    p, n = sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs)
    tp = fp = roc = pr = 0
    before = None
    for s in scores:
        a, b = sum(y for y, x in pairs if x == s), sum(1 - y for y, x in pairs if x == s)
        roc += b * (tp + a / 2)
        tp, fp = tp + a, fp + b
        now = tp / (tp + fp)
        pr += a * (now + (now if before is None else before)) / 2
        before = now
    return roc / (p * n), pr / p


def test_areas_equal_plain_sums(spark):
    draw = random.Random(8)
    scores = [0.0, -0.0, 1.0, 0.9999999, 2.0, -2.0, 1e-310, -1e300, 1e300, float("inf"), float("-inf")]
    pairs = [(draw.randrange(2), draw.choice(scores) if k % 3 else draw.gauss(0, 1)) for k in range(800)]
    df = spark.createDataFrame([(float(y), s) for y, s in pairs] + [(None, 1.0), (1.0, None)], "label double, score double")
    got, want = curve_areas(df).first(), _areas([(y, s + 0.0) for y, s in pairs])
    assert got.auc == pytest.approx(want[0], abs=1e-12) and got.auc_pr == pytest.approx(want[1], abs=1e-12)
    curve = score_curve(df).orderBy(F.desc("score")).collect()
    assert [r.tp for r in curve] == sorted(r.tp for r in curve) and curve[-1].tp == sum(y for y, _ in pairs)
    assert auc_score(df.where("label = 1")).first().auc is None and auc_pr(df.limit(0)).first().auc_pr is None


def test_areas_run_no_job_when_built(spark):
    group = "areas-build"
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.4)], "label double, score double")
    spark.sparkContext.setJobGroup(group, group)
    curve_areas(df)
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not list(found)


def _csv(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.option("header", True).csv(path)


def test_headers_meet_by_name_or_position(spark, scratch):
    root = scratch("headers")
    _csv(spark, [(1, "ann")], "id int, name string", f"{root}/a")
    _csv(spark, [("bob", 2.5)], "name string, id double", f"{root}/b")
    _csv(spark, [(3, "cy", 9)], "id int, name string, more int", f"{root}/c")
    with pytest.raises(ValueError, match="different headers"):
        read_by_header(spark, f"{root}/*")
    by_name = read_by_header(spark, f"{root}/*", match="name")
    assert dict(by_name.dtypes)["id"] == "double" and by_name.columns == ["id", "name", "more", "source_file"]
    assert sorted((r.id, r.name, r.more) for r in by_name.collect()) == [(1.0, "ann", None), (2.5, "bob", None), (3.0, "cy", 9)]
    by_place = read_by_header(spark, [f"{root}/a", f"{root}/b"], match="position", file_col=None)
    assert sorted(map(tuple, by_place.collect())) == [("1", "ann"), ("bob", "2.5")]
    with pytest.raises(ValueError, match="different lengths"):
        read_by_header(spark, f"{root}/*", match="position")
    assert read_by_header(spark, f"{root}/a").count() == 1


def test_upsert_keeps_the_newest(spark, scratch):
    path, schema = scratch("keyed"), "k string, at int, v string"
    write = lambda rows: upsert_table(spark.createDataFrame(rows, schema), path, ["k"], ["at"], buckets=4)
    assert read_table(spark, path) is None
    write([("a", 1, "x"), ("a", 2, "y"), (None, 1, "n"), ("b", 5, "old"), ("t", 1, "p"), ("t", 1, "q")] + [("hot", i, "h") for i in range(500)])
    write([("a", 1, "late"), ("b", 6, "new"), (None, 3, "m"), ("c", None, "z")])
    write([])
    got = sorted((tuple(r) for r in read_table(spark, path).collect()), key=repr)
    assert got == sorted([("a", 2, "y"), ("b", 6, "new"), (None, 3, "m"), ("c", None, "z"), ("t", 1, "q"), ("hot", 499, "h")], key=repr)
    with pytest.raises(ValueError, match="buckets"):
        upsert_table(spark.createDataFrame([("a", 1, "x")], schema), path, ["k"], ["at"], buckets=8)
    with pytest.raises(ValueError, match="other columns"):
        upsert_table(spark.createDataFrame([("a", 1)], "k string, at int"), path, ["k"], ["at"], buckets=4)


def test_upsert_reads_touched_buckets_only(spark, scratch):
    import os

    path = scratch("touched")
    local = path.removeprefix("file:")
    upsert_table(spark.range(1000).selectExpr("id", "0 AS at"), path, ["id"], ["at"], buckets=8)
    files = lambda: {(d, f) for d, _, names in os.walk(f"{local}/rows") for f in names if f.endswith(".parquet")}
    before = files()
    upsert_table(spark.createDataFrame([(5, 1)], "id long, at int"), path, ["id"], ["at"], buckets=8)
    assert len({d for d, _ in before ^ files()}) == 1 and read_table(spark, path).count() == 1000


def test_one_csv_file(spark, scratch):
    import os

    path = f"{scratch('single')}.csv"
    local = path.removeprefix("file:")
    rows = spark.range(1000).selectExpr("id", "concat('a,\"', id) AS t").repartition(6).orderBy("id")
    write_single_csv(rows, path)
    write_single_csv(rows, path)  # replaced
    assert os.path.isfile(local) and not [f for f in os.listdir(os.path.dirname(local)) if f.endswith(".half")]
    got = spark.read.option("header", True).schema("id long, t string").csv(path).collect()
    assert [r.id for r in got] == list(range(1000)) and got[7].t == 'a,"7'
    write_single_csv(rows.limit(0), path)
    assert open(local).read().strip() == "id,t"
    broken = rows.select(F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_single_csv(broken, path)
    assert open(local).read().strip() == "id,t"


def test_reasons_for_rejects(spark):
    users = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    good = encode_payload(users, ["id", "name"], schema="id INT NOT NULL, name STRING", fmt="json")
    texts = [bytes(r.value) for r in good.collect()] + [b"{", b'{"name":"x"}', b'{"id":"x"}', b"\xff", None]
    df = spark.createDataFrame([(t,) for t in texts], "value binary")
    found = [r[REASON] for r in check_payload(df, "value", "id INT NOT NULL, name STRING", "json").collect()]
    assert found[:2] == [None, None] and all(found[2:6]) and found[6] is None and found[3] == "lacks id" and found[5] == "not UTF-8"
    with pytest.raises(ValueError, match="cannot be checked"):
        check_payload(df, "value", "id INT", "avro")


def test_only_committed_batches_are_read(spark, scratch):
    out = scratch("committed")
    rows = spark.range(10)

    def fail(batch_id):
        raise RuntimeError("lost")

    with pytest.raises(ValueError, match="no committed batch"):
        read_committed(spark, out)
    with pytest.raises(RuntimeError):
        committed(lambda b, i: {out: b}, fail)(rows, 0)
    assert read_committed(spark, out, rows.schema).count() == 0
    for _ in range(2):  # the same batch again counts once
        committed(lambda b, i: {out: b})(rows, 0)
    committed(lambda b, i: {out: b})(rows, 1)
    assert read_committed(spark, out).count() == 20


def test_pointers_are_replaced_whole(spark, scratch):
    path = f"{scratch('pointer')}/current"
    assert get_text(spark, path) is None
    for text in ("one", "two"):
        put_text(spark, path, text)
        assert get_text(spark, path) == text
    with pytest.raises(ValueError, match="no model"):
        current_version(spark, scratch("models"))
