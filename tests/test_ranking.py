"""Distributed global rank equals RANK() over one window, whatever the plan."""

import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crease.operators.ranking import _running_counts, global_rank, global_ranks, top_ranked
from tests.conftest import SF


def _expected(df, key, descending, name="expected"):
    order = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_first()
    return df.withColumn(name, F.rank().over(Window.orderBy(order)))


def _check(df, key, descending, **options):
    ranked = global_rank(df, key, descending=descending, name="got", **options)
    joined = _expected(ranked, key, descending)
    bad = joined.filter(~F.col("got").eqNullSafe(F.col("expected"))).count()
    assert ranked.count() == df.count()
    assert bad == 0


@pytest.fixture(scope="module")
def parts(spark):
    li = spark.read.parquet(f"{SF['0.01']}/lineitem.parquet")
    return li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"),
                                       F.count(F.lit(1)).alias("lines"))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_bucketed_rank_matches_window(parts, descending, buckets):
    _check(parts, "qty", descending, buckets=buckets, bucket_rows=1)


@pytest.mark.parametrize("descending", [False, True])
def test_heavy_ties_and_nulls(parts, descending):
    # a third of the rows share one key and some keys are NULL
    df = parts.withColumn("k", F.when(F.col("l_partkey") % 3 == 0, F.lit(7))
                               .when(F.col("l_partkey") % 11 == 0, F.lit(None))
                               .otherwise(F.col("lines")))
    _check(df, "k", descending, buckets=16, bucket_rows=1)
    _check(df, "k", descending)


def test_all_null_keys(spark):
    df = spark.range(50).select(F.lit(None).cast("double").alias("k"))
    ranked = global_rank(df, "k").collect()
    assert {r.rank for r in ranked} == {1}


def test_double_keys_and_two_ranks(parts):
    df = parts.withColumn("ratio", F.round(F.col("qty") / F.col("lines"), 1))
    ranked = global_ranks(df, [("ratio", False, "r1"), ("lines", True, "r2")])
    check = _expected(_expected(ranked, "ratio", False, "e1"), "lines", True, "e2")
    assert check.filter((F.col("r1") != F.col("e1")) | (F.col("r2") != F.col("e2"))).count() == 0


def _jobs(spark, run):
    group = f"counted-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, group)
    run()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_of_a_rank_do_not_grow_with_ranks_or_buckets(spark, parts):
    stored = parts.checkpoint()
    one = [("qty", True, "r1")]
    for specs in (one, [*one, ("lines", False, "r2"), ("l_partkey", False, "r3")]):
        for buckets in (4, 64):
            # counts, sampling, ranges, running sums, the stored result
            assert _jobs(spark, lambda: global_ranks(  # noqa: B023
                stored, specs, buckets=buckets, bucket_rows=1, checkpoint=False)) <= 5


def test_buckets_follow_the_rows(spark):
    few = spark.range(5000).select(F.col("id") % 700, "id").toDF("k", "id")
    stored, offsets = _running_counts(few, [("k", False, "r")], 7)
    assert len(offsets[0]) == 7 and offsets[0] == sorted(offsets[0])
    per_bucket = [r.n for r in stored.groupBy("__bucket").agg(F.count("*").alias("n")).collect()]
    assert len(per_bucket) == 7 and max(per_bucket) <= 3 * 700 / 7


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("n", [1, 3, 10, 5000])
def test_top_ranked_keeps_what_a_rank_filter_keeps(parts, descending, n):
    df = parts.withColumn("k", F.when(F.col("l_partkey") % 3 == 0, F.lit(7))
                               .when(F.col("l_partkey") % 11 == 0, F.lit(None))
                               .otherwise(F.col("lines")))
    for key in ("k", "qty"):
        want = _expected(df, key, descending, "r").where(F.col("r") <= n)
        got = top_ranked(df, key, n, descending=descending, name="r")
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) \
            == sorted(map(tuple, want.collect()), key=repr)


def test_top_ranked_of_nothing(spark, parts):
    assert top_ranked(parts, "qty", 0).count() == 0
    assert top_ranked(parts.where("qty < 0"), "qty", 5).count() == 0


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["string", "boolean", "date", "timestamp", "double"])
def test_every_orderable_type(parts, kind, descending):
    number = F.col("l_partkey") % 97
    key = {"string": F.concat(F.lit("k"), number.cast("string")), "boolean": number % 2 == 0,
           "date": F.date_add(F.lit("2020-01-01"), number.cast("int")),
           "timestamp": F.timestamp_seconds(number), "double": number / 7}[kind]
    df = parts.withColumn("k", F.when(F.col("l_partkey") % 13 != 0, key))
    _check(df, "k", descending, buckets=9, bucket_rows=1)


def test_a_third_of_the_rows_on_one_key_without_broadcast(spark):
    rows = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _check(rows, "k", False, buckets=16, bucket_rows=1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nan_is_the_largest_number(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (float("inf"),)], "k double")
    _check(df, "k", False, buckets=3, bucket_rows=1)
    _check(df, "k", True, buckets=3, bucket_rows=1)


@pytest.mark.parametrize("checkpoint", [True, False])
def test_empty_input(spark, checkpoint):
    empty = spark.range(10).filter("id > 100").selectExpr("id", "id % 3 as k")
    assert global_rank(empty, "k", checkpoint=checkpoint).count() == 0
