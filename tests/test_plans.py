"""Physical-plan properties that matter at scale (checked on small data)."""

import re

import pytest
from pyspark.sql import functions as F

from crease.operators import gold, silver
from crease.operators.ranking import global_rank, top_ranked
from crease.sources.adapters import deliveries_from_lineitem, matches_from_orders
from tests.conftest import SF


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _raw(spark):
    sf = SF["0.01"]
    return (matches_from_orders(spark.read.parquet(f"{sf}/orders.parquet")),
            deliveries_from_lineitem(spark.read.parquet(f"{sf}/lineitem.parquet")))


def test_scans_read_only_needed_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    m, d = _raw(spark)
    plan = _plan(gold.innings_runs(silver.enrich_deliveries(d)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = _plan(silver.clean_matches(m))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "o_totalprice" not in schema


def test_summary_join_reuses_aggregation_partitioning(no_broadcast):
    m, d = _raw(no_broadcast)
    plan = _plan(gold.match_summary(silver.clean_matches(m), silver.enrich_deliveries(d)))
    assert "SortMergeJoin" in plan
    # matches dedup, deliveries dedup, first-innings totals: nothing for the join
    assert plan.count("Exchange hashpartitioning") == 3


def test_dedup_combines_before_its_shuffle(spark):
    _, d = _raw(spark)
    plan = _plan(silver.enrich_deliveries(d))
    assert "partial_min(struct(" in plan


def _above_single_partition(plan):
    lines = plan.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


def test_rank_gathers_nothing_in_one_partition(spark):
    li = spark.read.parquet(f"{SF['0.01']}/lineitem.parquet")
    parts = li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    plan = _plan(global_rank(parts, "q", buckets=16, bucket_rows=1))
    assert not _above_single_partition(plan)
    assert "rank(" not in plan and "Window" not in plan  # the running sums are stored


def test_top_ranked_gathers_only_its_first_keys(spark):
    li = spark.read.parquet(f"{SF['0.01']}/lineitem.parquet")
    parts = li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    plan = _plan(top_ranked(parts, "q", 10, descending=True))
    assert plan.count("TakeOrderedAndProject(limit=10") == 1
    assert all("TakeOrderedAndProject" in x for x in _above_single_partition(plan))
    assert "rank(" not in plan


def test_both_boards_share_their_shuffles(spark):
    _, d = _raw(spark)
    plan = _plan(gold.careers(silver.enrich_deliveries(d)))
    # dedup, both roles' (player, match), both roles' players
    assert plan.count("Exchange") == 3
    assert plan.count("Expand") == 1 and plan.count("FileScan") == 1
