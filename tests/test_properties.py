"""Invariants over the benchmark tables."""

from pyspark.sql import functions as F

from crease.operators import gold, reports, silver
from crease.plans import catalog
from crease.sources.adapters import deliveries_from_lineitem
from tests.conftest import SF


def test_sixes_plus_fours_are_boundaries(spark):
    stats = catalog.batsman_stats(spark, SF["0.01"])
    assert stats.filter(F.col("sixes") + F.col("fours") != F.col("boundaries")).count() == 0


def test_team_wins_sum_to_decided_matches(spark):
    m = catalog.silver_matches(spark, SF["0.01"])
    decided = m.filter(F.col("winner").isNotNull() & (F.col("winner") != "")).count()
    total = gold.team_season_wins(m).agg(F.sum("wins")).first()[0]
    assert total == decided


def test_dedup_independent_of_partitioning(spark):
    li = spark.read.parquet(f"{SF['0.01']}/lineitem.parquet")
    a = silver.enrich_deliveries(deliveries_from_lineitem(li))
    b = silver.enrich_deliveries(deliveries_from_lineitem(
        li.repartition(7, "l_partkey").sortWithinPartitions(F.desc("l_quantity"))))
    assert a.count() == b.count() == 58165
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_summary_keeps_every_silver_match(spark):
    sf = SF["0.01"]
    assert catalog.match_summary(spark, sf).count() == catalog.silver_matches(spark, sf).count()


def test_tied_reports_cut_the_same_rows_under_any_partitioning(spark):
    rows = [(1, f"p{i:02d}", 10, 1.0, 2.0, "x") for i in range(20)]
    names = "overall_rank int, batsman string, total_runs int, strike_rate double, " \
            "batting_average double, performance_tier string"
    boards = [spark.createDataFrame(order, names).repartition(n)
              for n, order in ((1, rows), (5, rows[::-1]), (7, rows))]
    cut = [[r.batsman for r in reports.top_scorers(b, limit=4).collect()] for b in boards]
    assert cut == [["p00", "p01", "p02", "p03"]] * 3
    wins = spark.createDataFrame([(t, 3) for t in "dbca"], "winner string, wins int")
    for n in (1, 4):
        assert [r.winner for r in reports.team_total_wins(wins.repartition(n), limit=2).collect()] \
            == ["a", "b"]
