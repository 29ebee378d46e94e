"""Registry of named queries over the benchmark tables.

Every entry takes ``(spark, sf_dir)``, reads ``orders``/``lineitem`` through
the adapters and returns a DataFrame covering the whole tables, with the
layers composed in one plan.  Entries that rank, and the reports on the boards,
run checkpoint jobs over one row per player when called; the rest stay lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.operators import gold, reports, silver
from crease.operators.ranking import global_rank
from crease.sources.adapters import deliveries_from_lineitem, matches_from_orders


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches_from_orders(_table(spark, sf_dir, "orders"))


def bronze_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries_from_lineitem(_table(spark, sf_dir, "lineitem"))


def silver_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_matches(bronze_matches(spark, sf_dir))


def silver_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich_deliveries(bronze_deliveries(spark, sf_dir))


def batsman_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.batsman_stats(silver_deliveries(spark, sf_dir))


def bowler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.bowler_stats(silver_deliveries(spark, sf_dir))


def team_season_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.team_season_wins(silver_matches(spark, sf_dir))


def innings_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.innings_runs(silver_deliveries(spark, sf_dir))


def match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.match_summary(silver_matches(spark, sf_dir), silver_deliveries(spark, sf_dir))


def q1_top_scorers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_scorers(gold.batting_board(silver_deliveries(spark, sf_dir)))


def q2_best_economy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.best_economy(gold.bowling_board(silver_deliveries(spark, sf_dir)))


def q3_team_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_team_form(team_season_wins(spark, sf_dir))


def q4_toss_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.toss_decision_rate(match_summary(spark, sf_dir))


def q5_top_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_venues(match_summary(spark, sf_dir))


def q6_all_rounders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.all_rounders(*gold.boards(silver_deliveries(spark, sf_dir)))


def top_wicket_takers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_wicket_takers(gold.bowling_board(silver_deliveries(spark, sf_dir)))


def team_total_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.team_total_wins(team_season_wins(spark, sf_dir))


def part_quantity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The global rank over many entities: every part by shipped quantity.

    The leaderboards rank at most a few hundred players; here buckets, ties and
    the join back matter.
    """
    parts = (_table(spark, sf_dir, "lineitem").groupBy("l_partkey")
             .agg(F.sum("l_quantity").cast("bigint").alias("total_quantity")))
    return global_rank(parts, "total_quantity", descending=True, name="quantity_rank")


def venue_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The global rank over a text column: matches in the order of their venues."""
    matches = silver_matches(spark, sf_dir).select("id", "venue")
    return global_rank(matches, "venue", name="venue_rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_matches": bronze_matches,
    "bronze_deliveries": bronze_deliveries,
    "silver_matches": silver_matches,
    "silver_deliveries": silver_deliveries,
    "batsman_stats": batsman_stats,
    "bowler_stats": bowler_stats,
    "team_season_wins": team_season_wins,
    "innings_runs": innings_runs,
    "match_summary": match_summary,
    "q1_top_scorers": q1_top_scorers,
    "q2_best_economy": q2_best_economy,
    "q3_team_form": q3_team_form,
    "q4_toss_rate": q4_toss_rate,
    "q5_top_venues": q5_top_venues,
    "q6_all_rounders": q6_all_rounders,
    "top_wicket_takers": top_wicket_takers,
    "team_total_wins": team_total_wins,
    "part_quantity_rank": part_quantity_rank,
    "venue_rank": venue_rank,
}
