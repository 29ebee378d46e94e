"""The reference suite's eleven facts, asserted through the library functions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from crease.functions.metrics import rounded_ratio, tier
from crease.operators.gold import batsman_stats, bowler_stats
from crease.operators.silver import enrich_deliveries

COLUMNS = [
    ("match_id", IntegerType()), ("inning", IntegerType()), ("batting_team", StringType()),
    ("bowling_team", StringType()), ("over", IntegerType()), ("ball", IntegerType()),
    ("batsman", StringType()), ("non_striker", StringType()), ("bowler", StringType()),
    ("is_super_over", IntegerType()), ("wide_runs", IntegerType()), ("bye_runs", IntegerType()),
    ("legbye_runs", IntegerType()), ("noball_runs", IntegerType()),
    ("batsman_runs", IntegerType()), ("extra_runs", IntegerType()), ("total_runs", IntegerType()),
    ("player_dismissed", StringType()), ("dismissal_kind", StringType()), ("fielder", StringType()),
]
SCHEMA = StructType([StructField(n, t, True) for n, t in COLUMNS])


def _ball(ball, batsman, runs, dismissed=None):
    return (1, 1, "A", "B", 1, ball, batsman, "X", "Bowler", 0, 0, 0, 0, 0, runs, 0, runs,
            dismissed, "caught" if dismissed else None, "F" if dismissed else None)


@pytest.fixture
def four_balls(spark):
    rows = [_ball(1, "P1", 4), _ball(2, "P1", 6), _ball(3, "P1", 0), _ball(4, "P2", 1, "P2")]
    return enrich_deliveries(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("flag,expected", [
    ("is_boundary", 2), ("is_six", 1), ("is_four", 1), ("is_dot_ball", 1),
    ("is_wicket_delivery", 1), ("is_wide", 0),
])
def test_silver_flags(four_balls, flag, expected):
    assert four_balls.filter(F.col(flag)).count() == expected


def test_strike_rate(spark):
    df = spark.createDataFrame([(100, 80)], "runs long, balls long")
    assert df.select(rounded_ratio("runs", "balls", 100)).first()[0] == 125.0


def test_batting_average_never_out(spark):
    # 50 runs over ten matches, never dismissed: the average is the total
    rows = [(m, 1, "A", "B", 1, 1, "P", "X", "W", 0, 0, 0, 0, 0, 5, 0, 5, None, None, None)
            for m in range(10)]
    stats = batsman_stats(enrich_deliveries(spark.createDataFrame(rows, SCHEMA)))
    row = stats.first()
    assert row["total_runs"] == 50 and row["times_dismissed"] == 0
    assert row["batting_average"] == 50


def test_performance_tiers(spark):
    df = spark.createDataFrame([(1,), (11,), (35,)], "overall_rank int")
    assert [r[0] for r in df.select(tier("overall_rank")).collect()] == [
        "Elite", "Top Performer", "Regular"]


def test_economy_rate(spark):
    # 120 runs in 60 balls over ten matches with ten wickets
    rows = [(m, 1, "A", "B", 1, b, f"P{b}", "X", "W", 0, 0, 0, 0, 0, 2, 0, 2,
             f"P{b}" if b == 1 else None, None, None)
            for m in range(10) for b in range(1, 7)]
    stats = bowler_stats(enrich_deliveries(spark.createDataFrame(rows, SCHEMA))).first()
    assert (stats["runs_conceded"], stats["balls_bowled"]) == (120, 60)
    assert stats["economy_rate"] == 12.0


def test_dot_ball_pct(spark):
    df = spark.createDataFrame([(40, 60)], "dots long, balls long")
    assert df.select(rounded_ratio("dots", "balls", 100)).first()[0] == 66.67
