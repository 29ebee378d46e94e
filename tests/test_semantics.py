"""Hand-made rows for the behaviours the results depend on (NULLs, ties, frames)."""

import datetime as dt

from pyspark.sql import functions as F

from crease.operators import gold, reports, silver
from crease.operators.dedup import dedup_keep_first

MATCH_COLS = ("id long, season int, city string, date date, match_type string, venue string, "
              "team1 string, team2 string, toss_winner string, toss_decision string, "
              "winner string, result string, player_of_match string")
BALL_COLS = ("match_id long, inning int, over int, ball int, batsman string, bowler string, "
             "wide_runs int, noball_runs int, batsman_runs int, extra_runs int, "
             "player_dismissed string, total_runs int")
D = dt.date(2020, 4, 1)


def match(i, season=2020, winner="T1", result="normal", toss="T1", decision="bat",
          venue="V", mtype="League"):
    return (i, season, "C", D, mtype, venue, "T1", "T2", toss, decision, winner, result, "P")


def ball(m, inning=1, over=1, b=1, batsman="B", bowler="W", wide=0, noball=0, runs=0,
         extra=0, out=None, total=None):
    return (m, inning, over, b, batsman, bowler, wide, noball, runs, extra, out,
            runs + extra if total is None else total)


def test_no_result_and_null_result_dropped(spark):
    raw = spark.createDataFrame([match(1), match(2, result="no result"), match(3, result=None)],
                                MATCH_COLS)
    assert [r.id for r in silver.clean_matches(raw).collect()] == [1]


def test_dirty_season_and_date_text_become_null(spark):
    raw = spark.createDataFrame(
        [(1, "20x0", "2020-04-01", "normal"), (2, "2021", "not a date", "normal")],
        "id long, season string, date string, result string")
    raw = raw.select("id", "season", "date", F.lit("League").alias("match_type"),
                     F.lit("T1").alias("toss_winner"), F.lit("T1").alias("winner"), "result")
    out = {r.id: r for r in silver.clean_matches(raw).collect()}
    assert out[1].season is None and out[1].match_date == D
    assert out[2].season == 2021 and out[2].match_date is None


def test_toss_flag_null_without_winner_and_counted_in_rate(spark):
    raw = spark.createDataFrame([match(1, winner="T1"), match(2, winner=None),
                                 match(3, winner="T2")], MATCH_COLS)
    m = silver.clean_matches(raw)
    assert {r.id: r.toss_winner_won for r in m.collect()} == {1: True, 2: None, 3: False}
    d = spark.createDataFrame([ball(1)], BALL_COLS)
    rate = reports.toss_decision_rate(gold.match_summary(m, silver.enrich_deliveries(d))).first()
    assert (rate.total_matches, rate.toss_winner_won, rate.win_pct_after_toss) == (3, 1, 33.33)


def test_team_wins_skip_null_and_empty_winner(spark):
    raw = spark.createDataFrame([match(1, winner=""), match(2, winner=None), match(3)],
                                MATCH_COLS)
    wins = gold.team_season_wins(silver.clean_matches(raw)).collect()
    assert [(r.winner, r.wins) for r in wins] == [("T1", 1)]


def test_rolling_window_counts_rows_not_seasons(spark):
    rows = [match(i, season=s) for i, s in enumerate([2010, 2011, 2015, 2016], start=1)]
    wins = gold.team_season_wins(silver.clean_matches(spark.createDataFrame(rows, MATCH_COLS)))
    rolling = {r.season: r.rolling_3season_wins for r in wins.collect()}
    # 2015 bridges the gap: its frame is 2010, 2011, 2015
    assert rolling == {2010: 1, 2011: 2, 2015: 3, 2016: 3}


def test_batting_ignores_wides_and_null_wide_flags(spark):
    d = spark.createDataFrame([ball(m, b=1, runs=4) for m in range(10)]
                              + [ball(0, b=2, wide=1, extra=1, out="B"),
                                 ball(0, b=3, wide=None, runs=6)], BALL_COLS)
    row = gold.batsman_stats(silver.enrich_deliveries(d)).first()
    # the wide (with its dismissal) and the NULL-flag ball are not faced
    assert (row.total_runs, row.balls_faced, row.times_dismissed) == (40, 10, 0)


def test_dismissals_count_wicket_balls_faced(spark):
    # the non-striker is run out on this batsman's ball: it still counts for him
    d = spark.createDataFrame([ball(m, runs=1) for m in range(10)]
                              + [ball(0, b=2, out="OTHER")], BALL_COLS)
    row = gold.batsman_stats(silver.enrich_deliveries(d)).first()
    assert row.times_dismissed == 1 and row.batting_average == 10.0


def test_bowler_counts_every_ball_and_extra(spark):
    rows = [ball(m, b=1, out="X") for m in range(10)]
    rows += [ball(0, b=2, wide=1, extra=1), ball(0, b=3, noball=1, extra=1, runs=4)]
    row = gold.bowler_stats(silver.enrich_deliveries(spark.createDataFrame(rows, BALL_COLS)))
    row = row.first()
    assert (row.total_wickets, row.balls_bowled, row.runs_conceded) == (10, 12, 6)
    assert (row.wides, row.noballs) == (1, 1)


def test_total_runs_taken_from_column(spark):
    d = spark.createDataFrame([ball(1, wide=1, runs=3, extra=1, total=4)], BALL_COLS)
    row = gold.innings_runs(silver.enrich_deliveries(d)).first()
    assert row.inning_total_runs == 4


def test_rank_ties_can_exceed_top_n(spark):
    rows = [ball(m, batsman=f"B{i}", b=i, runs=1) for i in range(12) for m in range(10)]
    stats = gold.batsman_stats(silver.enrich_deliveries(spark.createDataFrame(rows, BALL_COLS)))
    top = reports.top_scorers(stats, n=10).collect()
    assert len(top) == 12 and {r.overall_rank for r in top} == {1}


def test_summary_left_join_and_venue_report(spark):
    m = silver.clean_matches(spark.createDataFrame(
        [match(i, venue="A" if i < 5 else "B") for i in range(10)] + [match(99, venue="C")],
        MATCH_COLS))
    d = silver.enrich_deliveries(spark.createDataFrame(
        [ball(i, runs=6) for i in range(10)] + [ball(99, inning=2, runs=6)], BALL_COLS))
    summary = gold.match_summary(m, d)
    assert {r.id: r.innings1_runs for r in summary.collect()}[99] is None
    venues = reports.top_venues(summary, n=1)
    # A and B tie on the average: the venue name decides, C has no first innings
    assert [r.venue for r in venues.collect()] == ["A"]
    assert dict(venues.dtypes)["highest_score"] == "bigint"


def test_dedup_keeps_smallest_rest_nulls_first(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, None, 9), (1, "a", 1), (2, "z", 0)],
                               "k int, s string, n int")
    kept = {r.k: (r.s, r.n) for r in dedup_keep_first(df, ["k"]).collect()}
    assert kept == {1: (None, 9), 2: ("z", 0)}


def test_recent_form_uses_latest_seasons(spark):
    rows = [match(i, season=2000 + i) for i in range(10)]
    team = gold.team_season_wins(silver.clean_matches(spark.createDataFrame(rows, MATCH_COLS)))
    assert [r.season for r in reports.recent_team_form(team, seasons=3).collect()] == [
        2007, 2008, 2009]
    assert [r.season for r in reports.recent_team_form(team, since=2008).collect()] == [
        2008, 2009]


def test_timestamp_dates_are_truncated(spark):
    raw = spark.createDataFrame([(1, 2020, dt.datetime(2020, 4, 1, 19, 30), "normal")],
                                "id long, season int, date timestamp, result string")
    raw = raw.select("*", F.lit("League").alias("match_type"), F.lit("T1").alias("toss_winner"),
                     F.lit("T1").alias("winner"))
    assert silver.clean_matches(raw).first().match_date == D


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_boards_of_one_pass_equal_the_boards_of_two(spark):
    balls = [ball(m, over=o, b=b, batsman=f"B{(m + b) % 4}", bowler=f"W{(m * o) % 3}",
                  runs=(m + o * b) % 7, wide=int((o + b) % 5 == 0), noball=int(b == 3),
                  out="B1" if (m + b) % 6 == 0 else None)
             for m in range(1, 6) for o in range(1, 4) for b in range(1, 7)]
    balls += [ball(9, b=b, batsman="only wides", bowler="W1", wide=1) for b in range(1, 4)]
    balls += [ball(9, b=7, batsman="W1", bowler="B1", runs=4)]  # both roles, swapped
    d = silver.enrich_deliveries(spark.createDataFrame(balls, BALL_COLS))
    # a NULL flag is neither a wide nor a ball faced
    d = d.withColumn("is_wide", F.when((F.col("match_id") != 3) | (F.col("ball") != 2),
                                       F.col("is_wide")))
    for bounds in ((1, 1, 0), (0, 0, 0), (4, 4, 2)):
        bat, bowl = gold.boards(d, *bounds)
        assert _rows(bat) == _rows(gold.batting_board(d, bounds[0]))
        assert _rows(bowl) == _rows(gold.bowling_board(d, *bounds[1:]))
        assert bat.columns == gold.batting_board(d).columns
        assert bowl.columns == gold.bowling_board(d).columns
    assert "only wides" not in {r.batsman for r in gold.boards(d, 0, 0, 0)[0].collect()}


def test_reports_are_the_same_on_boards_with_and_without_ranks(spark):
    rows = [(f"B{i:02d}", 500 - 10 * (i // 3), 100, 1, 1, 1, 1, 20, 2, 1.0, 2.0, 3.0, 4.0)
            for i in range(40)]
    bat = spark.createDataFrame(
        rows, "batsman string, total_runs long, balls_faced long, boundaries long, sixes long, "
              "fours long, dot_balls long, matches_played long, times_dismissed long, "
              "strike_rate double, batting_average double, avg_runs_per_match double, "
              "boundary_pct double")
    for n in (1, 4, 10, 100):
        got, want = reports.top_scorers(bat, n), reports.top_scorers(gold.rank_batting(bat), n)
        assert got.dtypes == want.dtypes and got.collect() == want.collect()
    assert reports.top_scorers(bat, 10).count() == 12  # a tie on the last rank
    bowl = spark.createDataFrame(
        [(f"W{i}", 10 + i % 4, None if i == 3 else 5.0 + i // 2, 1.5, 2.5) for i in range(12)],
        "bowler string, total_wickets long, economy_rate double, bowling_average double, "
        "dot_ball_pct double")
    ranked = gold.rank_bowling(bowl)
    for report in (reports.best_economy, reports.top_wicket_takers):
        assert report(bowl, 5).collect() == report(ranked, 5).collect()
