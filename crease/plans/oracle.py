"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL restates each result from its definition - it shares no code with
the Spark side.  Conventions: integer sums are cast to BIGINT (DuckDB gives
HUGEINT), ranks to INT, and audit timestamps are never selected.  Dedup keeps
the row whose remaining columns sort first with NULLs first.
"""

from __future__ import annotations

# Fixture projections: benchmark tables -> raw matches / deliveries.
RAW_MATCHES = """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(year(o_orderdate) AS INT) AS season,
 'CITY_' || CAST(o_custkey % 25 AS VARCHAR(8)) AS city, CAST(o_orderdate AS DATE) AS date,
 CASE CAST(o_orderkey % 30 AS INT) WHEN 29 THEN 'Final' WHEN 28 THEN 'Qualifier' WHEN 27 THEN 'Eliminator' ELSE 'League' END AS match_type,
 'VENUE_' || CAST(o_custkey % 25 AS VARCHAR(8)) AS venue,
 'TEAM_' || CAST(o_custkey % 8 AS VARCHAR(8)) AS team1,
 'TEAM_' || CAST((o_custkey + 1 + o_orderkey % 7) % 8 AS VARCHAR(8)) AS team2,
 'TEAM_' || CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 8 ELSE (o_custkey + 1 + o_orderkey % 7) % 8 END AS VARCHAR(8)) AS toss_winner,
 CASE WHEN o_orderkey % 5 < 2 THEN 'bat' ELSE 'field' END AS toss_decision,
 CASE WHEN o_orderpriority = '5-LOW' OR o_orderkey % 9 = 0 THEN NULL
      WHEN o_orderkey % 9 = 1 THEN ''
      WHEN o_orderstatus = 'F' THEN 'TEAM_' || CAST(o_custkey % 8 AS VARCHAR(8))
      ELSE 'TEAM_' || CAST((o_custkey + 1 + o_orderkey % 7) % 8 AS VARCHAR(8)) END AS winner,
 CASE o_orderpriority WHEN '5-LOW' THEN 'no result' WHEN '4-NOT SPECIFIED' THEN 'tie' ELSE 'normal' END AS result,
 'PLAYER_' || CAST(o_custkey % 48 AS VARCHAR(8)) AS player_of_match
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders
 UNION ALL SELECT o_orderkey, o_custkey, 'F', o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 20 = 5) o
"""

RAW_DELIVERIES = """
SELECT *, batsman_runs + extra_runs AS total_runs FROM (
SELECT CAST(l_orderkey AS BIGINT) AS match_id, CAST(1 + l_suppkey % 2 AS INT) AS inning,
 CAST(1 + l_linenumber AS INT) AS "over", CAST(1 + l_partkey % 6 AS INT) AS ball,
 CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'PLAYER_' || CAST(l_partkey % 80 AS VARCHAR(8)) END AS batsman,
 CASE WHEN l_suppkey % 50 = 49 THEN NULL ELSE 'PLAYER_' || CAST(60 + l_suppkey % 32 AS VARCHAR(8)) END AS bowler,
 CAST(CASE WHEN CAST(round(l_tax * 100) AS INT) = 0 THEN 1 ELSE 0 END AS INT) AS wide_runs,
 CAST(CASE WHEN CAST(round(l_tax * 100) AS INT) = 1 THEN 1 ELSE 0 END AS INT) AS noball_runs,
 CAST(CASE WHEN CAST(round(l_tax * 100) AS INT) = 0 THEN 0
  ELSE CASE WHEN CAST(l_quantity AS INT) % 10 < 4 THEN 0 WHEN CAST(l_quantity AS INT) % 10 < 6 THEN 1 WHEN CAST(l_quantity AS INT) % 10 = 6 THEN 2
  WHEN CAST(l_quantity AS INT) % 10 = 7 THEN 3 WHEN CAST(l_quantity AS INT) % 10 = 8 THEN 4 ELSE 6 END END AS INT) AS batsman_runs,
 CAST(CASE WHEN CAST(round(l_tax * 100) AS INT) IN (0,1) THEN 1 ELSE 0 END AS INT) AS extra_runs,
 CASE WHEN CAST(round(l_discount * 100) AS INT) = 7 THEN 'PLAYER_' || CAST(l_partkey % 80 AS VARCHAR(8)) END AS player_dismissed
FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
 UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1, l_discount, l_tax FROM lineitem WHERE l_partkey % 10 = 3) l) d
"""


def _nulls_first(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in cols.split(","))


SILVER_MATCHES = f"""
SELECT *, CAST(date AS DATE) AS match_date,
 match_type IN ('Final', 'Qualifier', 'Eliminator') AS is_playoff,
 toss_winner = winner AS toss_winner_won
FROM (SELECT * FROM raw_matches WHERE result <> 'no result'
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_nulls_first(
    "season, city, date, match_type, venue, team1, team2, toss_winner, toss_decision, "
    "winner, result, player_of_match")}) = 1) m
"""

SILVER_DELIVERIES = f"""
SELECT *, batsman_runs IN (4, 6) AS is_boundary, batsman_runs = 6 AS is_six,
 batsman_runs = 4 AS is_four, batsman_runs = 0 AND extra_runs = 0 AS is_dot_ball,
 player_dismissed IS NOT NULL AS is_wicket_delivery, wide_runs > 0 AS is_wide,
 noball_runs > 0 AS is_noball
FROM (SELECT * FROM raw_deliveries
 WHERE batsman IS NOT NULL AND bowler IS NOT NULL AND batsman_runs IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY match_id, inning, "over", ball, batsman, bowler
  ORDER BY {_nulls_first("wide_runs, noball_runs, batsman_runs, extra_runs, player_dismissed, total_runs")}) = 1) d
"""


def _n(flag: str) -> str:
    return f"CAST(sum(CAST({flag} AS INT)) AS BIGINT)"


BATSMAN_STATS = f"""
SELECT *, CASE WHEN overall_rank <= 10 THEN 'Elite' WHEN overall_rank <= 30 THEN 'Top Performer'
 WHEN overall_rank <= 60 THEN 'Regular' ELSE 'Occasional' END AS performance_tier
FROM (SELECT *,
 round(total_runs / balls_faced * 100, 2) AS strike_rate,
 round(CASE WHEN times_dismissed = 0 THEN total_runs ELSE total_runs / times_dismissed END, 2) AS batting_average,
 round(total_runs / matches_played, 2) AS avg_runs_per_match,
 round(boundaries / balls_faced * 100, 2) AS boundary_pct,
 CAST(rank() OVER (ORDER BY total_runs DESC NULLS LAST) AS INT) AS overall_rank
 FROM (SELECT batsman, CAST(sum(batsman_runs) AS BIGINT) AS total_runs, count(ball) AS balls_faced,
  {_n("is_boundary")} AS boundaries, {_n("is_six")} AS sixes, {_n("is_four")} AS fours,
  {_n("is_dot_ball")} AS dot_balls, count(DISTINCT match_id) AS matches_played,
  {_n("is_wicket_delivery")} AS times_dismissed
  FROM silver_deliveries WHERE is_wide = false GROUP BY batsman
  HAVING count(DISTINCT match_id) >= 10) a) b
"""

BOWLER_STATS = f"""
SELECT *, CAST(rank() OVER (ORDER BY economy_rate ASC NULLS FIRST) AS INT) AS economy_rank,
 CAST(rank() OVER (ORDER BY total_wickets DESC NULLS LAST) AS INT) AS wickets_rank
FROM (SELECT *, round(runs_conceded / (balls_bowled / 6), 2) AS economy_rate,
 round(runs_conceded / total_wickets, 2) AS bowling_average,
 round(balls_bowled / total_wickets, 2) AS bowling_strike_rate,
 round(dot_balls / balls_bowled * 100, 2) AS dot_ball_pct
 FROM (SELECT bowler, {_n("is_wicket_delivery")} AS total_wickets,
  CAST(sum(total_runs) AS BIGINT) AS runs_conceded, count(ball) AS balls_bowled,
  {_n("is_dot_ball")} AS dot_balls, {_n("is_wide")} AS wides, {_n("is_noball")} AS noballs,
  count(DISTINCT match_id) AS matches
  FROM silver_deliveries GROUP BY bowler) a
 WHERE matches >= 10 AND total_wickets >= 10) b
"""

TEAM_SEASON_WINS = """
SELECT season, winner, wins,
 CAST(sum(wins) OVER (PARTITION BY winner ORDER BY season
  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_3season_wins,
 CAST(rank() OVER (PARTITION BY season ORDER BY wins DESC) AS INT) AS season_rank
FROM (SELECT season, winner, count(id) AS wins FROM silver_matches
 WHERE winner IS NOT NULL AND winner <> '' GROUP BY season, winner) w
"""

INNINGS_RUNS = """
SELECT match_id, inning, CAST(sum(total_runs) AS BIGINT) AS inning_total_runs
FROM silver_deliveries GROUP BY match_id, inning
"""

MATCH_SUMMARY = """
SELECT m.id, m.season, m.match_date, m.venue, m.city, m.team1, m.team2, m.toss_winner,
 m.toss_decision, m.winner, m.result, m.is_playoff, m.toss_winner_won,
 r.inning_total_runs AS innings1_runs, m.player_of_match
FROM silver_matches m LEFT JOIN (SELECT * FROM innings_runs WHERE inning = 1) r ON m.id = r.match_id
"""

# name -> (sql, dependencies), in dependency order
_CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_matches": (RAW_MATCHES, ()),
    "raw_deliveries": (RAW_DELIVERIES, ()),
    "silver_matches": (SILVER_MATCHES, ("raw_matches",)),
    "silver_deliveries": (SILVER_DELIVERIES, ("raw_deliveries",)),
    "batsman_stats": (BATSMAN_STATS, ("silver_deliveries",)),
    "bowler_stats": (BOWLER_STATS, ("silver_deliveries",)),
    "team_season_wins": (TEAM_SEASON_WINS, ("silver_matches",)),
    "innings_runs": (INNINGS_RUNS, ("silver_deliveries",)),
    "match_summary": (MATCH_SUMMARY, ("silver_matches", "innings_runs")),
}


def _with(final: str, *uses: str) -> str:
    needed: set[str] = set()

    def visit(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for dep in _CTES[name][1]:
                visit(dep)

    for name in uses:
        visit(name)
    ctes = [f"{name} AS ({sql.strip()})" for name, (sql, _) in _CTES.items() if name in needed]
    return "WITH " + ",\n".join(ctes) + "\n" + final.strip()


ORACLE_SQL: dict[str, str] = {
    "bronze_matches": _with("SELECT * FROM raw_matches", "raw_matches"),
    "bronze_deliveries": _with("SELECT * FROM raw_deliveries", "raw_deliveries"),
    "silver_matches": _with("SELECT * FROM silver_matches", "silver_matches"),
    "silver_deliveries": _with("SELECT * FROM silver_deliveries", "silver_deliveries"),
    "batsman_stats": _with("SELECT * FROM batsman_stats", "batsman_stats"),
    "bowler_stats": _with("SELECT * FROM bowler_stats", "bowler_stats"),
    "team_season_wins": _with("SELECT * FROM team_season_wins", "team_season_wins"),
    "innings_runs": _with("SELECT * FROM innings_runs", "innings_runs"),
    "match_summary": _with("SELECT * FROM match_summary", "match_summary"),
    "q1_top_scorers": _with("""
SELECT overall_rank, batsman, total_runs, strike_rate, batting_average, performance_tier
FROM batsman_stats WHERE overall_rank <= 10 ORDER BY overall_rank""", "batsman_stats"),
    "q2_best_economy": _with("""
SELECT economy_rank, bowler, total_wickets, economy_rate, bowling_average, dot_ball_pct
FROM bowler_stats WHERE economy_rank <= 10 ORDER BY economy_rank""", "bowler_stats"),
    "q3_team_form": _with("""
SELECT season, winner, wins, rolling_3season_wins, season_rank FROM team_season_wins
WHERE season >= (SELECT max(season) FROM team_season_wins) - 4
ORDER BY season, season_rank""", "team_season_wins"),
    "q4_toss_rate": _with("""
SELECT toss_decision, count(id) AS total_matches,
 CAST(sum(CAST(toss_winner_won AS INT)) AS BIGINT) AS toss_winner_won,
 round(sum(CAST(toss_winner_won AS INT)) / count(id) * 100, 2) AS win_pct_after_toss
FROM match_summary GROUP BY toss_decision""", "match_summary"),
    "q5_top_venues": _with("""
SELECT venue, round(avg(innings1_runs), 1) AS avg_1st_innings, count(id) AS matches_hosted,
 CAST(max(innings1_runs) AS BIGINT) AS highest_score
FROM match_summary WHERE innings1_runs IS NOT NULL GROUP BY venue HAVING count(id) >= 5
ORDER BY avg_1st_innings DESC, venue LIMIT 5""", "match_summary"),
    "q6_all_rounders": _with("""
SELECT b.batsman AS player, b.total_runs, b.batting_average, b.strike_rate,
 w.total_wickets, w.economy_rate
FROM batsman_stats b JOIN bowler_stats w ON b.batsman = w.bowler
WHERE b.total_runs >= 500 AND w.total_wickets >= 50
ORDER BY b.total_runs DESC""", "batsman_stats", "bowler_stats"),
    "top_wicket_takers": _with("""
SELECT wickets_rank, bowler, total_wickets, economy_rate, dot_ball_pct
FROM bowler_stats WHERE wickets_rank <= 10 ORDER BY wickets_rank""", "bowler_stats"),
    "team_total_wins": _with("""
SELECT winner, CAST(sum(wins) AS BIGINT) AS total_wins FROM team_season_wins
GROUP BY winner ORDER BY total_wins DESC""", "team_season_wins"),
    "part_quantity_rank": """
SELECT l_partkey, total_quantity,
 CAST(rank() OVER (ORDER BY total_quantity DESC NULLS LAST) AS INT) AS quantity_rank
FROM (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS total_quantity
 FROM lineitem GROUP BY l_partkey) p""".strip(),
    "venue_rank": _with("""
SELECT id, venue, CAST(rank() OVER (ORDER BY venue NULLS FIRST) AS INT) AS venue_rank
FROM silver_matches""", "silver_matches"),
}
