"""crease: ball-by-ball cricket analytics as composable Spark DataFrame functions.

Layers follow the medallion layout: raw/bronze -> silver (clean, flag, dedup)
-> gold (career leaderboards, team form, match summary) -> reports.  Public
functions map DataFrames to a lazy DataFrame, but for ranks and boards:
``global_rank``, ``global_ranks``, ``top_ranked``, ``boards`` and the leaderboards
and reports built on them run checkpoint jobs when called.  Other actions are run
by sinks alone.
"""

from crease.config import Thresholds
from crease.operators.dedup import dedup_keep_first
from crease.operators.gold import (
    batsman_stats,
    batting_board,
    boards,
    bowler_stats,
    bowling_board,
    innings_runs,
    match_summary,
    team_season_wins,
)
from crease.operators.ranking import global_rank, global_ranks, top_ranked
from crease.operators.reports import (
    all_rounders,
    best_economy,
    recent_team_form,
    team_total_wins,
    top_scorers,
    top_venues,
    top_wicket_takers,
    toss_decision_rate,
)
from crease.operators.silver import clean_matches, enrich_deliveries
from crease.plans.incremental import update
from crease.plans.stages import Layout, run_pipeline, run_stage
from crease.streaming import ingest_new_files

__all__ = [
    "Thresholds",
    "all_rounders",
    "batsman_stats",
    "best_economy",
    "bowler_stats",
    "clean_matches",
    "dedup_keep_first",
    "enrich_deliveries",
    "global_rank",
    "global_ranks",
    "ingest_new_files",
    "innings_runs",
    "Layout",
    "match_summary",
    "recent_team_form",
    "run_pipeline",
    "run_stage",
    "team_season_wins",
    "team_total_wins",
    "top_scorers",
    "top_venues",
    "top_wicket_takers",
    "top_ranked",
    "toss_decision_rate",
    "update",
]
