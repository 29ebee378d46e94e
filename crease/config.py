"""Analysis thresholds.  Defaults are the reference pipeline's fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # Fixed values (must equal the reference for identical leaderboards).
    min_matches_batsman: int = 10
    min_matches_bowler: int = 10
    min_wickets_bowler: int = 10
    rolling_seasons: int = 3
    recent_seasons: int = 5
    top_n: int = 10
    top_venues: int = 5
    min_venue_matches: int = 5
    all_rounder_runs: int = 500
    all_rounder_wickets: int = 50
