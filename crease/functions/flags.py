"""Row-level indicator columns computed once in Silver.

Flags stay nullable on purpose: a NULL input gives a NULL flag, and the Gold
filters (``is_wide = false``) and ratios rely on that three-valued logic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Boundary run values and match types treated as playoffs.
BOUNDARY_RUNS = (4, 6)
FOUR_RUNS = 4
SIX_RUNS = 6
PLAYOFF_TYPES = ("Final", "Qualifier", "Eliminator")


def delivery_flags() -> dict[str, Column]:
    """The seven per-ball indicators, in output order."""
    runs = F.col("batsman_runs")
    return {
        "is_boundary": runs.isin(*BOUNDARY_RUNS),
        "is_six": runs == SIX_RUNS,
        "is_four": runs == FOUR_RUNS,
        "is_dot_ball": (runs == 0) & (F.col("extra_runs") == 0),
        "is_wicket_delivery": F.col("player_dismissed").isNotNull(),
        "is_wide": F.col("wide_runs") > 0,
        "is_noball": F.col("noball_runs") > 0,
    }


def match_flags() -> dict[str, Column]:
    """Playoff flag and toss-advantage flag (NULL when there is no winner)."""
    return {
        "is_playoff": F.col("match_type").isin(*PLAYOFF_TYPES),
        "toss_winner_won": F.col("toss_winner") == F.col("winner"),
    }
