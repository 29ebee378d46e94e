"""Plans: the stage runner, the query registry and its oracle SQL."""
