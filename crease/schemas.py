"""Schemas of the raw CSV inputs; files are bound to them by column name."""

from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def _schema(spec: str) -> StructType:
    kinds = {"int": IntegerType(), "string": StringType()}
    return StructType([StructField(name, kinds[kind]) for name, kind in
                       (item.split() for item in spec.split(","))])


# The columns of the raw files.  Dirty text (a season such as
# "2007/08", a date) stays as it is until silver casts it.
MATCHES_SCHEMA = _schema(
    "id int, season string, city string, date string, match_type string, "
    "player_of_match string, venue string, team1 string, team2 string, "
    "toss_winner string, toss_decision string, winner string, result string, "
    "result_margin int, target_runs int, target_overs int, super_over string, "
    "method string, umpire1 string, umpire2 string"
)

DELIVERIES_SCHEMA = _schema(
    "match_id int, inning int, batting_team string, bowling_team string, over int, "
    "ball int, batsman string, non_striker string, bowler string, is_super_over int, "
    "wide_runs int, bye_runs int, legbye_runs int, noball_runs int, penalty_runs int, "
    "batsman_runs int, extra_runs int, total_runs int, player_dismissed string, "
    "dismissal_kind string, fielder string"
)

# columns a raw file must have; the others are NULL where a file lacks them
MATCHES_REQUIRED = ["id", "season", "result"]
DELIVERIES_REQUIRED = ["match_id", "inning", "over", "ball", "batsman", "bowler", "batsman_runs",
                       "total_runs"]

MATCH_KEY = ["id"]
DELIVERY_KEY = ["match_id", "inning", "over", "ball", "batsman", "bowler"]
