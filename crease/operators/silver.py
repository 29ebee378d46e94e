"""Silver layer: clean matches, flag and deduplicate deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from crease.functions.flags import delivery_flags, match_flags
from crease.operators.dedup import dedup_keep_first
from crease.schemas import DELIVERY_KEY, MATCH_KEY

# Result label of abandoned matches and the raw date format.
NO_RESULT = "no result"
DATE_FORMAT = "yyyy-MM-dd"


def valid_matches(raw: DataFrame) -> DataFrame:
    """Matches with a result other than no-result, and the season as a number; dirty
    text becomes NULL."""
    return (raw.filter(F.col("result") != NO_RESULT)
               .withColumn("season", F.col("season").try_cast("int")))


def flag_matches(df: DataFrame, date_type: DataType, date_format: str = DATE_FORMAT) -> DataFrame:
    """``match_date``, from a ``date`` of type ``date_type``, and the match flags."""
    if isinstance(date_type, DateType):
        match_date = F.col("date")
    elif isinstance(date_type, (TimestampType, TimestampNTZType)):
        match_date = F.col("date").cast("date")
    else:
        match_date = F.try_to_date(F.col("date").cast("string"), date_format)
    return df.withColumn("match_date", match_date).withColumns(match_flags())


def clean_matches(raw: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    """Drop no-result (and NULL-result) matches, one row per ``id``.

    Adds ``match_date``, ``is_playoff`` and ``toss_winner_won``.  Dirty
    ``season``/``date`` text becomes NULL instead of failing the job.
    """
    df = dedup_keep_first(valid_matches(raw), MATCH_KEY)
    return flag_matches(df, raw.schema["date"].dataType, date_format)


def enrich_deliveries(raw: DataFrame) -> DataFrame:
    """Drop balls without batsman, bowler or batsman runs; dedup; add 7 flags."""
    df = raw.filter(F.col("batsman").isNotNull() & F.col("bowler").isNotNull()
                    & F.col("batsman_runs").isNotNull())
    return dedup_keep_first(df, DELIVERY_KEY).withColumns(delivery_flags())
