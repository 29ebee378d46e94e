"""Deterministic ``dropDuplicates``.

``dropDuplicates(keys)`` keeps whichever row a task happens to see first, so
the survivor can change with partitioning.  Here the survivor is fixed: the
row whose remaining columns, compared left to right with NULLs first, are
smallest.  That equals ``row_number() over (partition by keys order by rest
nulls first) = 1`` but runs as a grouped ``min(struct)``, so Spark combines
duplicates map-side before the shuffle and a hot key never reaches one task
with all of its copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW = "__kept"


def dedup_keep_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ``keys``; columns keep their input order."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias(_ROW))
    return kept.select(
        *[F.col(c) if c in keys else F.col(_ROW).getField(c).alias(c) for c in df.columns]
    )
