"""Aggregate and ratio helpers shared by the Gold builders and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_true(flag: Column | str) -> Column:
    """Number of TRUE values as ``sum(cast(flag as int))``.

    Unlike ``count_if`` this is NULL for a group whose flags are all NULL,
    which is what the leaderboards report.
    """
    return F.sum(_col(flag).cast("int"))


def rounded_ratio(num: Column | str, den: Column | str, scale: float | None = None,
                  digits: int = 2) -> Column:
    """``round(num / den [* scale], digits)`` with NULL instead of an error on 0.

    ``/`` is double division; rounding is Spark's HALF_UP.
    """
    value = F.try_divide(_col(num), _col(den))
    if scale is not None:
        value = value * F.lit(scale)
    return F.round(value, digits)


# Performance tiers by overall rank (inclusive upper bounds).
PERFORMANCE_TIERS = ((10, "Elite"), (30, "Top Performer"), (60, "Regular"))
DEFAULT_TIER = "Occasional"


def tier(rank: Column | str, cutoffs: Sequence[tuple[int, str]] = PERFORMANCE_TIERS,
         default: str = DEFAULT_TIER) -> Column:
    """CASE ladder mapping a rank to the first tier whose bound it does not exceed."""
    rank = _col(rank)
    expr = None
    for bound, label in cutoffs:
        expr = (F.when(rank <= bound, label) if expr is None
                else expr.when(rank <= bound, label))
    return F.lit(default) if expr is None else expr.otherwise(default)
