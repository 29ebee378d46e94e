"""Column-expression builders (JVM-side built-ins only, no UDFs)."""

from crease.functions.flags import delivery_flags, match_flags
from crease.functions.metrics import count_true, rounded_ratio, tier

__all__ = ["count_true", "delivery_flags", "match_flags", "rounded_ratio", "tier"]
