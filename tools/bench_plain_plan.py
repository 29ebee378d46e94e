"""

Swaps in what a straightforward DataFrame job would do: ``dropDuplicates``
(arbitrary survivor), ``rank()`` over a window without partitioning, also where only
the first ranks are shown, one-level ``count(DISTINCT)`` career totals, and a pass over
the balls for each board.
Timing is ``bench.time_queries`` (same warm-up and best-of-N).  Run from the
repo root: ``python tools/bench_plain_plan.py``; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import crease.operators.gold as gold  # noqa: E402
import crease.operators.reports as reports  # noqa: E402
import crease.operators.silver as silver  # noqa: E402
import crease.plans.catalog as catalog  # noqa: E402
from bench import time_queries  # noqa: E402
from crease.session import local_session  # noqa: E402


def _window_ranks(df, specs, **_):
    return df.withColumns({
        name: F.rank().over(Window.orderBy(F.col(key).desc() if desc else F.col(key)))
        for key, desc, name in specs})


def _window_rank(df, key, descending=False, name="rank", **_):
    return _window_ranks(df, [(key, descending, name)])


def _flat_career(deliveries, player, aggs, matches_alias):
    return deliveries.groupBy(player).agg(
        *[expr.alias(n) for n, expr in aggs.items()],
        F.count_distinct("match_id").alias(matches_alias))


def _window_top(df, key, n, descending=False, name="rank", **_):
    return _window_rank(df, key, descending, name).where(F.col(name) <= n)


def main() -> None:
    catalog.global_rank = _window_rank
    silver.dedup_keep_first = lambda df, keys: df.dropDuplicates(list(keys))
    gold.global_rank, gold.global_ranks = _window_rank, _window_ranks
    gold._career = _flat_career
    gold.boards = lambda d: (gold.batting_board(d), gold.bowling_board(d))
    reports.top_ranked = _window_top
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"),
                          shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "8")))
    times = time_queries(spark, dict(catalog.QUERIES), sf_dir)
    print(json.dumps({"metric": "plain_plan_total_seconds",
                      "value": round(sum(times.values()), 3), "queries": times}))
    spark.stop()


if __name__ == "__main__":
    main()
