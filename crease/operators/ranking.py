"""Global ranks without a single-partition window.

``rank().over(Window.orderBy(k))`` moves every row to one task.  Here the rank
of a key is ``1 + (rows ordered strictly before it)``, computed the same way at
every size and for every orderable type:

1. One row per distinct key with its row count (partial aggregation before the
   shuffle, so a key holding a third of all rows is one row after the map side).
2. Spark's range partitioner deals the keys into ordered ranges of about equal
   numbers of *distinct* keys; a row's partition is its bucket.  Placing a key is
   a binary search, so its cost hardly depends on the number of buckets.
3. Inside a bucket, a running sum over the sorted keys.  Keys, buckets and sums
   are stored once: the partitioner samples, and nothing may sample twice.
4. The totals of the buckets come out of the same job as an observed metric (one
   number per bucket, so a size set by the parameter); their prefix sums are
   the offsets.
5. ``rank = 1 + offset + running sum``, joined back on the key (null-safe).

Several ranks of one table go through these steps together.  NULL keys sort as
Spark does: first when ascending, last when descending.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from crease.session import ensure_checkpoint_dir

#: ``(key, descending, name)``
Spec = tuple[str, bool, str]

# distinct rows below which another bucket is not worth a task
BUCKET_ROWS = 1000

_SPEC, _N, _B, _BEFORE, _END = "__spec", "__n", "__bucket", "__before", "__end"


def _key(i: int) -> str:
    return f"__key{i}"


def _order(key: str | Column, descending: bool) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return column.desc_nulls_last() if descending else column.asc_nulls_first()


def _per_key(df: DataFrame, specs: list[Spec]) -> DataFrame:
    """Rows per distinct key of each spec: column ``_key(i)`` holds the keys of spec ``i``."""
    if len(specs) == 1:
        keys = df.select(F.lit(0).alias(_SPEC), F.col(specs[0][0]).alias(_key(0)))
    else:
        keys = df.select(F.inline(F.array(*[F.struct(
            F.lit(i).alias(_SPEC),
            *[(F.col(key) if i == j else F.lit(None).cast(df.schema[key].dataType))
              .alias(_key(j)) for j, (key, _, _) in enumerate(specs)])
            for i in range(len(specs))])))
    return keys.groupBy(_SPEC, *map(_key, range(len(specs)))).agg(F.count(F.lit(1)).alias(_N))


def _running_counts(df: DataFrame, specs: list[Spec], buckets: int
                    ) -> tuple[DataFrame, list[list[int]]]:
    """``(spec, keys, bucket, rows before in its bucket)``, stored, and for each spec
    the rows before each bucket."""
    keys = [_key(i) for i in range(len(specs))]
    # within a spec only its own key varies
    order = [F.col(_SPEC), *[_order(_key(i), desc) for i, (_, desc, _) in enumerate(specs)]]
    ranged = (_per_key(df, specs).repartitionByRange(buckets, *order)
              .withColumn(_B, F.spark_partition_id()))
    rows = Window.partitionBy(_SPEC, _B).orderBy(*order[1:])
    counted = ranged.select(
        _SPEC, *keys, _B,
        F.coalesce(F.sum(_N).over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         .alias(_BEFORE),
        F.when(F.lead(F.lit(1)).over(rows).isNull(),
               F.sum(_N).over(rows.rowsBetween(Window.unboundedPreceding, 0))).alias(_END))
    totals = Observation()
    observed = counted.observe(totals, F.collect_list(F.when(
        F.col(_END).isNotNull(), F.struct(_SPEC, _B, _END))).alias("ends"))
    stored = observed.drop(_END).checkpoint(eager=True)
    offsets = [[0] * buckets for _ in specs]
    for spec, bucket, end in totals.get["ends"]:
        offsets[spec][bucket] = end
    return stored, [[0, *accumulate(ends)][:-1] for ends in offsets]


def global_ranks(df: DataFrame, specs: list[Spec], *, buckets: int | None = None,
                 bucket_rows: int = BUCKET_ROWS, checkpoint: bool = True) -> DataFrame:
    """Append one rank column per ``(key, descending, name)``.

    ``buckets`` is the most tasks that share the sort of the distinct keys, by
    default the session's shuffle partitions; a table of few rows takes one per
    ``bucket_rows``.

    The input is read for the counts and for the join back, so with
    ``checkpoint`` it is written once to the session's checkpoint folder (an
    eager job), which also cuts the lineage: a lost executor does not recompute
    the upstream.  Pass ``checkpoint=False`` for a table that is stored already.
    """
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    ensure_checkpoint_dir(df.sparkSession)
    columns = df.columns
    if checkpoint:
        size = Observation()
        df = df.observe(size, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
        buckets = max(1, min(buckets, size.get["rows"] * len(specs) // bucket_rows))
    stored, offsets = _running_counts(df, specs, buckets)
    out = df
    for i, (key, _, name) in enumerate(specs):
        # a constant array of one number per bucket
        before = F.split(F.lit(",".join(map(str, offsets[i]))), ",")[F.col(_B)].cast("bigint")
        ranks = stored.where(F.col(_SPEC) == i).select(
            F.col(_key(i)), (F.lit(1) + before + F.col(_BEFORE)).cast("int").alias(name))
        # null-safe: NULL keys rank too
        out = out.join(ranks, F.col(key).eqNullSafe(F.col(_key(i))), "inner").drop(_key(i))
    return out.select(*columns, *[name for _, _, name in specs])


def global_rank(df: DataFrame, key: str, *, descending: bool = False, name: str = "rank",
                **options) -> DataFrame:
    """Append ``name`` = SQL ``RANK() OVER (ORDER BY key [DESC])`` (gaps, ties kept)."""
    return global_ranks(df, [(key, descending, name)], **options)


def top_ranked(df: DataFrame, key: str, n: int, *, descending: bool = False, name: str = "rank",
               checkpoint: bool = True) -> DataFrame:
    """The rows whose ``RANK() OVER (ORDER BY key [DESC])`` is at most ``n``, with that
    rank as ``name``; ties can make them more than ``n``.

    Nothing else is ranked: the first ``n`` distinct keys (a top-k over the
    counts per key, ``n`` rows a task) are enough to know the rank of each key up to
    ``n``, and these at most ``n`` keys are broadcast to pick the rows, so that any
    number of rows may tie.  ``checkpoint`` as in ``global_ranks``.
    """
    if n < 1:
        return df.limit(0).withColumn(name, F.lit(0))
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    first = (df.groupBy(F.col(key).alias(_key(0))).agg(F.count(F.lit(1)).alias(_N))
             .orderBy(_order(_key(0), descending)).limit(n))
    before = Window.orderBy(_order(_key(0), descending)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = first.select(_key(0), (F.lit(1) + F.coalesce(F.sum(_N).over(before), F.lit(0)))
                         .cast("int").alias(name)).where(F.col(name) <= n)
    return (df.join(F.broadcast(ranks), F.col(key).eqNullSafe(F.col(_key(0))), "inner")
            .select(*df.columns, name))
