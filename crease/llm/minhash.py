"""Near-duplicate documents by circulant MinHash.

Signature: one permutation (a bijective hash cut to ``SLOTS`` slots) shuffles
the shingles, a second one is a stored random permutation of the slots that is
shifted circularly once per coordinate, so two permutations make all ``bands *
rows`` coordinates.  Documents that agree on all rows of a band share a bucket.

Links are confirmed on the full shingle sets.  Inside a bucket not all pairs
are made.  Texts that are the same are one node.  Round 1 checks each node
against the representatives of its buckets: of a bucket's members, the one that
meets the most others in all its buckets, so the one nearest to the middle of a
group of edited copies.  Round 2 takes the members of a representative that are
still in several components, and of the pairs across these only those that can
be links after round 1: what both share with the representative is enough, or
they share shingles that it has not.  The latter are found by a join on the
rarest of these, which lets a pair through only where the sizes and the shingles
still to come leave room for a link (a prefix and a positional filter, both
exact).  Pairs inside a component cannot change the result.  So each bucket pair
ends up in one component, is ruled out by an exact bound, or is checked.

A pair at similarity 0.75 shares none of 32 bands of 4 rows with probability
5e-6 (less above); that is the only way a link can be missed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease.llm import _text
from crease.llm._common import map_rows, saved, whole_text
from crease.llm.components import components
from crease.operators.dedup import dedup_keep_first

SLOTS = 1 << 20


@lru_cache(maxsize=2)
def _circle(coordinates: int) -> np.ndarray:
    """Row ``i``: the stored permutation at slots ``i, i+1, ...`` going round."""
    order = np.random.default_rng(20240229).permutation(SLOTS).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(
        np.concatenate([order, order[:coordinates - 1]]), coordinates)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """All coordinates for one non-empty set of 64-bit shingle hashes."""
    circle = _circle(coordinates)
    slots = (_text.mix(shingles) >> np.uint64(44)).astype(np.int64)
    low = None
    for at in range(0, len(slots), 8192):
        part = circle[slots[at:at + 8192]].min(axis=0)
        low = part if low is None else np.minimum(low, part)
    return low


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket key per band; a band takes every ``bands``-th coordinate."""
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for row in sig.reshape(rows, bands):
        key = _text.mix(key * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64))
    return key.view(np.int64)


def _lowered_shingles(column: pa.Array, words: int) -> list[np.ndarray]:
    data, offsets = _text.utf8(column)
    out: list[np.ndarray] = []
    for a, b in _text.groups(offsets):
        part = _text.LOWER[data[offsets[a]:offsets[b]]]
        out += _text.shingle_hashes(_text.Words(part, offsets[a:b + 1] - offsets[a]), words)
    return out


def _node(text) -> F.Column:
    """128 bits of the text."""
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


def _confirmed(edges: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``edges(a, b)`` with the ``size`` of the full set of ``a``, that of its
    intersection with the one of ``b``, ``both``, whether the pair is a link, and the
    shingles of ``a`` that ``b`` has not, ``rest``."""

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets: dict[bytes, np.ndarray] = {}
        for side in "ab":
            nodes = batch.column(side).to_pylist()
            new = [i for i, x in enumerate(nodes) if sets.setdefault(x, None) is None]
            found = _lowered_shingles(batch.column(f"{side}_text").take(pa.array(new, pa.int64())),
                                      words)
            sets.update(zip((nodes[i] for i in new), found, strict=True))
        size, shared, link, rest = [], [], [], []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = sets[a], sets[b]
            rest.append(np.setdiff1d(x, y, assume_unique=True).view(np.int64))
            both = len(x) - len(rest[-1])
            size.append(len(x))
            shared.append(both)
            link.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.record_batch({"a": batch.column("a"), "b": batch.column("b"),
                                "size": pa.array(size, pa.int64()),
                                "both": pa.array(shared, pa.int64()),
                                "link": pa.array(link, pa.bool_()),
                                "rest": pa.array(rest, pa.list_(pa.int64()))})

    pairs = (edges.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
             .join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b"))
    return saved(map_rows(pairs.select("a", "b", "a_text", "b_text"), check,
                          "a binary, b binary, size bigint, both bigint, link boolean, "
                          "rest array<bigint>"), "checked")


def _may_link(both: str, percent: int) -> F.Column:
    """Whether sets of ``x.size`` and ``y.size`` that share ``both`` are a link."""
    return F.expr(f"100 * ({both}) >= {percent} * (x.size + y.size - ({both}))")


def _by_rest(near: DataFrame, percent: int) -> DataFrame:
    """``(a, b)`` across components of those that share shingles their representative has
    not, enough of them to be a link.

    A partner of a set shares ``percent`` of it, so ``need`` shingles at least
    besides the representative's; of these one is among all but the ``need - 1``
    most frequent ones, on both sides.  Where two sets meet first, they share no
    more than this shingle and what comes after it in both.
    """
    each = near.withColumn("need", F.greatest(F.lit(1).cast("bigint"), F.floor(
        (F.lit(percent) * F.col("size") + 99) / 100) - F.col("both")))
    each = each.withColumn("shingle", F.explode("rest")).drop("rest")
    often = saved(each.groupBy("rep", "shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"),
        F.max("component").alias("hi")).where("lo <> hi").drop("lo", "hi"), "often")
    own = Window.partitionBy("node", "rep")
    rare = each.join(often, ["rep", "shingle"]) \
        .withColumn("at", F.row_number().over(own.orderBy("n", "shingle"))) \
        .withColumn("after", F.count(F.lit(1)).over(own) - F.col("at")) \
        .where("after >= need - 1").drop("at", "n", "need")
    rare = saved(rare, "rare")
    return rare.alias("x").join(rare.alias("y"), F.expr(
        "x.rep = y.rep AND x.shingle = y.shingle AND x.component < y.component")
        & _may_link("least(x.both, y.both) + 1 + least(x.after, y.after)", percent)) \
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    return (members.join(label, "node", "left")
            .withColumn("component", F.coalesce("component", "node")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    words: int = 5, percent: int = 75, bands: int = 32,
                    rows: int = 4) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, node)``, one row per input row;
    ``node`` names the text.

    ``component_id`` is the smallest id reachable over links, ``kept`` marks
    the document that carries it.  A NULL text has no words; a document
    without words is linked with nothing and is its own component.  Rows are
    told apart by their text: repeated rows, and rows that share an id, get
    the component of their own text.  NULL ids do not become a component id
    unless the component has no other id; then it is NULL and its rows are
    kept.  Other columns of ``docs`` are not read.  An empty table gives an
    empty result.
    """
    source = docs.select(F.col(id_col).alias("doc"), whole_text(text_col).alias("text"))
    source = source.select("doc", "text", _node(F.col("text")).alias("node"))

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _lowered_shingles(batch.column("text"), words)
        keys = [band_keys(signature(s, bands * rows), bands, rows) if len(s) else None
                for s in sets]
        return pa.record_batch({
            "doc": batch.column("doc"), "node": batch.column("node"),
            "size": pa.array([len(s) for s in sets], pa.int64()),
            "keys": pa.array(keys, pa.list_(pa.int64()))})

    kind = docs.schema[id_col].dataType.simpleString()
    base = saved(map_rows(source, describe,
                          f"doc {kind}, node binary, size bigint, keys array<bigint>"), "base")

    nodes = saved(base.where("size > 0").groupBy("node").agg(
        F.min("doc").alias("first"), F.first("size").alias("size"),
        F.first("keys").alias("keys")), "nodes")
    spread = nodes.select("node", F.explode("keys").alias("bucket"))
    shared = saved(spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                   "buckets")
    members = saved(spread.join(shared, "bucket"), "members")
    involved = saved(members.groupBy("node").agg(F.sum("n").alias("company")), "involved")
    reps = saved(members.select("node", "bucket").join(involved, "node").groupBy("bucket")
                 .agg(F.max(F.struct("company", "node")).alias("rep"))
                 .select("bucket", F.col("rep.node").alias("rep")), "reps")
    pairs = saved(members.join(reps, "bucket").where("node <> rep")
                  .select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    involved = involved.select("node")
    # the same kind of join at every size, so that small runs tell of large ones
    texts = saved(source.join(involved.hint("merge"), "node", "left_semi")
                  .select("node", "text"), "texts")
    texts = saved(texts.groupBy("node").agg(F.first("text").alias("text")), "texts")

    # round 1: each node with the representatives of its buckets
    checked = _confirmed(pairs, texts, words, percent)

    # round 2: pairs across the components that a representative still has
    label = components(checked.where("link"))
    known = _labelled(checked.select(F.col("a").alias("node"), F.col("b").alias("rep"),
                                     "size", "both", "rest"), label)
    known = saved(known, "known")
    several = saved(known.groupBy("rep").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo <> hi").select("rep"), "several")
    near = saved(known.join(several, "rep"), "near")
    # who shares less with the representative needs other shingles with any partner
    inside = near.drop("rest").where(100 * F.col("both") >= percent * F.col("size"))
    inside = inside.alias("x").join(inside.alias("y"), F.expr(
        "x.rep = y.rep AND x.component < y.component")
        & _may_link("least(x.both, y.both)", percent)) \
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    cross = inside.unionByName(_by_rest(near, percent)).distinct()
    seen = checked.select("a", "b").unionByName(
        checked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    cross = saved(saved(cross, "across").join(seen, ["a", "b"], "left_anti"), "cross")
    links = checked.unionByName(_confirmed(cross, texts, words, percent)).where("link")

    label = components(links)
    owner = saved(_labelled(nodes.select("node", "first"), label), "owner")
    lowest = saved(owner.groupBy("component").agg(F.min("first").alias("component_id")), "lowest")
    of_node = saved(owner.join(lowest, "component").select("node", "component_id"), "of_node")
    out = base.select("doc", "node", "size").join(of_node, "node", "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc"))
    return out.select(
        F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"), "node")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with the same columns; of
    rows that repeat an id and its text, the one whose columns sort first stays."""
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept") \
        .select(F.col("doc_id").alias("doc"), "node").distinct()
    kept = saved(kept, "kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col(f"row.`{id_col}`").alias("doc"),
                       _node(whole_text(F.col(f"row.`{text_col}`"))).alias("node"))
    stay = rows.join(kept, rows["doc"].eqNullSafe(kept["doc"]) & (rows["node"] == kept["node"]),
                     "left_semi")
    return dedup_keep_first(stay, ["doc", "node"]).select("row.*")
