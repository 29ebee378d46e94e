"""Hard negatives by inner product over cover trees.

Candidates are integer vectors.  In a shard each gets one more coordinate, the
root of ``M^2 - |x|^2`` (``M`` the largest norm), which puts all of them on one
sphere without changing inner products with a query that has 0 there.  A tree
covers the shard with balls of angles: the centres below a node are chosen
farthest-first among its members, beginning with its own centre, until half
its radius covers them or the fan-out is reached; each child knows the angle
that covers all below it.  A query at angle ``t`` of a centre has inner products
between ``|q| M cos(t + r)`` and ``|q| M cos(t - r)`` with all in the ball.

A query row asks windows ``low <= score <= high`` for their best few rows.  Nodes
are taken best bound first; one that can hold nothing for a window (all too
low, all too high, or not better than what the window has) is skipped for it, and
the rows of a leaf are scored exactly in integers.

Rows are dealt to shards by the nearest of some pivots, themselves chosen
farthest-first in a bounded sample, so a shard is a ball too; a pivot with many
rows has several shards.  Queries go to the stored trees in blocks of bounded
size.  Which rows share a shard or a block changes no result.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from crease.llm._common import map_batches, saved, ship, work_path
from crease.llm.vector_codes import integers, limb_bits, limb_products, limbs, usable

#: rows of a shard, about; rows scored together; children of a node
SHARD_ROWS, LEAF, FAN = 8192, 256, 16
#: rows from which pivots are chosen, and pivots at most
SAMPLE, PIVOTS = 4096, 512
#: query rows sent to the trees at once, and searched together in a task
BLOCK, TOGETHER = 8192, 256
#: balls below this angle are not split: float64 cannot tell their rows apart
SMALL = 1e-6

_NEVER, _LAST = np.int64(-(1 << 62)), np.int64((1 << 63) - 1)


def farthest_first(unit: np.ndarray, most: int, first: int = 0, enough: float = 0.0
                   ) -> tuple[list[int], np.ndarray]:
    """Places of up to ``most`` centres among rows of length 1, from ``first`` on, until
    each row is within the angle ``enough`` of one; and each row's centre."""
    centres, owner = [first], np.zeros(len(unit), np.int64)
    near = unit @ unit[first]
    while len(centres) < most:
        far = int(near.argmin())
        if np.arccos(min(1.0, max(-1.0, near[far]))) <= enough or far in centres:
            break
        to_new = unit @ unit[far]
        owner[to_new > near] = len(centres)
        owner[far] = len(centres)
        np.maximum(near, to_new, out=near)
        near[far] = 2.0  # never again
        centres.append(far)
    return centres, owner


class Tree:
    """``points`` in the order of the leaves, and the nodes: ``node[i]`` has a centre
    (its place in ``points``), the range of points below it, its children's
    range and its smallest id; ``angle[i]`` covers all below it, -1 if they are
    all equal.  Children of a node are next to one another."""

    def __init__(self, points, ids, uids, labels, node, angle, top):
        self.points, self.ids, self.uids, self.labels = points, ids, uids, labels
        self.node, self.angle, self.top = node, angle, top

    @classmethod
    def of(cls, points: np.ndarray, ids: np.ndarray, uids: np.ndarray, labels: np.ndarray) -> Tree:
        order = np.argsort(ids, kind="stable")  # members stay in the order of ids
        points, ids, uids, labels = points[order], ids[order], uids[order], labels[order]
        square = (points.astype(np.float64) ** 2).sum(axis=1)
        top = float(np.sqrt(square.max(initial=0)))
        rest = np.sqrt(np.maximum(0, top * top - square))
        unit = np.column_stack([points, rest]) / (top or 1.0)
        nodes: list[list[int]] = []
        angles: list[float] = []
        place = np.empty(len(points), np.int64)  # of each point in the order of the leaves
        done = 0

        def add(centre: int, members: np.ndarray) -> tuple[int, np.ndarray]:
            same = (points[members] == points[members[0]]).all()
            nodes.append([centre, 0, 0, 0, 0, int(ids[members[0]])])
            angles.append(-1.0 if same else float(np.arccos(np.clip(
                (unit[members] @ unit[centre]).min(), -1, 1))) + SMALL)
            return len(nodes) - 1, members

        stack = [add(0, np.arange(len(points)))]
        while stack:  # depth first, so what is below a node is one range of leaves
            at, members = stack.pop()
            if members is None:
                nodes[at][2] = done
                continue
            nodes[at][1] = done
            if len(members) <= LEAF or angles[at] < 2 * SMALL:
                place[done:done + len(members)] = members
                done += len(members)
                nodes[at][2] = done
                continue
            first = int(np.searchsorted(members, nodes[at][0]))
            centres, owner = farthest_first(unit[members], FAN, first, angles[at] / 2)
            if len(centres) == 1:  # float64 sees no difference: one leaf
                place[done:done + len(members)] = members
                done += len(members)
                nodes[at][2] = done
                continue
            nodes[at][3] = len(nodes)
            below = [add(int(members[c]), members[owner == k]) for k, c in enumerate(centres)]
            nodes[at][4] = len(nodes)
            stack.append((at, None))
            stack += below
        node = np.array(nodes, np.int64)
        back = np.empty(len(place), np.int64)
        back[place] = np.arange(len(place))
        node[:, 0] = back[node[:, 0]]
        return cls(points[place], ids[place], uids[place], labels[place], node,
                   np.array(angles), top)

    SCHEMA = "width int, top double, points binary, ids binary, uids binary, labels binary, " \
             "node binary, angle binary"

    def to_row(self) -> dict[str, list]:
        return {"width": [self.points.shape[1]], "top": [self.top],
                "points": [self.points.astype("<i4").tobytes()],
                "ids": [self.ids.astype("<i8").tobytes()],
                "uids": [self.uids.astype("<i8").tobytes()],
                "labels": [self.labels.astype("<i8").tobytes()],
                "node": [self.node.astype("<i8").tobytes()],
                "angle": [self.angle.astype("<f8").tobytes()]}

    @classmethod
    def from_row(cls, row: dict) -> Tree:
        def numbers(name: str, kind: str = "<i8") -> np.ndarray:
            return np.frombuffer(row[name], kind)

        return cls(numbers("points", "<i4").reshape(-1, row["width"]), numbers("ids"),
                   numbers("uids"), numbers("labels"), numbers("node").reshape(-1, 6),
                   numbers("angle", "<f8"), row["top"])


class Windows:
    """Windows of some query rows and the best rows found for each.

    ``of`` names the query row of each window; ``best`` and ``best_id`` hold its rows,
    higher scores first, smaller ids among equal ones."""

    def __init__(self, queries: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray,
                 labels: np.ndarray, uids: np.ndarray, same_label: bool, most: int):
        self.bits = limb_bits(queries.shape[1])
        self.queries = limbs(queries, self.bits)
        self.norm = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        self.of, self.low, self.high = of, low, high
        self.labels, self.uids, self.same_label = labels, uids, same_label
        self.best = np.full((len(of), most), _NEVER)
        self.best_id = np.full((len(of), most), _LAST)

    def better(self, w: np.ndarray, score: np.ndarray, ids: np.ndarray | int) -> np.ndarray:
        """Whether a row of this score and id would be among the best of window ``w``."""
        last, last_id = self.best[w, -1], self.best_id[w, -1]
        if score.ndim == 2:
            last, last_id = last[:, None], last_id[:, None]
        return (score > last) | ((score == last) & (ids < last_id))

    def reach(self, tree: Tree, points: list[np.ndarray], nodes: np.ndarray, w: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
        """``[window, node]``: whether the node may hold rows for the window, and the
        highest score there can be."""
        rows, inverse = np.unique(self.of[w], return_inverse=True)
        product = limb_products([q[rows] for q in self.queries],
                                [p[tree.node[nodes, 0]] for p in points], self.bits)
        span = self.norm[rows, None] * tree.top
        angle = np.arccos(np.clip(product / np.maximum(span, 1e-300), -1, 1))
        covers, slack = tree.angle[nodes], 1e-6 * span + 1e-6
        upper = np.floor(span * np.cos(np.maximum(0, angle - covers)) + slack).astype(np.int64)
        lower = np.ceil(span * np.cos(np.minimum(np.pi, angle + covers)) - slack).astype(np.int64)
        equal = covers < 0  # one vector: the product itself
        upper[:, equal], lower[:, equal] = product[:, equal], product[:, equal]
        upper, lower = upper[inverse], lower[inverse]
        may = (upper >= self.low[w, None]) & (lower <= self.high[w, None])
        may &= self.better(w, upper, tree.node[nodes, 5][None, :])
        return may, upper

    def take(self, tree: Tree, points: list[np.ndarray], start: int, stop: int, w: np.ndarray
             ) -> None:
        """Score points ``start:stop`` for windows ``w`` and keep the best."""
        rows, inverse = np.unique(self.of[w], return_inverse=True)
        score = limb_products([q[rows] for q in self.queries], [p[start:stop] for p in points],
                              self.bits)[inverse]
        ids, row = tree.ids[start:stop], self.of[w, None]
        fits = self.better(w, score, ids[None, :])
        fits &= (score >= self.low[w, None]) & (score <= self.high[w, None])
        same = tree.labels[start:stop][None, :] == self.labels[row]
        fits &= same if self.same_label else ~same
        fits &= tree.uids[start:stop][None, :] != self.uids[row]
        at, point = np.nonzero(fits)
        if not len(at):
            return
        most = self.best.shape[1]
        touched = np.unique(at)
        window = np.concatenate([np.repeat(touched, most), at])
        scores = np.concatenate([self.best[w[touched]].ravel(), score[at, point]])
        found = np.concatenate([self.best_id[w[touched]].ravel(), ids[point]])
        order = np.lexsort((found, -scores, window))
        window = window[order]
        first = np.searchsorted(window, touched)
        pick = order[first[:, None] + np.arange(most)]  # each has at least what it had
        self.best[w[touched]], self.best_id[w[touched]] = scores[pick], found[pick]

    def search(self, tree: Tree) -> None:
        """Best-first descent for all windows together: the node with the highest bound
        of any window is next, for the windows it still matters to."""
        points = limbs(tree.points.astype(np.int64), self.bits)
        tie = itertools.count()
        every = np.arange(len(self.of))
        may, upper = self.reach(tree, points, np.array([0]), every)
        heap = [(0, next(tie), 0, every[may[:, 0]], upper[may[:, 0], 0])]
        while heap:
            _, _, at, w, bound = heapq.heappop(heap)
            _, start, stop, child, end, least = tree.node[at].tolist()
            still = self.better(w, bound, least)  # windows may have filled since
            w = w[still]
            if not len(w):
                continue
            if child == end:
                for a in range(start, stop, LEAF):
                    self.take(tree, points, a, min(stop, a + LEAF), w)
                continue
            may, upper = self.reach(tree, points, np.arange(child, end), w)
            for k in range(end - child):
                kept = may[:, k]
                if kept.any():
                    bounds = upper[kept, k]
                    heapq.heappush(heap, (-int(bounds.max()), next(tie), child + k, w[kept],
                                          bounds))


# -- the stored index


def _rows(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, v``: rows with an id, a label and a usable vector of the common width."""
    given = rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                        F.col(f"`{label_col}`").cast("bigint").alias("label"),
                        F.col(f"`{vector_col}`").alias("v"))
    given = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("v"))
    first = given.agg(F.min(F.struct("id", F.size("v").alias("width")))["width"].alias("width"),
                      F.count(F.lit(1)).alias("n")).first()
    return given.where(F.size("v") == F.lit(first["width"])), first["width"], first["n"]


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    return vectors / np.maximum(norm, 1e-300)[:, None]


def build_index(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                label_col: str = "label", scale: int = 256, shard_rows: int = SHARD_ROWS
                ) -> tuple[DataFrame, DataFrame]:
    """``(points, trees)``, both stored: one row per usable row (``uid, id, label, q,
    pivot``; ``q`` the floored integers), and one tree per shard.

    Rows without an id, a label or a usable vector (see ``vector_codes``), or of
    another width than the row with the smallest id, take no part.  Repeated rows
    are rows of their own, told apart by ``uid``.
    """
    given, width, n = _rows(rows, id_col, vector_col, label_col)
    width = width or 0
    pivots = min(PIVOTS, -(-n // shard_rows))
    heads = np.zeros((1, width))
    if pivots > 1:
        # a sample of bounded size, the same whatever the partitions
        order = [F.xxhash64("v"), F.col("id")]
        sample = given.select("v", "id").orderBy(*order).limit(SAMPLE).collect()
        unit = _unit(np.floor(scale * np.array([r["v"] for r in sample], np.float64)))
        heads = unit[farthest_first(unit, pivots)[0]]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = integers(batch.column("v"), width, scale)
            raw = q.astype("<i4").tobytes()
            size = 4 * width
            yield pa.record_batch({
                "uid": batch.column("uid"), "id": batch.column("id"),
                "label": batch.column("label"),
                "q": pa.array([raw[a:a + size] for a in range(0, len(raw), size)], pa.binary()),
                "pivot": pa.array((_unit(q) @ heads.T).argmax(axis=1), pa.int32())})

    numbered = given.select(F.monotonically_increasing_id().alias("uid"), "id", "label", "v")
    points = saved(map_batches(
        numbered, assign, "uid bigint, id bigint, label bigint, q binary, pivot int"), "points")
    # as many rows as pivots
    held = {r["pivot"]: r["n"] for r in points.groupBy("pivot").agg(F.count("*").alias("n"))
            .collect()}
    salts = F.create_map(*[F.lit(x) for p, c in held.items() for x in (p, -(-c // shard_rows))]) \
        if held else F.create_map(F.lit(0), F.lit(1))
    shard = points.withColumn("salt", F.pmod(
        F.col("uid").bitwiseAND((1 << 33) - 1) + F.shiftright("uid", 33), salts[F.col("pivot")]))

    def grow(table: pa.Table) -> pa.Table:
        q = np.frombuffer(b"".join(table.column("q").to_pylist()), "<i4").reshape(-1, width)
        tree = Tree.of(q, *(table.column(c).to_numpy() for c in ("id", "uid", "label")))
        return pa.table(tree.to_row()).cast(pa.schema(
            [("width", pa.int32()), ("top", pa.float64()),
             *((c, pa.binary()) for c in ("points", "ids", "uids", "labels", "node", "angle"))]))

    ship(rows.sparkSession)
    trees = saved(shard.groupBy("pivot", "salt").applyInArrow(grow, Tree.SCHEMA), "trees")
    return points, trees


def _search(trees: DataFrame, parts: list[tuple], same_label: bool, most: int) -> DataFrame:
    """``(w, rank, score, id)``: the best rows of each window over all trees.  ``parts``
    are the queries with their windows, a few query rows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [(first, Windows(*part, same_label, most)) for first, *part in parts]
        for batch in batches:
            for at in range(batch.num_rows):
                tree = Tree.from_row(batch.slice(at, 1).to_pylist()[0])
                for _, windows in asked:
                    windows.search(tree)
        for first, windows in asked:
            w, k = np.nonzero(windows.best > _NEVER)
            yield pa.record_batch({"w": pa.array(w + first), "score": pa.array(windows.best[w, k]),
                                   "id": pa.array(windows.best_id[w, k])})

    found = map_batches(trees, run, "w bigint, score bigint, id bigint")
    # a window has at most ``most`` rows of each task
    place = F.row_number().over(Window.partitionBy("w").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= most)


def _parts(queries: list, of: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple]:
    """Windows (sorted by ``of``) with their query rows, ``TOGETHER`` query rows at a time."""
    out = []
    for a in range(0, len(queries), TOGETHER):
        part = queries[a:a + TOGETHER]
        lo, hi = np.searchsorted(of, [a, a + len(part)])
        if lo < hi:
            out.append((int(lo), np.array([np.frombuffer(r["q"], "<i4") for r in part], np.int64),
                        of[lo:hi] - a, low[lo:hi], high[lo:hi],
                        np.array([r["label"] for r in part], np.int64),
                        np.array([r["uid"] for r in part], np.int64)))
    return out


RESULT = StructType([StructField(c, IntegerType() if c == "rank" else LongType()) for c in (
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])


def hard_negatives(rows: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 5,
                   low_percent: int = 80, id_col: str = "vec_id", label_col: str = "label",
                   block: int = BLOCK, **options) -> DataFrame:
    """``RESULT``: for each row where ``is_anchor`` (a condition on ``id``) holds, its
    best ``positives`` other rows of the same label, and for each of these the best
    ``negatives`` rows of another label that score at least ``low_percent``
    percent of the positive and no more than it.

    Scores are inner products of the floored integers; equal ones are ordered by
    id.  Rows that take no part are named in ``build_index``.  Repeated rows
    are others to one another, and a repeated anchor gives its rows repeatedly.  A
    positive below 0 has no negatives; an empty table gives no rows.
    """
    spark = rows.sparkSession
    points, trees = build_index(rows, id_col=id_col, label_col=label_col, **options)
    path = work_path(spark, "negatives")
    anchors = points.where(is_anchor).select("uid", "id", "label", "q").toLocalIterator()
    blocks = 0
    while queries := list(itertools.islice(anchors, block)):
        n = len(queries)
        wide = np.full(n, _LAST)
        parts = _parts(queries, np.arange(n), -wide, wide)
        # at most ``block * positives`` rows
        best = sorted((r["w"], r["rank"], r["id"], r["score"])
                      for r in _search(trees, parts, True, positives).collect())
        best = [(w, i, s) for w, _, i, s in best if s >= 0]
        # positives of one score share a window
        windows = sorted({(w, -s) for w, _, s in best})
        number = {key: k for k, key in enumerate(windows)}
        of = np.array([w for w, _ in windows], np.int64)
        high = np.array([-s for _, s in windows], np.int64)
        low = -(-low_percent * high // 100)
        found = _search(trees, _parts(queries, of, low, high), False, negatives)
        asked = spark.createDataFrame(
            [(number[w, -s], queries[w]["id"], i, s) for w, i, s in best],
            "w bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        found.join(F.broadcast(asked), "w").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")
        ).write.parquet(f"{path}/block-{blocks}")
        blocks += 1
    if not blocks:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(f"{path}/*")
