"""Vector codes and hard negatives against brute force and the SQL."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from crease.llm import cover_tree, vector_codes
from crease.llm.oracle import ORACLE_SQL
from crease.llm.queries import op11_vector_codes, op12_hard_negatives
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, row string, id string, code string"


def awkward(seed=3, n=260, width=32):
    """Clusters, equal vectors under several ids, ties, and every unusable row."""
    rng = random.Random(seed)
    heads = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(n):
        head = rng.choice(heads)
        vector = [x + rng.uniform(-0.2, 0.2) for x in head] if i % 9 else heads[0]
        rows.append((i, [float(np.float32(x)) for x in vector], rng.choice([0, 1, 2, 9])))
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [None] * width, 1), (n + 3, rows[0][1], None),
             (n + 4, [math.nan] * width, 1), (n + 5, [math.inf] * width, 0),
             (n + 6, [1.0] * (2 * width), 1), (n + 7, [0.0] * width, 1), (n + 7, [0.0] * width, 1)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    rows = awkward()
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return frame.repartition(5), rows


def kept(rows, labelled=False):
    """Usable rows as ``(id, integers, label)`` in the order of ids."""
    out = []
    for i, v, label in sorted(rows, key=lambda r: r[0]):
        if v and all(x is not None and math.isfinite(x) for x in v) and \
                (label is not None or not labelled):
            out.append((i, [math.floor(256 * x) for x in v], label))
    return [r for r in out if len(r[1]) == len(out[0][1])]


def codes_by_hand(rows, parts=16, entries=64, rounds=2):
    rows = kept(rows)
    w = len(rows[0][1]) // parts
    cut = [[v[p * w:p * w + w] for p in range(parts)] for _, v, _ in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e)
                   for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = {}
            for c in cut:
                found.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for e, xs in found.items():
                books[p][e] = [sum(x[k] for x in xs) // len(xs) for k in range(w)]
    last = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    flat = ",".join(str(x) for book in books for c in book for x in c)
    return ([("".join(f"{e:02x}" for _, e in x), sum(d for d, _ in x)) for x in last],
            hashlib.sha256(flat.encode()).hexdigest())


def test_codes_equal_brute_force(vectors):
    frame, rows = vectors
    expected, sha = codes_by_hand(rows)
    usable = kept(rows)
    by_label = {}
    for (_, _, label), (_, error) in zip(usable, expected, strict=True):
        by_label[label] = by_label.get(label, 0) + error
    got = vector_codes.compress(frame).collect()
    assert sorted((r.row.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(
        (i, code, error, by_label[label])
        for (i, _, label), (code, error) in zip(usable, expected, strict=True))
    assert {r.codebooks_sha256 for r in got} == {sha}
    assert {(r.row.row, r.row.id, r.row.code) for r in got} == {("x", "y", "z")}


def test_codes_decode_to_vectors_of_that_error(vectors):
    frame, rows = vectors
    books = vector_codes.train(frame, entries=7, rounds=1)
    coded = vector_codes.encode(frame, books).select("row.vec_id", "code", "error")
    by_id = {i: v for i, v, _ in kept(rows)}
    for r in vector_codes.decode(coded, books).collect():
        assert sum((a - b) ** 2 for a, b in zip(by_id[r.vec_id], r.decoded, strict=True)) \
            == r.error
    odd = coded.limit(1).select(F.explode(F.array(
        F.lit(None).cast("string"), F.lit("zz"), F.lit("ff" * 16), F.lit("00"))).alias("code"))
    assert [r.decoded for r in vector_codes.decode(odd, books).collect()] == [None] * 4


def test_limb_products_are_exact():
    rng = np.random.default_rng(5)
    for size in (8, 1 << 20, 1 << 27):
        a = rng.integers(-size, size, (7, 33))
        b = rng.integers(-size, size, (5, 33))
        exact = a.astype(object) @ b.T.astype(object)
        assert (vector_codes.exact_products(a, b).astype(object) == exact).all()
    top = np.full((1, 32), (1 << 27) - 1)
    assert vector_codes.exact_products(top, -top)[0, 0] == -32 * ((1 << 27) - 1) ** 2


def test_codes_of_few_no_and_too_large_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vector_codes.compress(none).count() == 0
    unusable = spark.createDataFrame([(1, None, 1, "", "", "")], SCHEMA)
    assert vector_codes.compress(unusable).count() == 0
    one = spark.createDataFrame([(None, [0.5] * 16, None, "", "", "")] * 3, SCHEMA)
    assert [(r.code, r.error, r.label_error) for r in vector_codes.compress(one).collect()] \
        == [("00" * 16, 0, 0)] * 3
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.train(one, parts=5)
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30] * 16, 1, "", "", "")],
                                                    SCHEMA)).collect()


def negatives_by_hand(rows, every=100, low=80, most=5):
    rows = kept(rows, labelled=True)
    out = []
    for a, (anchor, q, label) in enumerate(rows):
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, other == label)
                        for b, (i, v, other) in enumerate(rows) if b != a)
        for minus, positive, _ in [s for s in scored if s[2]][:most]:
            fits = [(s, i) for s, i, same in scored
                    if not same and -low * minus <= -100 * s <= -100 * minus]
            out += [(anchor, positive, k + 1, i, -minus, -s)
                    for k, (s, i) in enumerate(fits[:most])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block", [(8192, 8192), (40, 3)])
def test_hard_negatives_equal_brute_force(vectors, shard_rows, block):
    frame, rows = vectors
    got = cover_tree.hard_negatives(frame, F.col("id") % 5 == 0, shard_rows=shard_rows, block=block)
    assert got.schema == cover_tree.RESULT
    expected = negatives_by_hand(rows, every=5)
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert len(expected) > 300


def test_hard_negatives_of_empty_and_repeated_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cover_tree.hard_negatives(none, F.col("id") % 5 == 0).count() == 0
    one = [1.0, 0.0]
    rows = [(0, one, 1), (0, one, 1), (3, one, 2), (None, one, 2), (4, [-1.0, 0.0], 2)]
    frame = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    got = cover_tree.hard_negatives(frame, F.col("id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 0, 1, 3, 65536, 65536)] * 2


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(2)
    heads = rng.normal(0, 200, (30, 16))
    points = (heads[rng.integers(0, 30, 6000)] + rng.normal(0, 4, (6000, 16))).astype(np.int64)
    points[:900] = points[0]  # equal rows
    n = len(points)
    tree = cover_tree.Tree.of(points, np.arange(n), np.arange(n), np.zeros(n, np.int64))
    assert sorted(tree.ids.tolist()) == list(range(n))
    assert (points[tree.ids] == tree.points).all()
    top = tree.top
    rest = np.sqrt(np.maximum(0, top ** 2 - (tree.points.astype(float) ** 2).sum(axis=1)))
    unit = np.column_stack([tree.points, rest]) / top
    for (centre, start, stop, child, end, least), angle in zip(tree.node, tree.angle, strict=True):
        assert least == tree.ids[start:stop].min()
        if angle < 0:
            assert (tree.points[start:stop] == tree.points[start]).all()
        else:
            assert np.arccos(np.clip(unit[start:stop] @ unit[centre], -1, 1)).max() <= angle
        if child < end:  # children share out the range
            assert tree.node[child:end, 1].min() == start
            assert (tree.node[child:end, 2] - tree.node[child:end, 1]).sum() == stop - start
    scored = []
    windows = cover_tree.Windows(points[1000:1001], np.array([0]), np.array([0]),
                                 np.array([1 << 40]), np.array([1]), np.array([-1]), False, 5)
    take = windows.take
    windows.take = lambda t, p, a, b, w: (scored.append(b - a), take(t, p, a, b, w))
    windows.search(tree)
    score = points @ points[1000]
    order = sorted(range(n), key=lambda i: (-score[i], i))[:5]
    assert windows.best_id[0].tolist() == order
    assert sum(scored) < n / 4


@pytest.mark.parametrize("name,query", [("op11_vector_codes", op11_vector_codes),
                                        ("op12_hard_negatives", op12_hard_negatives)])
def test_registered_queries_equal_their_sql(spark, name, query):
    con = duckdb.connect()
    path = f"{SF['0.001']}/embeddings.parquet"
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    table = con.sql(ORACLE_SQL[name]).to_arrow_table()
    got = query(spark, SF["0.001"])
    assert sorted(tuple(r) for r in got.select(*table.column_names).collect()) \
        == sorted(tuple(r.values()) for r in table.to_pylist())
