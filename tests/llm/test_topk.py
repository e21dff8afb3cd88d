import math
import random

import numpy as np

from reelrank.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v int, shard string, score int"


def plain(rows, every, k):
    vectors = {}
    for r in rows:
        e = r.embedding
        if r.vec_id is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            vectors[r.vec_id] = [math.floor(256 * x) for x in e]
    out = []
    for q, v in vectors.items():
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors.items() if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_whole_table(spark, sf):
    frame = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = frame.collect()
    assert sorted(map(tuple, topk.op7_exact_topk(frame).collect())) == plain(rows, 50, 5)
    many = topk.top_products(frame, every=7, k=3, shard_rows=40, query_rows=20)
    assert sorted(map(tuple, many.collect())) == plain(rows, 7, 3)


def test_ties_and_hot_vector(spark):
    random.seed(1)
    rows = [(i, [0.5, -0.25, 1.0] if i % 3 == 0 else [random.choice([-1.0, 0.0, 0.5]) for _ in range(3)], 0, 0, "", 0) for i in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_products(frame, every=10, k=5, shard_rows=90, query_rows=15)
    assert sorted(map(tuple, got.collect())) == plain(frame.collect(), 10, 5)


def test_clustered_vectors_reach_few_cells(spark):
    random.seed(3)
    hubs = [[random.gauss(0, 1) for _ in range(24)] for _ in range(16)]
    rows = [(i, [x + random.gauss(0, 0.05) for x in hubs[i % 16]], 0, 0, "", 0) for i in range(1600)]
    frame, shipped = spark.createDataFrame(rows, SCHEMA), []
    got = topk.top_products(frame, every=10, k=5, shard_rows=50, query_rows=40, shipped=shipped)
    assert sorted(map(tuple, got.collect())) == plain(frame.collect(), 10, 5)
    sent, everything = shipped[0]
    assert sent < 0.4 * everything


def test_ball_bounds_hold():
    rng = np.random.default_rng(5)
    x, q = rng.integers(-900, 900, (300, 9)), rng.integers(-900, 900, (40, 9))
    cells = topk.Cells(x, 20)
    cell = cells.place(x)
    assert len(set(cell.tolist())) == 20 == len(cells.centres)
    radius = np.array([np.sqrt(((x[cell == c] - cells.centres[c]) ** 2).sum(axis=1)).max() for c in range(20)])
    best = np.array([[(x[cell == c] @ y).max() for c in range(20)] for y in q])
    assert (topk.ball_bounds(q, cells.centres, radius) >= best).all()
    tree = topk.Tree(np.arange(300), x, leaf=8)
    assert (tree.bounds(q)[:, 0] >= (q @ x.T).max(axis=1)).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (50, [0.1, -0.1]),
            (50, [0.1, -0.1]), (None, [1.0, 1.0]), (6, [1.0, 2.0]), (100, None)]
    frame = spark.createDataFrame([(*r, 1, 2, "s", 3) for r in rows], SCHEMA)
    assert sorted(map(tuple, topk.op7_exact_topk(frame).collect())) == plain(frame.collect(), 50, 5)
    assert topk.op7_exact_topk(frame.where("vec_id = 0")).count() == 0
    assert topk.op7_exact_topk(frame.where("false")).count() == 0
