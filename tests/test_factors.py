"""Packed ALS: equal to plain normal equations whatever the blocks and rounds, and no shuffle outlives its round."""

import os
import subprocess
import sys
import tempfile

import numpy as np
import pytest
from pyspark.errors import PySparkException

from reelrank.operators import als, factors
from reelrank.session import shuffles_dropped
from reelrank.sources import tables

#: Every user rated some movies, user 0 all of them, and one pair comes twice.
ROWS = sorted({(u, m, float(1 + (u * m) % 5)) for u in range(12) for m in range(9) if u == 0 or (u + m) % 3}) + [(1, 1, 4.0)]


def plain(rank, iters, reg, seed):
    """The same iterations with dense matrices."""
    u, m, r = (np.array(x) for x in zip(*ROWS))
    left = factors.first_vectors(np.arange(12), rank, seed).astype(float)
    for _ in range(iters):
        right = one_side(m, u, r, left, 9, reg)
        left = one_side(u, m, r, right, 12, reg)
    return left, right


def one_side(ids, others, r, vs, n, reg):
    out = np.zeros((n, vs.shape[1]))
    for i in range(n):
        v = vs[others[ids == i]]
        out[i] = np.linalg.solve(v.T @ v + reg * len(v) * np.eye(vs.shape[1]), v.T @ r[ids == i])
    return out


@pytest.mark.parametrize("rank", [3, 20])
def test_factors_equal_plain_normal_equations_in_many_blocks_and_rounds(spark, rank, monkeypatch):
    data = spark.createDataFrame(ROWS, "uid int, mid int, score double")
    for name, value in (("LEAST_RATINGS", 30), ("ROUND_BYTES", 4 * rank * len(ROWS) // 2), ("STEP_BYTES", 400)):
        monkeypatch.setattr(factors, name, value)
    assert factors.blocks_for(len(ROWS), rank, 16) > 2
    model = als.als_fit(data, rank=rank, iters=2, reg=0.1, seed=7)
    for got, want in zip((model.userFactors, model.itemFactors), plain(rank, 2, 0.1, 7)):
        mine = {r.id: r.features for r in got.collect()}
        assert sorted(mine) == list(range(len(want)))
        assert np.allclose([mine[i] for i in sorted(mine)], want, atol=1e-4)
    missed = factors.equation_misses(model.userFactors, model.itemFactors, data, rank, 0.1).collect()
    assert {r.id: r.n for r in missed} == {u: sum(x[0] == u for x in ROWS) for u in range(12)}
    assert all(r.miss < 1e-4 * r["size"] for r in missed)
    wrong = factors.equation_misses(model.userFactors, model.itemFactors, data, rank, 0.2).collect()
    assert all(r.miss > 1e-4 * r["size"] for r in wrong)


def test_products_hold_each_known_pair(spark, monkeypatch):
    monkeypatch.setattr(factors, "LEAST_RATINGS", 2)
    v = {i: [float(i + 1), 1.0 - i] for i in range(5)}
    left = spark.createDataFrame(list(v.items()), "id int, features array<float>")
    pairs = [(0, 1), (4, 3), (0, 1), (2, 2), (1, 9), (9, 1), (None, 1)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for cosine in (False, True):
        got = sorted((r.a, r.b, round(r.x, 6)) for r in factors.products(df, "a", "b", left, left, "x", 2, cosine).collect())
        length = lambda i: np.linalg.norm(v[i]) if cosine else 1.0
        assert got == sorted((a, b, round(float(np.dot(v[a], v[b]) / length(a) / length(b)), 6)) for a, b in pairs[:4])


def test_a_null_id_fails_the_fit_and_no_row_too(spark):
    with pytest.raises(PySparkException):
        als.als_fit(spark.createDataFrame([(1, None, 2.0), (1, 2, 3.0)], "uid int, mid int, score double"), rank=2, iters=1)
    with pytest.raises(ValueError):
        als.als_fit(spark.createDataFrame([], "uid int, mid int, score double"), rank=2, iters=1)


def test_block_column_equals_block_of(spark):
    ids = [-2**31, -7, 0, 1, 5, 2**31 - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "id int").select("id", factors.block_col("id", 13).alias("b")).collect()
    assert [r.b for r in rows] == factors.block_of(np.array(ids), 13).tolist()


def test_a_stored_table_leaves_no_shuffle_behind():
    code = ("import sys, glob; sys.path.insert(0, %r)\n"
            "from reelrank.session import build_session\nfrom reelrank.sources.tables import stored\n"
            "s = build_session(master='local[2]', shuffle_partitions=2)\n"
            "n = stored(s.range(100).selectExpr('id %% 7 AS k').groupBy('k').count(), 'x').count()\n"
            "import time; time.sleep(2)\n"
            "print('LEFT', n, len(glob.glob(sys.argv[1] + '/**/shuffle_0_*', recursive=True)))\n")
    root, local = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), tempfile.mkdtemp()
    env = os.environ | {"SPARK_LOCAL_DIRS": local}
    out = subprocess.run([sys.executable, "-c", code % root, local], capture_output=True, text=True, timeout=200, env=env).stdout
    assert "LEFT 7 0" in out


def test_the_setting_of_the_session_comes_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    with shuffles_dropped(spark), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == was and tables.stored(spark.range(3), "x").count() == 3
