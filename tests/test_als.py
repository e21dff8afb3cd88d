import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.operators import als
from reelrank.plans.queries import QUERIES
from reelrank.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ratings(spark):
    return fx.ratings(spark, SF).cache()


@pytest.fixture(scope="module")
def model(ratings):
    return als.als_fit(ratings, rank=8, iters=5, reg=0.1)


def test_user_recs_properties(model):
    recs = als.user_recs(model, k=20).collect()
    assert recs
    for r in recs:
        scores = [x.score for x in r.recs]
        assert 0 < len(scores) <= 20
        assert all(s > 0 for s in scores)
        assert scores == sorted(scores, reverse=True)


def test_user_recs_equal_brute_force(model):
    u = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    i = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    mids = np.array(sorted(i))
    mat = np.stack([i[m] for m in mids])
    for r in als.user_recs(model, k=5).limit(20).collect():
        s = mat @ u[r.uid]
        top = np.argsort(-s, kind="stable")[:5]
        assert [x.mid for x in r.recs] == [int(mids[j]) for j in top if s[j] > 0]


def test_same_seed_same_result(ratings, model):
    again = als.als_fit(ratings, rank=8, iters=5, reg=0.1)
    a = {r.uid: [x.mid for x in r.recs] for r in als.user_recs(model, 5).collect()}
    b = {r.uid: [x.mid for x in r.recs] for r in als.user_recs(again, 5).collect()}
    assert a == b


def test_rmse_beats_global_mean_on_training(ratings, model):
    mean = ratings.agg(F.avg("score")).first()[0]
    base = ratings.agg(F.sqrt(F.avg(F.pow(F.col("score") - F.lit(mean), 2)))).first()[0]
    assert als.rating_rmse(model, ratings) < base


def test_item_similarity_threshold(model):
    pairs = als.item_similarity(model, threshold=0.6).collect()
    assert all(p.sim > 0.6 and p.mid != p.mid2 for p in pairs)


def test_same_lists_on_two_and_eight_cores():
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from reelrank.session import build_session\nfrom reelrank.operators import als\n"
            "from reelrank.sources import fixtures as fx\n"
            "s = build_session(master=sys.argv[1], shuffle_partitions=4)\n"
            "m = als.als_fit(fx.ratings(s, %r), rank=6, iters=3)\n"
            "print('LISTS', sorted((r.uid, [x.mid for x in r.recs]) for r in als.user_recs(m, 10).collect()))\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = [subprocess.run([sys.executable, "-c", code % (root, SF), f"local[{n}]"], capture_output=True, text=True,
                          timeout=300).stdout.split("LISTS")[1] for n in (2, 8)]
    assert out[0] == out[1]


def test_last_half_step_solves_the_normal_equations(spark):
    rows = QUERIES["als_fit"](spark, SF).collect()
    assert rows and all(r.solved for r in rows)


def test_split_is_disjoint_and_complete(ratings):
    tr, te = als.train_test_split(ratings)
    assert tr.count() + te.count() == ratings.count()
    assert tr.select("uid", "mid").intersect(te.select("uid", "mid")).count() == 0


def test_grid_search_small(ratings):
    grid = als.als_grid_search(ratings, ranks=[2, 4], regs=[0.1], iters=2)
    rows = grid.collect()
    assert len(rows) == 2 and rows[0].rmse <= rows[1].rmse
    best = als.best_params(grid).collect()
    assert len(best) == 1 and best[0].rmse == rows[0].rmse


def test_user_recs_exclude_seen_equals_brute_force(ratings, model):
    seen = {}
    for r in ratings.select("uid", "mid").collect():
        seen.setdefault(r.uid, set()).add(r.mid)
    u = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    i = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    mids = np.array(sorted(i))
    mat = np.stack([i[m] for m in mids])
    got = {r.uid: [x.mid for x in r.recs] for r in als.user_recs(model, k=5, exclude_seen=True, ratings=ratings).collect()}
    assert got
    for uid, lst in list(got.items())[:40]:
        s = mat @ u[uid]
        order = sorted(range(len(mids)), key=lambda j: (-round(float(s[j]), 12), mids[j]))
        want = [int(mids[j]) for j in order if s[j] > 0 and int(mids[j]) not in seen.get(uid, set())][:5]
        assert lst == want
        assert not set(lst) & seen.get(uid, set())


def test_grid_equals_a_loop_over_the_same_split(ratings):
    fitted = als.als_grid_fit(ratings, ranks=[2, 5], regs=[0.01, 0.3], iters=3)
    grid = {(r["rank"], r["lambda"]): r["rmse"] for r in als.grid_table(ratings.sparkSession, fitted).collect()}
    data = ratings.select("uid", "mid", F.col("score").cast("float").alias("score")).repartition(als.ALS_BLOCKS, "uid").sortWithinPartitions("uid", "mid", "score")
    drawn = data.withColumn("draw", F.rand(als.DEFAULT_SEED)).cache()
    train, test = drawn.where("draw < 0.8").drop("draw").cache(), drawn.where("draw >= 0.8").drop("draw").cache()
    loop = {}
    for rank in (2, 5):
        for reg in (0.01, 0.3):
            model = als.als_estimator(rank, 3, reg).fit(train)
            loop[rank, reg] = als.rmse_of(als.predict_pairs(model, test.select("uid", "mid").distinct()), test).first()["rmse"]
    assert set(grid) == set(loop) and all(abs(grid[k] - loop[k]) < 1e-3 for k in grid)
    assert min(grid, key=grid.get) == min(loop, key=loop.get)
    assert fitted.bestModel.rank == min(grid, key=grid.get)[0]


@pytest.mark.parametrize("name", ["als_user_recs", "als_item_recs"])
def test_list_checks_see_a_wrong_value(spark, name, monkeypatch):
    from reelrank.plans import queries
    assert all(r.ok for r in QUERIES[name](spark, SF).collect())
    if name == "als_user_recs":
        right = queries.als_user_lists
        monkeypatch.setattr(queries, "als_user_lists", lambda s, d: right(s, d).withColumn("score", F.col("score") + F.when(F.col("uid") % 5 == 0, 1e-3).otherwise(0)))
    else:
        right = queries.als_item_lists
        monkeypatch.setattr(queries, "als_item_lists", lambda s, d: right(s, d).where("NOT (rank = 1 AND mid % 5 = 0)"))
    assert not all(r.ok for r in QUERIES[name](spark, SF).collect())
