import random

import numpy as np
import pytest

from reelrank.operators import content, sparse


def test_tokens_and_similarity(spark):
    movies = spark.createDataFrame(
        [(1, "a", "Action|Comedy"), (2, "b", "Action|Comedy"), (3, "c", "Drama|Western"),
         (4, "d", "Action|Crime"), (5, "e", "Horror")],
        "mid int, name string, genres string")
    words = {r.mid: r.words for r in content.content_words(movies).collect()}
    assert words[1] == ["action", "comedy"] and words[5] == ["horror"]
    pairs = {(r.mid, r.mid2): r.sim for r in content.content_similarity(movies).collect()}
    # same bag of words → cosine 1 both ways, never a self pair
    assert abs(pairs[(1, 2)] - 1.0) < 1e-12 and abs(pairs[(2, 1)] - 1.0) < 1e-12
    assert not any(a == b for a, b in pairs)
    # drama and western hash to the same bucket: movie 3 shares nothing with the others
    assert not any(3 in k for k in pairs)


def test_double_separator_gives_empty_token(spark):
    movies = spark.createDataFrame([(1, "a", "Action||Comedy")], "mid int, name string, genres string")
    assert content.content_words(movies).first().words == ["action", "", "comedy"]


def test_limit_is_exact_and_signatures_lose_nothing(spark):
    genres = ["Action|Comedy", "Action|Crime", "Drama|Western", "Horror", "Comedy|Drama"]
    movies = spark.createDataFrame([(i, "m", genres[i * i % 5]) for i in range(1, 40)], "mid int, name string, genres string")
    key = lambda r: (r.mid, r.rank, r.mid2)
    full = content.content_similarity(movies, k=1000).collect()
    for k in (1, 5):
        assert {key(r) for r in content.content_similarity(movies, k=k).collect()} == {key(r) for r in full if r.rank <= k}
    members, pairs = content.content_signatures(movies)
    sid = {r.mid: r.sid for r in members.collect()}
    similar = {(r.sid, r.sid2) for r in pairs.collect()}
    assert {(r.mid, r.mid2) for r in full} == {(a, b) for a in sid for b in sid if a != b and (sid[a], sid[b]) in similar}


@pytest.mark.parametrize("features", [20, 1 << 18])
def test_inverted_lists_equal_block_products(spark, features):
    rng = random.Random(6)
    words = ["action", "comedy", "crime", "drama", "horror", "war", "music", "history", "tv", "western"]
    movies = spark.createDataFrame([(i, "m", "|".join(rng.choices(words, weights=range(10, 0, -1), k=rng.randrange(1, 5)))) for i in range(150)],
                                   "mid int, name string, genres string")
    members, pairs = content.content_signatures_wide(movies, n_features=features)
    sid = {r.mid: r.sid for r in members.collect()}
    sims = {(r.sid, r.sid2): r.sim for r in pairs.collect()}
    feats = {r.mid: r.features.toArray() for r in content.content_features(movies, features).collect()}
    ids = sorted(set(sid.values()))
    unit = {i: feats[i] / np.linalg.norm(feats[i]) for i in ids}
    want = {(a, b): float(unit[a] @ unit[b]) for a in ids for b in ids if unit[a] @ unit[b] > 0.6}
    assert set(sims) == set(want) and all(abs(sims[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("block_rows", [3, 4096])
@pytest.mark.parametrize("threshold", [0.05, 0.6, 0.95])
def test_sparse_join_equals_brute_force(spark, block_rows, threshold):
    """Dimension 0 is in nearly every vector, and vectors 0 to 19 are equal."""
    rng = np.random.default_rng(3)
    vecs = {i: {0: 1.0, 7: 2.0} for i in range(20)}
    for i in range(20, 90):
        vecs[i] = {int(d): float(rng.normal()) for d in rng.choice(40, size=rng.integers(1, 7), replace=False)} | ({0: 1.5} if i % 8 else {})
    entries = spark.createDataFrame([(i, d, w) for i, v in vecs.items() for d, w in v.items()], "sid int, dim int, w double")
    got = {(r.sid, r.sid2): r.sim for r in sparse.sparse_cosine_pairs(entries, threshold, block_rows).collect()}
    mat = np.zeros((90, 40))
    for i, v in vecs.items():
        for d, w in v.items():
            mat[i, d] = w
    mat /= np.linalg.norm(mat, axis=1)[:, None]
    sim = mat @ mat.T
    want = {(a, b): sim[a, b] for a in range(90) for b in range(90) if a != b and sim[a, b] > threshold}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_sparse_join_needs_a_shared_dimension(spark):
    with pytest.raises(ValueError):
        sparse.sparse_cosine_pairs(spark.createDataFrame([], "sid int, dim int, w double"), 0.0)
    assert sparse.sparse_cosine_pairs(spark.createDataFrame([], "sid int, dim int, w double"), 0.5).count() == 0
