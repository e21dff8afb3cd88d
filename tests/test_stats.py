from reelrank.operators import stats


def test_genre_rules(spark):
    movies = spark.createDataFrame(
        [(1, "Musical|Drama"), (2, "Music"), (3, "Comedy"), (4, "Drama")], "mid int, genres string")
    ratings = spark.createDataFrame(
        [(1, 1, 4.0, 0), (1, 2, 3.0, 0), (2, 1, 5.0, 0), (2, 3, 3.0, 0)],
        "uid int, mid int, score double, timestamp long")
    genres = stats.genre_table(spark, ["Music", "Drama", "Western", "Comedy"])
    long = stats.genre_top_movies_long(movies, ratings, genres, k=10)
    got = sorted((r.genre, r.rank, r.mid, r.score) for r in long.collect())
    # Music matches Musical; movie 4 has no rating (inner join); Western matches nothing
    assert got == [("Comedy", 1, 3, 3.0), ("Drama", 1, 1, 4.5), ("Music", 1, 1, 4.5), ("Music", 2, 2, 3.0)]
    nested = {r.genres: [x.mid for x in r.recs] for r in stats.genre_top_movies(movies, ratings, genres).collect()}
    assert nested == {"Comedy": [3], "Drama": [1], "Music": [1, 2]}


def test_top_k_ties_by_mid(spark):
    movies = spark.createDataFrame([(i, "Action") for i in range(1, 15)], "mid int, genres string")
    ratings = spark.createDataFrame([(1, i, 3.0, 0) for i in range(1, 15)], "uid int, mid int, score double, timestamp long")
    long = stats.genre_top_movies_long(movies, ratings, stats.genre_table(spark), k=10)
    assert [r.mid for r in long.orderBy("rank").collect()] == list(range(1, 11))


def test_popular_by_month(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 1.0, 1193435061), (2, 1, 1.0, 1193435062), (3, 2, 1.0, 1201824000)],
        "uid int, mid int, score double, timestamp long")
    allm = sorted(tuple(r) for r in stats.popular_by_month(ratings).collect())
    assert allm == [(1, 2, 200710), (2, 1, 200802)]
    latest = [tuple(r) for r in stats.popular_by_month(ratings, latest_only=True).collect()]
    assert latest == [(2, 1, 200802)]
    assert sorted(tuple(r) for r in stats.popular_movies(ratings).collect()) == [(1, 2), (2, 1)]


def test_window_group_limit_before_shuffle(spark):
    movies = spark.createDataFrame([(1, "Action")], "mid int, genres string")
    ratings = spark.createDataFrame([(1, 1, 3.0, 0)], "uid int, mid int, score double, timestamp long")
    long = stats.genre_top_movies_long(movies, ratings, stats.genre_table(spark))
    long.collect()
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
