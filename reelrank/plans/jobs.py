"""The five jobs of the reference as entry points, chained through stored tables.

    load_job        text files → Movie, Rating, Tag tables (keyed layouts)
    statistics_job  RateMoreMovies, RateMoreRecentlyMovies, AverageMovies, GenresTopMovies
    offline_job     ALS → User_Recs (uid, recs) and Movie_Recs (mid, recs)
    content_job     TF-IDF over genres → Content_Movie_Recs (mid, recs)
    streaming_job   rating messages → StreamRecs (uid, recs), re-ranked with Movie_Recs

Every table lives under one root directory on shared storage (``<root>/<TableName>``) and is
replaced as a whole by its job, like the reference's collections. Nothing is collected to the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import ALS_ITERATIONS, ALS_RANK, ALS_REG, DEFAULT_SEED, ITEM_SIM_THRESHOLD, STORED_NEIGHBOURS, USER_TOP_K
from ..operators import als, content, rerank, stats
from ..operators.pivots import VectorIndex
from ..operators.similarity import cut_neighbours, similarity_lists, similarity_rows
from ..schemas import MOVIE, RATING
from ..session import path_exists
from ..sources import loaders, tables
from ..streaming import recommender

MOVIE_T, RATING_T, TAG_T = "Movie", "Rating", "Tag"
RATE_MORE, RATE_MORE_RECENTLY, AVERAGE, GENRES_TOP = (
    "RateMoreMovies", "RateMoreRecentlyMovies", "AverageMovies", "GenresTopMovies")
USER_RECS, MOVIE_RECS, CONTENT_RECS, STREAM_RECS = (
    "User_Recs", "Movie_Recs", "Content_Movie_Recs", "StreamRecs")
MOVIE_RECS_CUT, MOVIE_VECTORS = "Movie_Recs_Cut", "Movie_Vectors"


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return tables.read_table(spark, _path(root, table))


def load_job(spark: SparkSession, movies_path: str, ratings_path: str, tags_path: str,
             root: str) -> None:
    """Parse the three text inputs and replace the stored tables: Movie by mid, Rating and Tag in two
    layouts each, by uid and by mid (the two keys they are looked up by). The old tables stay
    readable until the new ones are complete, and go as a whole then."""
    for name, lines, keys in ((MOVIE_T, loaders.load_movies(spark, movies_path), ("mid",)),
                              (RATING_T, loaders.load_ratings(spark, ratings_path), ("uid", "mid")),
                              (TAG_T, loaders.load_tags(spark, tags_path), ("uid", "mid"))):
        for i, key in enumerate(keys):
            tables.overwrite_table(lines, _path(root, f"{name}_by_{key}" if i else name), key=key)


def statistics_job(spark: SparkSession, root: str) -> None:
    """StatisticRecommender: the four statistics tables."""
    ratings = tables.read_typed(spark, _path(root, RATING_T), RATING)
    movies = tables.read_typed(spark, _path(root, MOVIE_T), MOVIE)
    tables.overwrite_table(stats.popular_movies(ratings), _path(root, RATE_MORE))
    tables.overwrite_table(stats.popular_by_month(ratings), _path(root, RATE_MORE_RECENTLY))
    tables.overwrite_table(stats.average_movies(ratings), _path(root, AVERAGE))
    averages = read_table(spark, root, AVERAGE)
    tables.overwrite_table(stats.genre_top_movies(movies, None, averages=averages), _path(root, GENRES_TOP))


def offline_job(spark: SparkSession, root: str, rank: int = ALS_RANK, iters: int = ALS_ITERATIONS,
                reg: float = ALS_REG, seed: int = DEFAULT_SEED, k: int = USER_TOP_K,
                neighbours: int | None = None) -> None:
    """OfflineRecommender: ALS on all ratings → per-user top k and item-item similarity lists, whole as in
    the reference. With ``neighbours`` lists are cut there, and the completeness index and the movie
    vectors are stored too, from which the stream gets what the lists have lost."""
    ratings = tables.read_typed(spark, _path(root, RATING_T), RATING)
    model = als.als_fit(ratings, rank=rank, iters=iters, reg=reg, seed=seed)
    tables.overwrite_table(als.user_recs(model, k=k), _path(root, USER_RECS))
    if neighbours is None:
        lists = als.item_similarity(model)
        for name in (MOVIE_RECS_CUT, MOVIE_VECTORS):
            tables.drop_table(spark, _path(root, name))
    else:
        factors = model.itemFactors.select(F.col("id").alias("mid"), F.col("features").alias("v"))
        lists, cut = cut_neighbours(factors, neighbours)
        tables.write_lookup_table(cut, _path(root, MOVIE_RECS_CUT), "mid")
        if not cut.isEmpty():
            VectorIndex.write(factors, _path(root, MOVIE_VECTORS))
    tables.overwrite_table(similarity_lists(lists), _path(root, MOVIE_RECS))


def content_job(spark: SparkSession, root: str, neighbours: int = STORED_NEIGHBOURS) -> None:
    """ContentBasedRecommender: genre TF-IDF cosine lists per movie."""
    movies = tables.read_typed(spark, _path(root, MOVIE_T), MOVIE)
    ranked = content.content_similarity(movies, k=neighbours)
    tables.overwrite_table(similarity_lists(ranked).drop("part"), _path(root, CONTENT_RECS))


def streaming_job(spark: SparkSession, root: str, messages: DataFrame, recent: DataFrame,
                  checkpoint_location: str, available_now: bool = False,
                  buckets: int = tables.LOOKUP_BUCKETS) -> StreamingQuery:
    """StreamingRecommender: re-rank on every rating message against Movie_Recs, excluding the
    user's rated movies, scoring with the user's ``recent`` ratings (uid, pos, mid, score);
    StreamRecs keeps the newest list per user. The lookups are written once as bucketed tables, so
    a micro-batch reads only the buckets of its users and movies."""
    sims = similarity_rows(read_table(spark, root, MOVIE_RECS))
    beyond = None
    if path_exists(spark, _path(root, MOVIE_VECTORS)):
        beyond = rerank.BeyondStored(read_table(spark, root, MOVIE_RECS_CUT), VectorIndex(spark, _path(root, MOVIE_VECTORS)), ITEM_SIM_THRESHOLD)
    rated = rerank.rated_pairs(tables.read_typed(spark, _path(root, RATING_T), RATING))
    looked_up = []
    for name, df, key in (("sims", sims, "mid"), ("rated", rated, "uid"), ("recent", recent, "uid")):
        path = _path(root, f"_lookup_{name}")
        tables.write_lookup_table(df, path, key, buckets)
        looked_up.append(tables.read_table(spark, path))
    sims, rated, recent = looked_up
    store = tables.KeyedStore(spark, _path(root, STREAM_RECS), schema=recommender.recs_schema(messages))
    return recommender.start_stream(messages, sims, rated, recent, store, checkpoint_location,
                                    available_now=available_now, rejects=_path(root, "RejectedMessages"), beyond=beyond)


def stream_recs_table(spark: SparkSession, root: str) -> DataFrame:
    """The current StreamRecs (uid, recs)."""
    return tables.KeyedStore(spark, _path(root, STREAM_RECS)).current().select("uid", "recs")


__all__ = ["load_job", "statistics_job", "offline_job", "content_job", "streaming_job",
           "stream_recs_table", "read_table"]
