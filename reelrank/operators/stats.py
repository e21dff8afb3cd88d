"""Popularity and score statistics.

All aggregates are plain ``groupBy`` aggregations: Spark runs a partial (map-side) aggregate
before the shuffle, so a movie that holds a third of all ratings still sends one partial row
per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import GENRE_TOP_K, GENRES
from ..functions.scalar import rating_month
from .topk import nest, rank_within


def popular_movies(ratings: DataFrame) -> DataFrame:
    """A1 RateMoreMovies: (mid, count) over all history."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def ratings_by_month(ratings: DataFrame) -> DataFrame:
    """F1 applied to every rating: (uid, mid, month, score)."""
    return ratings.select("uid", "mid", rating_month(F.col("timestamp")).alias("month"), "score")


def popular_by_month(ratings: DataFrame, latest_only: bool = False) -> DataFrame:
    """A2 RateMoreRecentlyMovies: (mid, count, month) for every month.

    The reference's comment speaks of the latest month only while its code counts every month;
    the code is followed by default, ``latest_only=True`` keeps the newest month.
    """
    monthly = (ratings.select("mid", rating_month(F.col("timestamp")).alias("month"))
               .groupBy("month", "mid").agg(F.count("mid").alias("count"))
               .select("mid", "count", "month"))
    if latest_only:
        newest = monthly.agg(F.max("month").alias("_latest"))  # one row: broadcast-safe
        monthly = monthly.join(F.broadcast(newest), F.col("month") == F.col("_latest")).drop("_latest")
    return monthly


def average_movies(ratings: DataFrame) -> DataFrame:
    """A3 AverageMovies: (mid, avg)."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def movies_with_avg(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Inner equi-join on mid; movies without a rating drop out, as in the reference."""
    return movies.join(averages, "mid")


def genre_table(spark, genres: Sequence[str] = GENRES) -> DataFrame:
    """The fixed genre list as a tiny local relation (a literal array, no Python worker)."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(g) for g in genres])).alias("genre"))


def movie_genre_match(movies: DataFrame, genres: DataFrame) -> DataFrame:
    """Genre ⊂ movie.genres, case-insensitive substring (``Music`` also hits ``Musical``).

    Genre names are a list of words, not data that grows: a nested-loop join needs one side
    broadcast, and Spark takes the one it knows to be small. The movie side is scanned once.
    """
    g = genres.select(F.lower("genre").alias("_g"), "genre")
    m = movies.withColumn("_lg", F.lower("genres"))  # lower-cased once per movie, not per pair
    return m.join(g, F.col("_lg").contains(F.col("_g"))).drop("_g", "_lg")


def genre_top_movies_long(movies: DataFrame, ratings: DataFrame | None, genres: DataFrame | None = None,
                          k: int = GENRE_TOP_K, averages: DataFrame | None = None) -> DataFrame:
    """T1 in long form: (genre, rank, mid, score), best average first, ties by mid; ``averages``
    (mid, avg), if given, are used in place of those of ``ratings``."""
    if genres is None:
        genres = genre_table(movies.sparkSession)
    scored = movies_with_avg(movies.select("mid", "genres"), average_movies(ratings) if averages is None else averages)
    matched = movie_genre_match(scored, genres).select("genre", "mid", F.col("avg").alias("score"))
    return rank_within(matched, ["genre"], [F.desc("score"), F.asc("mid")], k)


def genre_top_movies(movies: DataFrame, ratings: DataFrame | None, genres: DataFrame | None = None,
                     k: int = GENRE_TOP_K, averages: DataFrame | None = None) -> DataFrame:
    """GenresTopMovies (genres, recs[{mid, score}]); a genre matching no movie has no row."""
    long = genre_top_movies_long(movies, ratings, genres, k, averages)
    return nest(long.withColumnRenamed("genre", "genres"), ["genres"], ["mid", "score"])
