"""Domain views (ratings, movies, tags, event ratings, vectors) over the driver's parquet tables.

The arithmetic is documented in FIXTURES.md §2 and mirrored by ``reelrank.plans.oracles``.
Every view is a pure projection/join of the given tables, so Catalyst prunes columns and
pushes filters into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import GENRES
from ..functions.scalar import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _genre_at(idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(g) for g in GENRES]), idx)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating(uid, mid, score, timestamp) from lineitem ⋈ orders."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("score"),
        epoch_seconds(F.col("l_shipdate")).alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie with mid, name and a two-genre ``|`` list; other text fields are empty."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    first = _genre_at((F.col("p_size") % 20 + 1).cast("int"))
    second = _genre_at(((F.length("p_type") * 7 + F.expr("p_partkey div 100")) % 20 + 1).cast("int"))
    empty = F.lit("")
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        empty.alias("descri"), empty.alias("timelong"), empty.alias("issue"),
        empty.alias("shoot"), empty.alias("language"),
        F.concat(first, F.lit("|"), second).alias("genres"),
        empty.alias("actors"), empty.alias("directors"),
    )


def _event_movie(spark: SparkSession, sf_dir: str) -> Column:
    """A movie of the whole vector table for each event (the table's size is a scalar subquery)."""
    movies_there = table(spark, sf_dir, "embeddings").agg(F.max("vec_id") + 1).scalar()
    return ((F.col("event_id") * 7919 + F.col("user_id") * 104729) % movies_there).cast("int")


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-shaped ratings (uid, mid, score, ts, event_id) from the events table."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return e.select(
        F.col("user_id").cast("int").alias("uid"),
        _event_movie(spark, sf_dir).alias("mid"),
        ((F.floor("value") % 10 + 1).cast("double") / 2).alias("score"),
        epoch_seconds(F.col("ts")).alias("ts"),
        F.col("event_id"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return e.select(
        F.col("user_id").cast("int").alias("uid"),
        _event_movie(spark, sf_dir).alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item vectors: every component of each embedding, as doubles, and its label."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return e.select(
        F.col("vec_id").cast("int").alias("mid"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"), "label")
