"""Content-based similarity from the genre text.

tokens  : Tokenizer (lower-case, split on single whitespace) over genres with ``|`` → space
tf      : HashingTF with 20 buckets
tf-idf  : IDF fitted on all movies (weight ln((m + 1) / (df + 1)))
similar : cosine > 0.6 between movies, self excluded

A movie's vector depends only on its bag of genre words, so the cosine is computed between the
*distinct* vectors and expanded back to movies by an equi-join on the vector
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CONTENT_FEATURES, ITEM_SIM_THRESHOLD, STORED_NEIGHBOURS
from ..session import checkpoint_root
from ..sources.tables import stored
from .similarity import cosine_pairs
from .sparse import sparse_cosine_pairs, sparse_long
from .topk import rank_within


def content_words(movies: DataFrame) -> DataFrame:
    """(mid, name, genres with spaces, words)."""
    m = movies.select("mid", "name", F.translate("genres", "|", " ").alias("genres"))
    return Tokenizer(inputCol="genres", outputCol="words").transform(m)


def content_tf(words: DataFrame, n_features: int = CONTENT_FEATURES) -> DataFrame:
    """M9: adds ``rawFeatures`` (hashed term counts)."""
    return HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=n_features).transform(words)


def content_tfidf(movies: DataFrame, n_features: int = CONTENT_FEATURES) -> DataFrame:
    """(mid, name, genres, words, rawFeatures, features). ``fit`` is one tree aggregate."""
    tf = content_tf(content_words(movies), n_features)
    return IDF(inputCol="rawFeatures", outputCol="features").fit(tf).transform(tf)


def content_features(movies: DataFrame, n_features: int = CONTENT_FEATURES) -> DataFrame:
    """(mid, features): the TF-IDF vector of every movie."""
    return content_tfidf(movies, n_features).select("mid", "features")


def tf_long(tf: DataFrame) -> DataFrame:
    """(mid, dim, tf) for the non-zero hashed counts."""
    e = tf.select("mid", F.posexplode(vector_to_array("rawFeatures")).alias("dim", "tf"))
    return e.where(F.col("tf") != 0).select("mid", F.col("dim").cast("int").alias("dim"), "tf")


def tfidf_long(tfidf: DataFrame) -> DataFrame:
    """(mid, dim, w) for every dimension with a non-zero count (w may be 0 when idf is 0)."""
    arr = tfidf.select("mid", vector_to_array("rawFeatures").alias("t"), vector_to_array("features").alias("w"))
    e = arr.select("mid", F.posexplode("t").alias("dim", "tf"), "w")
    return e.where(F.col("tf") != 0).select(
        "mid", F.col("dim").cast("int").alias("dim"), F.element_at("w", F.col("dim") + 1).alias("w"))


def content_signatures(movies: DataFrame, threshold: float = ITEM_SIM_THRESHOLD,
                       n_features: int = CONTENT_FEATURES, block_rows: int = 1024) -> tuple[DataFrame, DataFrame]:
    """M11 without loss and in linear size: (sid, mid) names the vector of every movie by its
    smallest mid, (sid, sid2, sim) holds every similar pair of distinct vectors, equal ones included.

    Two movies are similar exactly if their vectors are. Both tables are checkpointed into the
    shared folder, so an executor loss never replays the TF-IDF pipeline.
    """
    checkpoint_root(movies.sparkSession)
    tf = content_tf(content_words(movies), n_features).select("mid", "rawFeatures") \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = IDF(inputCol="rawFeatures", outputCol="features").fit(tf)
        feats = model.transform(tf).select("mid", vector_to_array("features").alias("sig"))
        # one representative id per distinct vector: partial aggregation, exact (no hashing)
        sigs = feats.groupBy("sig").agg(F.min("mid").alias("sid")).checkpoint(eager=True)
        members = feats.join(sigs, "sig").select("sid", "mid").checkpoint(eager=True)
    finally:
        tf.unpersist()
    pairs = cosine_pairs(sigs, id_col="sid", vec_col="sig", threshold=threshold,
                         block_rows=block_rows, include_self=True, n_items=sigs.count())
    pairs = pairs.select(F.col("mid").alias("sid"), F.col("mid2").alias("sid2"), "sim").checkpoint(eager=True)
    return members, pairs


def content_signatures_wide(movies: DataFrame, threshold: float = ITEM_SIM_THRESHOLD,
                            n_features: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """``content_signatures`` for any number of features: vectors stay sparse, and similar ones are found by
    inverted lists over dimensions (``sparse.sparse_cosine_pairs``) instead of block products.

    A vector without a weight (every term in all movies) is similar to nothing, itself included."""
    tf = stored(content_tf(content_words(movies), n_features).select("mid", "rawFeatures"), "wide-tf")
    model = IDF(inputCol="rawFeatures", outputCol="features").fit(tf)
    feats = model.transform(tf).select("mid", "features", F.unwrap_udt("features").alias("sig"))
    feats = feats.withColumn("sig", F.struct("sig.type", "sig.indices", "sig.values"))
    sigs = stored(feats.groupBy("sig").agg(F.min("mid").alias("sid"), F.first("features").alias("features")), "wide-signatures")
    members = feats.select("mid", "sig").join(sigs.select("sig", "sid"), "sig").select("sid", "mid")
    entries = stored(sparse_long(sigs, "sid", "features"), "wide-entries")
    same = entries.select("sid").distinct().select("sid", F.col("sid").alias("sid2"), F.lit(1.0).alias("sim"))
    return stored(members, "wide-members"), sparse_cosine_pairs(entries, threshold).unionByName(same)


def content_similarity(movies: DataFrame, threshold: float = ITEM_SIM_THRESHOLD,
                       n_features: int = CONTENT_FEATURES, block_rows: int = 1024,
                       k: int = STORED_NEIGHBOURS) -> DataFrame:
    """(mid, rank, mid2, sim), each movie's k best neighbours with cosine > threshold, best
    first (ties: smaller mid2).

    A vector's movies share one list of its k + 1 best movies (the window keeps no more per map
    task), and each of them takes that list without itself, so the work after the vector pairs is
    linear in the number of movies.
    """
    members, pairs = content_signatures(movies, threshold, n_features, block_rows)
    others = members.select(F.col("sid").alias("sid2"), F.col("mid").alias("mid2"))
    # the k + 1 best movies of each vector on either side of the join are enough for its pairs
    others = rank_within(others, ["sid2"], [F.asc("mid2")], k + 1, rank_col="_n").drop("_n")
    lists = rank_within(pairs.join(others, "sid2"), ["sid"], [F.desc(F.round("sim", 12)), F.asc("mid2")],
                        k + 1, rank_col="pos").select("sid", "pos", "mid2", "sim").checkpoint(eager=True)
    own = members.join(lists.select("sid", F.col("mid2").alias("mid"), F.col("pos").alias("own")), ["sid", "mid"], "left")
    out = own.join(lists, "sid").where(F.col("mid2") != F.col("mid"))
    shift = F.when(F.col("own").isNotNull() & (F.col("pos") > F.col("own")), 1).otherwise(0)
    out = out.select("mid", (F.col("pos") - shift).cast("int").alias("rank"), "mid2", "sim")
    return out.where(F.col("rank") <= k)
