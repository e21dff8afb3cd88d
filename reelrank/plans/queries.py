"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Outputs are flat rows (nested recommendation lists are flattened to key, rank, mid, score) and
computed doubles are rounded to 6 decimals so they can be compared with the DuckDB oracles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import ALS_REG, ITEM_SIM_THRESHOLD
from ..functions.scalar import cosine, round6
from ..operators import als, content, factors, maxproduct, rerank, similarity, stats
from ..operators.pivots import VectorIndex
from ..operators.topk import flatten
from ..schemas import RATING, TAG
from ..session import checkpoint_root, shared_path
from ..sources import fixtures as fx
from ..sources import loaders, tables
from ..streaming import recommender as streaming
from ..streaming import state
from . import sql

Query = Callable[[SparkSession, str], DataFrame]


def q_popular_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.popular_movies(fx.ratings(spark, sf_dir))


def q_popular_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.popular_by_month(fx.ratings(spark, sf_dir))


def q_average_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    avg = stats.average_movies(fx.ratings(spark, sf_dir))
    return avg.select("mid", round6(F.col("avg")).alias("avg"))


def q_rating_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ratings_by_month(fx.ratings(spark, sf_dir))


def q_movies_with_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    avg = stats.average_movies(fx.ratings(spark, sf_dir))
    joined = stats.movies_with_avg(fx.movies(spark, sf_dir).select("mid", "name"), avg)
    return joined.select("mid", "name", round6(F.col("avg")).alias("avg"))


def q_movie_genre_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fx.movies(spark, sf_dir).select("mid", "genres")
    return stats.movie_genre_match(m, stats.genre_table(spark)).select("genre", "mid")


def q_genre_top_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = stats.genre_top_movies(fx.movies(spark, sf_dir), fx.ratings(spark, sf_dir),
                                    stats.genre_table(spark))
    flat = flatten(nested, ["genres"])
    return flat.select(F.col("genres").alias("genre"), "rank", "mid", round6(F.col("score")).alias("score"))


def q_popular_by_month_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 as SQL text with a SQL function."""
    return sql.monthly_counts(spark, fx.ratings(spark, sf_dir)).select("mid", "count", "month")


def q_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: distinct users and movies in one pass over the ratings."""
    r = fx.ratings(spark, sf_dir)
    ids = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("id")) for kind, c in (("user", "uid"), ("movie", "mid"))])
    return r.select(F.inline(ids)).distinct()


# --- loaders and stored tables ---------------------------------------------------------------

def _write_lines(spark: SparkSession, df: DataFrame, sep: str, name: str, pad: str = "") -> str:
    path = shared_path(spark, name)
    loaders.render_lines(df, sep, pad).write.mode("overwrite").text(path)
    return path


def q_load_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_lines(spark, fx.movies(spark, sf_dir), "^", "movies-text", pad=" ")
    return loaders.load_movies(spark, path)


def q_load_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_lines(spark, fx.ratings(spark, sf_dir), ",", "ratings-text")
    return loaders.load_ratings(spark, path)


def q_load_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_lines(spark, fx.tags(spark, sf_dir), ",", "tags-text")
    return loaders.load_tags(spark, path)


def q_parse_rating_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 over every event, one message each; every third carries a surplus field, and each has a
    malformed twin that must not come through."""
    ev = fx.event_ratings(spark, sf_dir).select("uid", "mid", "score", "ts", "event_id")
    lines = loaders.render_lines(ev, "|", pad=" ", keep=("event_id",))
    surplus = F.when(F.col("event_id") % 3 == 0, F.concat("value", F.lit("| more"))).otherwise(F.col("value"))
    twins = F.array(surplus, F.concat(F.lit("x"), "value"), F.substring_index("value", "|", 3))
    path = shared_path(spark, "messages-text")
    lines.select(F.explode(twins).alias("value")).write.text(path)
    return loaders.parse_rating_messages(spark.read.text(path))


def q_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "rating-table")
    tables.overwrite_table(fx.ratings(spark, sf_dir), path, key="uid")
    return tables.read_typed(spark, path, RATING)


def q_published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: tags are stored and read, then ratings are published in their place. The reader still has the tags, a
    new one gets the ratings."""
    path = shared_path(spark, "published-table")
    tables.overwrite_table(fx.tags(spark, sf_dir).select("uid", "mid", "timestamp"), path, key="uid")
    held = tables.read_table(spark, path)
    tables.overwrite_table(fx.ratings(spark, sf_dir).select("uid", "mid", "timestamp"), path, key="mid")
    return held.withColumn("version", F.lit("old")).unionByName(tables.read_table(spark, path).withColumn("version", F.lit("new")))


def q_unrated_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 + S8: tags whose user has not rated the movie. The rated pairs are a catalog table in buckets of the pair, so the join does not shuffle them, and a user with a third of them is spread."""
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rated = tables.write_catalog_table(rerank.rated_pairs(fx.ratings(spark, sf_dir)), "rated", ["uid", "mid"], buckets)
    return fx.tags(spark, sf_dir).join(rated, ["uid", "mid"], "left_anti").select("uid", "mid", "tag", "timestamp")


def q_drop_and_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: a stored table is dropped before another is loaded in its place; none of it remains."""
    path = shared_path(spark, "reloaded-table")
    tables.overwrite_table(fx.movies(spark, sf_dir), path, key="mid")
    tables.drop_table(spark, path)
    tables.overwrite_table(fx.tags(spark, sf_dir), path, key="uid")
    return tables.read_typed(spark, path, TAG)


def q_tables_by_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: ratings and tags stored in the layout for lookups by movie, read back and counted."""
    counts = []
    for name, df, schema in (("rating", fx.ratings(spark, sf_dir), RATING), ("tag", fx.tags(spark, sf_dir), TAG)):
        path = shared_path(spark, f"{name}-by-mid")
        tables.overwrite_table(df, path, key="mid")
        stored = tables.read_typed(spark, path, schema)
        counts.append(stored.groupBy("mid").agg(F.count("*").alias("n"), F.min("uid").alias("first_uid")).select(
            F.lit(name).alias("table"), "mid", "n", "first_uid"))
    return counts[0].unionByName(counts[1])


# --- vectors: cosine, neighbour lists, top-k --------------------------------------------------

#: Thresholds for the 64-dimensional test vectors, whose largest cosine is about 0.5; the defaults
#: of the operators (0.6 stored, 0.7 at the re-ranking) stay as they are.
STORED_SIM, RERANK_SIM = 0.25, 0.30


def _vector_sims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.item_similarity(fx.vectors(spark, sf_dir), threshold=STORED_SIM)


def q_vector_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cosine of every vector with the mean vector of its label."""
    v = fx.vectors(spark, sf_dir)
    parts = v.select("label", F.posexplode("v").alias("pos", "x")).groupBy("label", "pos").agg(F.avg("x").alias("x"))
    means = parts.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("_m")) \
        .select("label", F.transform("_m", lambda s: s["x"]).alias("m"))
    return v.join(means, "label").select("mid", "label", round6(cosine(F.col("v"), F.col("m"))).alias("sim"))


def q_item_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_sims(spark, sf_dir).select("mid", "rank", "mid2", round6(F.col("sim")).alias("sim"))


def q_similarity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = similarity.similarity_map(_vector_sims(spark, sf_dir))
    return m.select("mid", F.size("sims").cast("long").alias("n_entries"))


def q_user_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = fx.vectors(spark, sf_dir)
    top = maxproduct.topk_dot(v.withColumnRenamed("mid", "uid"), v, k=20, min_score=0.0)
    return top.select("uid", "rank", "mid", round6(F.col("score")).alias("score"))


def q_user_topk_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + P13: top 20 by dot product > 0 among the items a user has not rated (exact)."""
    v = fx.vectors(spark, sf_dir)
    seen = fx.event_ratings(spark, sf_dir).select("uid", "mid")
    top = maxproduct.topk_dot(v.withColumnRenamed("mid", "uid"), v, k=20, min_score=0.0, exclude=seen)
    return top.select("uid", "rank", "mid", round6(F.col("score")).alias("score"))


# --- content-based ------------------------------------------------------------------------------

def q_content_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = content.content_words(fx.movies(spark, sf_dir))
    e = w.select("mid", F.posexplode("words").alias("pos", "token"))
    return e.select("mid", (F.col("pos") + 1).cast("int").alias("pos"), "token")


def q_content_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    tf = content.content_tf(content.content_words(fx.movies(spark, sf_dir)))
    return content.tf_long(tf)


def q_content_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = content.tfidf_long(content.content_tfidf(fx.movies(spark, sf_dir)))
    return t.select("mid", "dim", round6(F.col("w")).alias("w"))


def q_content_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = content.content_similarity(fx.movies(spark, sf_dir))
    return ranked.select("mid", "rank", "mid2", round6(F.col("sim")).alias("sim"))


def q_content_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 without a limit: every movie's vector, and the number of movies similar to it (itself included)."""
    return _similar_counts(*content.content_signatures(fx.movies(spark, sf_dir)))


def q_content_signatures_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 with 2^18 features, where every word has a dimension of its own, by inverted lists."""
    return _similar_counts(*content.content_signatures_wide(fx.movies(spark, sf_dir)))


def _similar_counts(members: DataFrame, pairs: DataFrame) -> DataFrame:
    sizes = members.groupBy(F.col("sid").alias("sid2")).agg(F.count("*").alias("n"))
    similar = pairs.join(sizes, "sid2").groupBy("sid").agg(F.sum("n").alias("n_similar"))
    return members.join(similar, "sid").select("mid", "sid", "n_similar")


# --- streaming re-rank, as batch functions and as a stream -------------------------------------

def _stored_lookup(spark: SparkSession, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    path = shared_path(spark, f"stream-{name}")
    tables.write_lookup_table(df, path, key, buckets)
    return tables.read_table(spark, path)


#: Neighbours stored a movie in the lookups. The table stays linear in the movies; what an event or a score needs
#: beyond it comes from the vector index, so the rows are those of whole lists.
LOOKUP_LISTS = 100


def _lookups(spark: SparkSession, sf_dir: str, buckets: int = 8, k: int | None = None):
    """Event ratings and the three lookup tables (similarity, rated pairs, recent ratings), stored in buckets by
    movie or user; the similarity lists are cut at ``k`` (``LOOKUP_LISTS`` if none is given), and what lies beyond
    them comes too if any list is longer."""
    checkpoint_root(spark)
    er = fx.event_ratings(spark, sf_dir)
    vectors = fx.vectors(spark, sf_dir).select("mid", "v")
    sims, cut = similarity.cut_neighbours(vectors, k or LOOKUP_LISTS, STORED_SIM)
    beyond = None
    if not cut.isEmpty():
        beyond = rerank.BeyondStored(
            _stored_lookup(spark, cut, "cut", "mid", buckets),
            VectorIndex.write(vectors, shared_path(spark, "stream-vectors"), block_rows=256, buckets=buckets), STORED_SIM)
    frames = (("sims", sims, "mid"), ("rated", rerank.rated_pairs(er), "uid"), ("recent", rerank.recent_ratings(er), "uid"))
    return (er, *(_stored_lookup(spark, df, name, key, buckets) for name, df, key in frames), beyond)


def q_recent_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rerank.recent_ratings(fx.event_ratings(spark, sf_dir))


def q_recent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recent ratings written as ``mid:score`` items and parsed back."""
    recent = rerank.recent_ratings(fx.event_ratings(spark, sf_dir))
    items = recent.select("uid", "pos", F.concat_ws(":", F.col("mid").cast("string"), F.col("score").cast("string")).alias("item"))
    return rerank.parse_recent_items(items)


#: Length of the lists in the queries on cut tables.
SHORT_LISTS = 10


def _candidates(spark: SparkSession, sf_dir: str, k: int | None, lookups: tuple | None = None) -> DataFrame:
    er, sims, rated, _, beyond = lookups or _lookups(spark, sf_dir, k=k)
    events = tables.stored(rerank.newest_per_user(er), "newest-events")
    cand = rerank.stream_candidates(events, sims, rated, beyond=beyond)
    return cand.select("uid", "rank", "mid", round6(F.col("sim")).alias("sim"))


def _scores(spark: SparkSession, sf_dir: str, k: int | None, lookups: tuple | None = None) -> DataFrame:
    er, sims, rated, recent, beyond = lookups or _lookups(spark, sf_dir, k=k)
    events = tables.stored(rerank.newest_per_user(er), "newest-events")
    cand = tables.stored(rerank.stream_candidates(events, sims, rated, beyond=beyond), "candidates")
    scores = rerank.stream_scores(cand, sims, recent, RERANK_SIM, beyond=beyond)
    return scores.select("uid", "rank", "mid", round6(F.col("score")).alias("score"))


def q_stream_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir, None)


def q_stream_candidates_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 from lists of ten neighbours: the rest comes from the vector index, the rows are those of whole lists."""
    return _candidates(spark, sf_dir, SHORT_LISTS)


def q_stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir, None)


def q_stream_scores_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 from lists of ten neighbours: lost pairs are computed from their vectors."""
    return _scores(spark, sf_dir, SHORT_LISTS)


def _write_messages(spark: SparkSession, er: DataFrame, path: str) -> None:
    """Event ratings as ``uid | mid | score | ts`` messages (with event_id), parquet partitioned by
    day. Rebalancing on the day gives about one file per day (AQE splits a busy day over
    several writers and merges quiet ones)."""
    day = F.floor(F.col("ts") / 86400).alias("day")
    msgs = loaders.render_lines(er.select("uid", "mid", "score", "ts", "event_id", day), "|", " ",
                                keep=("event_id", "day"))
    msgs.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)


def _flat_recs(current: DataFrame) -> DataFrame:
    flat = flatten(current.select("uid", "recs"), ["uid"])
    return flat.select("uid", "rank", "mid", round6(F.col("score")).alias("score"))


def q_stream_recs_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event scored on its own and upserted in two batches (the first written twice: a replay
    must not change the table) around a compaction; the stored list is that of the newest event."""
    er, sims, rated, recent, beyond = _lookups(spark, sf_dir)
    recs = rerank.recommend_events(er, sims, rated, recent, threshold=RERANK_SIM, beyond=beyond)
    store = tables.KeyedStore(spark, shared_path(spark, "stream-recs-batch"))
    rows = tables.stored(recs.select("uid", "recs", "ts", "event_id"), "scored-events")
    odd = F.col("event_id") % 2 == 1
    store.upsert(rows.where(odd), 0)
    store.upsert(rows.where(odd), 0)
    store.compact(0)
    store.upsert(rows.where(~odd), 1)
    return _flat_recs(store.current())


def q_stream_recs(spark: SparkSession, sf_dir: str, lookups: tuple | None = None) -> DataFrame:
    """The whole streaming job over stored lookup tables in buckets by movie and user. Messages are
    parquet files partitioned by day, read by a file stream several files per micro-batch,
    re-ranked in ``foreachBatch`` and upserted per user. The stored list of a user is the one of
    their newest event, whatever order the files are read in."""
    er, sims, rated, recent, beyond = lookups or _lookups(spark, sf_dir)
    src = shared_path(spark, "stream-messages")
    _write_messages(spark, er, src)
    store = tables.KeyedStore(spark, shared_path(spark, "stream-recs"))
    query = streaming.start_stream(
        streaming.file_messages(spark, src, max_files_per_trigger=10), sims, rated, recent, store,
        checkpoint_location=shared_path(spark, "stream-checkpoint"), available_now=True, threshold=RERANK_SIM, beyond=beyond)
    query.awaitTermination()
    return _flat_recs(store.current())


def q_recent_ratings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 kept by the stream itself: messages → per-user state of the newest 21 ratings →
    keyed store; the final table equals the batch ``recent_ratings``."""
    er = fx.event_ratings(spark, sf_dir)
    src = shared_path(spark, "recent-messages")
    _write_messages(spark, er, src)
    store = state.recent_store(spark, shared_path(spark, "recent-store"), buckets=8)
    query = state.start_recent_stream(streaming.file_messages(spark, src, max_files_per_trigger=10), store,
                                      shared_path(spark, "recent-checkpoint"), available_now=True)
    query.awaitTermination()
    return state.recent_table(store).select("uid", "pos", "mid", "score")


# --- split, RMSE, ALS ---------------------------------------------------------------------------

def q_train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.ratings(spark, sf_dir)
    return r.select("uid", "mid", "score", "timestamp", als.split_flag().alias("is_train"))


def q_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 by Spark's ``randomSplit``: the two sides together are the ratings, each row once."""
    train, test = als.train_test_split(fx.ratings(spark, sf_dir), seed=42)
    return train.unionByName(test)


def q_rating_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 + A6 without a model: the per-movie mean predicts every held-out pair, and observations
    are joined with predictions on (uid, mid)."""
    train, test = als.train_test_split(fx.ratings(spark, sf_dir))
    means = stats.average_movies(train).withColumnRenamed("avg", "prediction")
    predicted = test.select("uid", "mid").distinct().join(means, "mid")
    return als.rmse_of(predicted, test).select(round6(F.col("rmse")).alias("rmse"), "n")


_MODELS: dict = {}


def _model(spark: SparkSession, sf_dir: str, train_only: bool):
    key = (spark.sparkContext.applicationId, sf_dir, train_only)
    if key not in _MODELS:
        r = fx.ratings(spark, sf_dir)
        if train_only:
            r = als.train_test_split(r)[0]
        _MODELS[key] = als.als_fit(r)
    return _MODELS[key]


def als_user_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: (uid, rank, mid, score), the rank-200 model's best 20 movies of every user."""
    recs = als.user_recs(_model(spark, sf_dir, False))
    return flatten(recs, ["uid"]).select("uid", "rank", "mid", round6(F.col("score")).alias("score"))


def als_item_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: (mid, rank, mid2, sim), the best neighbours by the item factors."""
    ranked = als.item_similarity(_model(spark, sf_dir, False))
    return ranked.select("mid", "rank", "mid2", round6(F.col("sim")).alias("sim"))


def _well_formed(ranked: DataFrame, key: str, other: str, value: str, above: float, exact: str) -> DataFrame:
    """(key, n, ok): ranks run from 1 without a gap, no entry comes twice, values fall and exceed ``above``, and
    each equals ``exact``, the value recomputed from the stored factors."""
    w = Window.partitionBy(key).orderBy("rank")
    rows = ranked.withColumn("_at", F.row_number().over(w)).withColumn("_prev", F.lag(value).over(w))
    fine = ((F.col("_at") == F.col("rank")) & (F.col("_prev").isNull() | (F.col("_prev") >= F.col(value)))
            & (F.col(value) > above) & (F.abs(F.col(value) - F.col(exact)) <= 2e-6))
    return rows.groupBy(key).agg(F.count("*").alias("n"), (F.bool_and(fine) & (F.count_distinct(other) == F.count("*"))).alias("ok"))


def _factors(model, side: str, id_col: str, vec_col: str) -> DataFrame:
    """Factors as the model holds them, in single precision: half the bytes in a join."""
    f = model.userFactors if side == "user" else model.itemFactors
    return f.select(F.col("id").alias(id_col), F.col("features").alias(vec_col))


def q_als_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: (uid, n_ratings, solved) for every rated user of the rank-200 model. ALS ends on the users'
    half-step, so each user's factors solve the normal equations: sum over the ratings of (v.u - r) v, plus
    the regularisation times the number of ratings times u, is zero."""
    r = fx.ratings(spark, sf_dir).select("uid", "mid", "score")
    model = _model(spark, sf_dir, False)
    sums = factors.equation_misses(model.userFactors, model.itemFactors, r, model.rank, ALS_REG)
    return sums.select(F.col("id").alias("uid"), F.col("n").alias("n_ratings"), (F.col("miss") <= F.col("size") * 1e-4).alias("solved"))


def q_als_user_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, checked: every rated user has a full, well-formed list whose scores are the products of the factors."""
    model = _model(spark, sf_dir, False)
    lists = tables.stored(als_user_lists(spark, sf_dir), "als-user-lists")
    exact = factors.products(lists.select("uid", "mid").distinct(), "uid", "mid", model.userFactors, model.itemFactors, "exact", model.rank)
    rows = lists.join(exact, ["uid", "mid"])
    return _well_formed(rows, "uid", "mid", "score", 0.0, "exact").select("uid", F.col("n").alias("n_recs"), "ok")


def q_als_item_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4, checked: the whole neighbour list of every rated movie is well formed, holds the cosines of the factors, and
    as many other lists hold the movie as its own list has entries (nothing is lost on one side)."""
    model = _model(spark, sf_dir, False)
    ranked = tables.stored(als_item_lists(spark, sf_dir), "als-item-lists")
    exact = factors.products(ranked.select("mid", "mid2").distinct(), "mid", "mid2", model.itemFactors, model.itemFactors, "exact", model.rank, cosine=True)
    rows = ranked.join(exact, ["mid", "mid2"]).where("mid <> mid2")
    checked = _well_formed(rows, "mid", "mid2", "sim", ITEM_SIM_THRESHOLD - 1e-6, "exact")
    back = ranked.groupBy(F.col("mid2").alias("mid")).agg(F.count("*").alias("n_back"))
    mids = fx.ratings(spark, sf_dir).select("mid").distinct().join(checked, "mid", "left").join(back, "mid", "left")
    none = F.col("n").isNull() & F.col("n_back").isNull()
    return mids.select("mid", (none | (F.col("ok") & F.col("n").eqNullSafe(F.col("n_back")))).alias("ok"))


def _predicted(spark: SparkSession, sf_dir: str, pairs: DataFrame) -> DataFrame:
    """``pairs`` with their product of the stored factors, the users' shipped to the movies (the model's predictions ship
    them the other way); pairs unknown to the model are dropped."""
    model = _model(spark, sf_dir, True)
    exact = factors.products(pairs.select("uid", "mid").distinct(), "mid", "uid", model.itemFactors, model.userFactors, "exact", model.rank)
    return pairs.join(exact, ["uid", "mid"])


def q_als_predict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every held-out row whose user and movie were trained on gets one prediction, the product of their factors."""
    test = als.train_test_split(fx.ratings(spark, sf_dir))[1]
    pred = als.predict_pairs(_model(spark, sf_dir, True), test.select("uid", "mid", "score"))
    pred = _predicted(spark, sf_dir, pred)
    same = F.abs(F.col("prediction") - F.col("exact")) <= 1e-5 * (1 + F.abs("exact"))
    return pred.groupBy("uid", "mid").agg(F.count("*").alias("n"), F.bool_and(same).alias("same"))


def q_als_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: held-out rows scored, and whether the RMSE is that of the stored factors and below that of predicting zero."""
    test = als.train_test_split(fx.ratings(spark, sf_dir))[1].select("uid", "mid", "score")
    rmse = als.rmse_table(_model(spark, sf_dir, True), test)
    miss = F.col("score") - F.col("exact")
    again = _predicted(spark, sf_dir, test).agg(
        F.sqrt(F.avg(miss * miss)).alias("again"), F.sqrt(F.avg(F.col("score") * F.col("score"))).alias("zero"), F.count("*").alias("m"))
    both = rmse.withColumn("_one", F.lit(1)).join(again.withColumn("_one", F.lit(1)), "_one")
    return both.select("n", ((F.abs(F.col("rmse") - F.col("again")) <= 1e-5) & (F.col("n") == F.col("m")) & (F.col("rmse") < F.col("zero"))).alias("same"))


def q_als_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + A7: every model of the grid, whether its RMSE is a number, and whether none is below the best's."""
    grid = als.als_grid_search(fx.ratings(spark, sf_dir))
    least = grid.agg(F.min("rmse")).scalar()
    best = als.best_params(grid).select("rmse").scalar()
    return grid.select("rank", F.col("lambda"), (F.col("rmse") > 0).alias("measured"), (best == least).alias("best_is_least"))


QUERIES: dict[str, Query] = {
    "popular_movies": q_popular_movies,
    "popular_by_month": q_popular_by_month,
    "popular_by_month_sql": q_popular_by_month_sql,
    "average_movies": q_average_movies,
    "rating_month": q_rating_month,
    "movies_with_avg": q_movies_with_avg,
    "movie_genre_match": q_movie_genre_match,
    "genre_top_movies": q_genre_top_movies,
    "distinct_ids": q_distinct_ids,
    "load_movies": q_load_movies,
    "load_ratings": q_load_ratings,
    "load_tags": q_load_tags,
    "parse_rating_messages": q_parse_rating_messages,
    "table_roundtrip": q_table_roundtrip,
    "published_versions": q_published_versions,
    "drop_and_reload": q_drop_and_reload,
    "tables_by_movie": q_tables_by_movie,
    "vector_cosine": q_vector_cosine,
    "item_similarity": q_item_similarity,
    "similarity_map": q_similarity_map,
    "user_topk": q_user_topk,
    "user_topk_unseen": q_user_topk_unseen,
    "content_tokens": q_content_tokens,
    "content_tf": q_content_tf,
    "content_tfidf": q_content_tfidf,
    "content_similarity": q_content_similarity,
    "content_signatures": q_content_signatures,
    "content_signatures_wide": q_content_signatures_wide,
    "unrated_tags": q_unrated_tags,
    "recent_ratings": q_recent_ratings,
    "recent_items": q_recent_items,
    "recent_ratings_stream": q_recent_ratings_stream,
    "stream_candidates": q_stream_candidates,
    "stream_candidates_cut": q_stream_candidates_cut,
    "stream_scores": q_stream_scores,
    "stream_scores_cut": q_stream_scores_cut,
    "stream_recs_upsert": q_stream_recs_upsert,
    "stream_recs": q_stream_recs,
    "train_test_split": q_train_test_split,
    "random_split": q_random_split,
    "rating_rmse": q_rating_rmse,
    "als_fit": q_als_fit,
    "als_user_recs": q_als_user_recs,
    "als_item_recs": q_als_item_recs,
    "als_predict_pairs": q_als_predict_pairs,
    "als_rmse": q_als_rmse,
    "als_grid_search": q_als_grid_search,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_genre_top_movies(spark, sf_dir)
