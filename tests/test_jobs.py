"""The five jobs chained through stored tables, from text files to StreamRecs."""

from pyspark.sql import functions as F

from reelrank.operators import rerank
from reelrank.operators.similarity import similarity_rows
from reelrank.operators.topk import flatten
from reelrank.plans import jobs
from reelrank.plans.queries import QUERIES
from reelrank.sources import fixtures as fx
from reelrank.sources import loaders, tables
from reelrank.streaming import recommender

SF = "/root/testdata/sf0.001"


def test_job_chain(spark, tmp_path):
    root = str(tmp_path / "store")
    paths = {}
    for name, df, sep in (("movies", fx.movies(spark, SF), "^"), ("ratings", fx.ratings(spark, SF), ","),
                          ("tags", fx.tags(spark, SF), ",")):
        paths[name] = str(tmp_path / name)
        loaders.render_lines(df, sep).write.text(paths[name])
    jobs.load_job(spark, paths["movies"], paths["ratings"], paths["tags"], root)
    assert jobs.read_table(spark, root, jobs.TAG_T).count() == fx.tags(spark, SF).count()
    for name in (jobs.RATING_T, jobs.TAG_T):
        assert jobs.read_table(spark, root, f"{name}_by_mid").count() == jobs.read_table(spark, root, name).count()

    jobs.statistics_job(spark, root)
    stored = flatten(jobs.read_table(spark, root, jobs.GENRES_TOP), ["genres"])
    direct = QUERIES["genre_top_movies"](spark, SF)
    got = sorted((r.genres, r.rank, r.mid, round(r.score, 6)) for r in stored.collect())
    assert got == sorted(tuple(r) for r in direct.collect())
    assert jobs.read_table(spark, root, jobs.RATE_MORE_RECENTLY).columns == ["mid", "count", "month"]

    jobs.offline_job(spark, root, rank=6, iters=3)
    user_recs = jobs.read_table(spark, root, jobs.USER_RECS)
    assert user_recs.columns == ["uid", "recs"] and user_recs.count() > 0
    jobs.content_job(spark, root)
    assert jobs.read_table(spark, root, jobs.CONTENT_RECS).columns == ["mid", "recs"]

    # stream the ratings themselves as messages; recent = newest 21 ratings per user
    ratings = fx.ratings(spark, SF).withColumn("event_id", F.col("uid").cast("long") * 1000000 + F.col("mid"))
    msgs = loaders.render_lines(ratings.select("uid", "mid", "score", "timestamp", "event_id"), "|",
                                keep=("event_id",))
    msgs.write.parquet(str(tmp_path / "msgs"))
    events = ratings.withColumnRenamed("timestamp", "ts")
    recent = rerank.recent_ratings(events)
    q = jobs.streaming_job(spark, root, recommender.file_messages(spark, str(tmp_path / "msgs")), recent,
                           str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination()
    got = {r.uid: [x.mid for x in r.recs] for r in jobs.stream_recs_table(spark, root).collect()}
    sims = similarity_rows(jobs.read_table(spark, root, jobs.MOVIE_RECS))
    truth = rerank.recommend_events(rerank.newest_per_user(events), sims, rerank.rated_pairs(events), recent)
    want = {r.uid: [x.mid for x in r.recs] for r in truth.collect()}
    assert got == want and len(got) == events.select("uid").distinct().count()

    # lists cut at two neighbours: the same stream table from the completeness index and the vectors
    jobs.offline_job(spark, root, rank=6, iters=3, neighbours=2)
    assert jobs.read_table(spark, root, jobs.MOVIE_RECS).agg(F.max(F.size("recs"))).first()[0] == 2
    tables.drop_table(spark, f"{root}/{jobs.STREAM_RECS}")
    q = jobs.streaming_job(spark, root, recommender.file_messages(spark, str(tmp_path / "msgs")), recent,
                           str(tmp_path / "ckpt-cut"), available_now=True)
    q.awaitTermination()
    assert {r.uid: [x.mid for x in r.recs] for r in jobs.stream_recs_table(spark, root).collect()} == want
