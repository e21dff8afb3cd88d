from pyspark.sql import functions as F

from reelrank.operators import rerank
from reelrank.sources import fixtures as fx
from reelrank.sources import loaders
from reelrank.sources.tables import KeyedStore
from reelrank.operators.similarity import item_similarity
from reelrank.streaming import recommender as streaming

SF = "/root/testdata/sf0.001"


def _batch_truth(spark):
    er = fx.event_ratings(spark, SF)
    sims = item_similarity(fx.vectors(spark, SF), threshold=0.25)
    rated, recent = rerank.rated_pairs(er), rerank.recent_ratings(er)
    truth = rerank.recommend_events(rerank.newest_per_user(er), sims, rated, recent, threshold=0.3)
    return er, sims, rated, recent, truth


def test_stream_equals_batch(spark, tmp_path):
    er, sims, rated, recent, truth = _batch_truth(spark)
    msgs = loaders.render_lines(er.select("uid", "mid", "score", "ts", "event_id",
                                          (F.col("event_id") % 3).alias("part")), "|", " ",
                                keep=("event_id", "part"))
    bad = spark.createDataFrame([("not|a|message", 10**9, 0), ("x|1|2.0|3", 10**9 + 1, 0)], "value string, event_id long, part long")
    msgs.unionByName(bad).write.partitionBy("part").parquet(str(tmp_path / "src"))
    store = KeyedStore(spark, str(tmp_path / "recs"))
    q = streaming.start_stream(streaming.file_messages(spark, str(tmp_path / "src"), max_files_per_trigger=2),
                               sims, rated, recent, store, str(tmp_path / "ckpt"), available_now=True,
                               threshold=0.3, rejects=str(tmp_path / "rejects"))
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "rejects")).collect()) == ["not|a|message", "x|1|2.0|3"]
    assert q.lastProgress is not None
    got = {r.uid: [(x.mid, round(x.score, 9)) for x in r.recs] for r in store.current().collect()}
    want = {r.uid: [(x.mid, round(x.score, 9)) for x in r.recs] for r in truth.collect()}
    assert got == want and len(got) > 0


def test_upsert_is_idempotent_and_newest_wins(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))
    schema = "uid int, recs array<struct<mid:int,score:double>>, ts long, event_id long"
    b0 = spark.createDataFrame([(1, [(5, 1.0)], 10, 1), (2, [], 10, 2)], schema)
    b1 = spark.createDataFrame([(1, [(6, 2.0)], 20, 3), (2, [(7, 1.0)], 5, 4)], schema)
    store.upsert(b0, 0)
    store.upsert(b1, 1)
    store.upsert(b1, 1)  # replay of batch 1
    cur = {r.uid: [x.mid for x in r.recs] for r in store.current().collect()}
    assert cur == {1: [6], 2: []}  # uid 2: batch 1 carries an older event, the newer empty list stays
    store.compact(1)
    store.compact(1)  # a replayed batch finds the committed snapshot
    assert store._snapshots() == [1]
    assert not (tmp_path / "s" / "batches" / "batch_id=0").exists()  # folded batches are gone
    b2 = spark.createDataFrame([(2, [(8, 3.0)], 30, 5)], schema)
    store.upsert(b2, 2)
    cur = {r.uid: [x.mid for x in r.recs] for r in store.current().collect()}
    assert cur == {1: [6], 2: [8]}


def test_overwrite_table_spreads_a_hot_key(spark, tmp_path):
    from reelrank.sources.tables import overwrite_table, read_typed
    from reelrank.schemas import RATING
    hot = spark.range(4000).select(F.lit(1).cast("int").alias("uid"), F.col("id").cast("int").alias("mid"),
                                   F.lit(3.0).alias("score"), F.col("id").alias("timestamp"))
    cold = spark.range(2000).select((F.col("id") + 2).cast("int").alias("uid"), F.lit(7).alias("mid"),
                                    F.lit(1.0).alias("score"), F.col("id").alias("timestamp"))
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        overwrite_table(hot.unionByName(cold), path, key="uid")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = read_typed(spark, path, RATING)
    assert back.count() == 6000
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
    assert max(r.n for r in per_file) < 4000  # the hot user is split across files


def test_recent_state_stream_keeps_newest(spark, tmp_path):
    from reelrank.streaming import state
    rows1 = [(f"1|{m}|4.0|{100 + m}", m) for m in range(30)]
    rows2 = [(f"1|{m}|2.0|{m}", 1000 + m) for m in range(5)] + [("1|99|5.0|1000", 2000), ("2|5|1.0|7", 2001)]
    src = str(tmp_path / "src")
    spark.createDataFrame(rows1, "value string, event_id long").write.parquet(src + "/a=1")
    spark.createDataFrame(rows2, "value string, event_id long").write.parquet(src + "/a=2")
    store = state.recent_store(spark, str(tmp_path / "store"), buckets=4)
    q = state.start_recent_stream(streaming.file_messages(spark, src, max_files_per_trigger=1), store,
                                  str(tmp_path / "ckpt"), k=21, available_now=True)
    q.awaitTermination()
    got = {}
    for r in state.recent_table(store).collect():
        got.setdefault(r.uid, []).append((r.pos, r.mid))
    u1 = [m for _, m in sorted(got[1])]
    assert u1 == [99] + list(range(29, 9, -1)) and got[2] == [(1, 5)]


def test_drop_table(spark, tmp_path):
    from reelrank.session import path_exists
    from reelrank.sources.tables import drop_table, overwrite_table
    path = str(tmp_path / "d")
    overwrite_table(spark.range(3), path)
    assert path_exists(spark, path)
    drop_table(spark, path)
    assert not path_exists(spark, path)
    drop_table(spark, path)  # dropping a missing table is a no-op


def test_stream_compaction_keeps_result(spark, tmp_path):
    er, sims, rated, recent, truth = _batch_truth(spark)
    msgs = loaders.render_lines(er.select("uid", "mid", "score", "ts", "event_id",
                                          (F.col("event_id") % 4).alias("part")), "|", " ",
                                keep=("event_id", "part"))
    msgs.write.partitionBy("part").parquet(str(tmp_path / "src"))
    store = KeyedStore(spark, str(tmp_path / "recs"))
    q = streaming.start_stream(streaming.file_messages(spark, str(tmp_path / "src"), max_files_per_trigger=3),
                               sims, rated, recent, store, str(tmp_path / "ckpt"), available_now=True,
                               compact_every=1, threshold=0.3)
    q.awaitTermination()
    assert 0 < len(store._snapshots()) <= 2
    assert len([p for p in (tmp_path / "recs" / "batches").iterdir() if p.name.startswith("batch_id=")]) <= 1
    got = {r.uid: [x.mid for x in r.recs] for r in store.current().collect()}
    want = {r.uid: [x.mid for x in r.recs] for r in truth.collect()}
    assert got == want


def test_stream_over_bucketed_tables_equals_batch(spark, tmp_path):
    from reelrank.sources.tables import read_table, write_lookup_table
    er, sims, rated, recent, truth = _batch_truth(spark)
    paths = {}
    for name, df, key in (("sims", sims, "mid"), ("rated", rated, "uid"), ("recent", recent, "uid")):
        paths[name] = str(tmp_path / name)
        write_lookup_table(df, paths[name], key, buckets=4)
    msgs = loaders.render_lines(er.select("uid", "mid", "score", "ts", "event_id",
                                          (F.col("event_id") % 2).alias("part")), "|", " ",
                                keep=("event_id", "part"))
    msgs.write.partitionBy("part").parquet(str(tmp_path / "src"))
    store = KeyedStore(spark, str(tmp_path / "recs"))
    q = streaming.start_stream(streaming.file_messages(spark, str(tmp_path / "src"), max_files_per_trigger=4),
                               *(read_table(spark, paths[n]) for n in ("sims", "rated", "recent")),
                               store, str(tmp_path / "ckpt"), available_now=True, threshold=0.3)
    q.awaitTermination()
    got = {r.uid: [(x.mid, round(x.score, 9)) for x in r.recs] for r in store.current().collect()}
    want = {r.uid: [(x.mid, round(x.score, 9)) for x in r.recs] for r in truth.collect()}
    assert got == want


def test_kafka_shape_gives_unique_event_ids(spark):
    raw = spark.createDataFrame([(bytearray(b"1|2|3.0|4"), 7, p) for p in (0, 1, 5000)], "value binary, offset long, partition int")
    events = loaders.parse_rating_messages(streaming.kafka_events(raw))
    assert {tuple(r.event_id) for r in events.collect()} == {(7, 0), (7, 1), (7, 5000)}
    assert rerank.newest_per_user(events).count() == 1


def test_shared_folder_is_required_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from reelrank.session import checkpoint_root
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context)
    with pytest.raises(RuntimeError):
        checkpoint_root(session)


def _recent_rows(spark, src, store, ckpt, **kw):
    from reelrank.streaming import state
    state.start_recent_stream(streaming.file_messages(spark, src, max_files_per_trigger=1), store, ckpt, available_now=True, **kw).awaitTermination()
    return sorted((r.uid, r.pos, r.mid) for r in state.recent_table(store).collect())


def test_recent_state_restarts_compacts_and_takes_a_hot_user(spark, tmp_path):
    """A third of all rows are one user's; the stream stops, starts again and folds every second batch."""
    import random

    from reelrank.streaming import state
    rng = random.Random(4)
    rows = [(1 if i % 3 == 0 else rng.randrange(2, 40), rng.randrange(100), rng.randrange(1, 6) / 1.0, rng.randrange(500), i) for i in range(900)]
    events = spark.createDataFrame(rows, "uid int, mid int, score double, ts long, event_id long")
    src, store = str(tmp_path / "src"), state.recent_store(spark, str(tmp_path / "store"), buckets=8)
    half = loaders.render_lines(events, "|", keep=("event_id",))
    half.where("event_id < 300").coalesce(2).write.parquet(src + "/a=1")
    first = _recent_rows(spark, src, store, str(tmp_path / "ckpt"), compact_every=2)
    assert first == sorted((r.uid, r.pos, r.mid) for r in rerank.recent_ratings(events.where("event_id < 300")).collect())
    half.where("event_id >= 300").coalesce(3).write.parquet(src + "/a=2")
    again = state.recent_store(spark, str(tmp_path / "store"), buckets=8)
    assert _recent_rows(spark, src, again, str(tmp_path / "ckpt"), compact_every=2) == sorted(
        (r.uid, r.pos, r.mid) for r in rerank.recent_ratings(events).collect())
    assert again._snapshots()
    few = events.where("uid = 7").select("uid")
    plan = spark._jvm.PythonSQLUtils.explainString(again.current(keys=few)._jdf.queryExecution(), "formatted")
    scans = [b for b in plan.split("\n\n") if "Location: InMemoryFileIndex" in b and "uid_b8" in b]
    assert scans and all("array_contains(Subquery" in b for b in scans)
    assert {r.uid for r in again.current(keys=few).collect()} == {7}


def test_store_reads_only_committed_batches(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), buckets=4)
    rows = spark.createDataFrame([(1, [(5, 1.0)], 10, 1), (2, [], 10, 2)], store.schema)
    assert store.current().count() == 0
    store.upsert(rows, 0)
    store.upsert(rows.withColumn("ts", F.lit(99).cast("long")).where("uid = 1"), 1)
    (tmp_path / "s" / "batches" / "batch_id=1" / "_SUCCESS").unlink()  # batch 1 broke off
    assert {r.uid: r.ts for r in store.current().collect()} == {1: 10, 2: 10}
    store.upsert(rows.where("uid = 2").withColumn("ts", F.lit(50).cast("long")), 1)  # and ran again: nothing of it is left
    assert {r.uid: r.ts for r in store.current().collect()} == {1: 10, 2: 50}
    store.upsert(rows.where("false"), 2)
    store.compact(2)
    assert {r.uid: r.ts for r in store.current().collect()} == {1: 10, 2: 50}


def test_publish_keeps_readers_and_survives_a_crash(spark, tmp_path, monkeypatch):
    from reelrank.sources import tables
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(5), path)
    held = tables.read_table(spark, path)
    tables.overwrite_table(spark.range(100, 103), path)
    assert held.count() == 5 and sorted(r.id for r in tables.read_table(spark, path).collect()) == [100, 101, 102]

    def crash(*args):
        raise RuntimeError("gone")
    with monkeypatch.context() as m:
        m.setattr(tables, "publish_version", crash)
        try:
            tables.overwrite_table(spark.range(7), path)
        except RuntimeError:
            pass
    assert tables.read_table(spark, path).count() == 3  # the version that was not published is not seen
    for n in (8, 9, 10):
        tables.overwrite_table(spark.range(n).withColumn("x", F.lit(1)), path)
    assert tables.read_table(spark, path).count() == 10 and "x" in tables.read_table(spark, path).columns
    left = [d.name for d in (tmp_path / "t").iterdir() if d.is_dir()]
    assert len(left) == 2  # the current one and the one before
    tables.drop_table(spark, path)
    assert tables.current_version(spark, path) is None


def test_timed_batches_with_observed_counts_and_graceful_stop(spark, tmp_path):
    import time
    er, sims, rated, recent, _ = _batch_truth(spark)
    msgs = loaders.render_lines(er.select("uid", "mid", "score", "ts", "event_id"), "|", " ", keep=("event_id",)).cache()
    bad = spark.createDataFrame([("nothing", 10**9), ("1|2", 10**9 + 1)], "value string, event_id long")
    src, store, metrics = str(tmp_path / "src"), KeyedStore(spark, str(tmp_path / "recs"), buckets=4), streaming.BatchMetrics()
    msgs.where("event_id % 2 = 0").unionByName(bad).coalesce(1).write.parquet(src + "/a=1")
    q = streaming.start_stream(streaming.file_messages(spark, src, max_files_per_trigger=1), sims, rated, recent, store,
                               str(tmp_path / "ckpt"), interval="2 seconds", threshold=0.3, metrics=metrics)
    try:
        q.processAllAvailable()
        msgs.where("event_id % 2 = 1").coalesce(1).write.parquet(src + "/a=2")
        streaming.stop_gracefully(q)
        assert not q.isActive and q.exception() is None
        for _ in range(50):  # progress comes on the listener's own thread
            if metrics.ended and len(metrics.batches) == 2:
                break
            time.sleep(0.2)
    finally:
        q.stop()
        spark.streams.removeListener(metrics)
    assert sorted(metrics.batches) == [0, 1]
    for batch_id, rest in ((0, 0), (1, 1)):
        mine = er.where(F.col("event_id") % 2 == rest)
        stored = spark.read.parquet(str(tmp_path / "recs" / "batches" / f"batch_id={batch_id}"))
        n = mine.count()
        assert metrics.batches[batch_id] == {
            "messages": n + 2 * (rest == 0), "rejects": 2 * (rest == 0), "lists": mine.select("uid").distinct().count(),
            "entries": stored.agg(F.sum(F.size("recs"))).first()[0]}
