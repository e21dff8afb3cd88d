"""Lookups in a similarity table that is cut must give what the whole table gives."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.operators import rerank
from reelrank.operators.pivots import VectorIndex
from reelrank.operators.similarity import cut_neighbours, item_similarity
from reelrank.sources.tables import read_table, write_lookup_table


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("beyond"))
    rng = np.random.default_rng(5)
    v = spark.createDataFrame([(i, (rng.normal(size=4) + 1).tolist()) for i in range(120)], "mid int, v array<double>")
    rows = [(u, int(m), float(rng.integers(1, 6)), int(t), u * 1000 + t) for u in range(6)
            for t, m in enumerate(rng.permutation(120)[:(0, 3, 20, 40, 70, 90)[u] + 1])]
    er = spark.createDataFrame(rows, "uid int, mid int, score double, ts long, event_id long").cache()
    whole = item_similarity(v, 0.25, block_rows=50).cache()
    lists, cut = cut_neighbours(v, 10, 0.25, block_rows=50)
    read = {}
    for name, df, key in (("sims", lists, "mid"), ("cut", cut, "mid"), ("rated", rerank.rated_pairs(er), "uid"), ("recent", rerank.recent_ratings(er), "uid")):
        write_lookup_table(df, f"{root}/{name}", key, 4)
        read[name] = read_table(spark, f"{root}/{name}")
    index = VectorIndex.write(v, f"{root}/vectors", block_rows=20, buckets=4)
    return er, whole, read, rerank.BeyondStored(read["cut"], index, 0.25)


def rows_of(df):
    return sorted((r.uid, r.rank, r.mid, round(r[-1], 9)) for r in df.collect())


def test_cut_table_gives_whole_candidates_and_scores(case):
    er, whole, read, beyond = case
    events, rated, recent = rerank.newest_per_user(er), rerank.rated_pairs(er), rerank.recent_ratings(er)
    want = rerank.stream_candidates(events, whole, rated).cache()
    assert max(r.n for r in want.groupBy("uid").count().toDF("uid", "n").collect()) == 20
    for rd, rc in ((rated, recent), (read["rated"], read["recent"])):
        assert rows_of(rerank.stream_candidates(events, read["sims"], rd, beyond=beyond)) == rows_of(want)
        scores = rows_of(rerank.stream_scores(want, whole, rc, 0.3))
        assert rows_of(rerank.stream_scores(want, read["sims"], rc, 0.3, beyond=beyond)) == scores
    assert rows_of(rerank.stream_candidates(events, read["sims"], rated)) != rows_of(want)
    assert rows_of(rerank.stream_scores(want, read["sims"], recent, 0.3)) != scores


def test_plans_read_only_what_the_events_touch(spark, case):
    """No job runs while candidates and scores are planned, and every scan of a stored table has the touched
    partitions as a filter."""
    er, whole, read, beyond = case
    events = rerank.newest_per_user(er).cache()
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    cand = rerank.stream_candidates(events, read["sims"], read["rated"], beyond=beyond)
    scores = rerank.stream_scores(events, read["sims"], read["recent"], 0.3, beyond=beyond)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    for df, tables in ((cand, {"sims", "cut", "rated", "by-id", "by-cell"}), (scores, {"sims", "cut", "recent", "by-id"})):
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        scans = [b for b in re.split(r"\n\n+", plan) if "Location: InMemoryFileIndex" in b]
        names = [re.search(r"/(sims|cut|rated|recent|by-id|by-cell)\b", b).group(1) for b in scans]
        assert set(names) == tables
        assert all(re.search(r"PartitionFilters: .*array_contains\(Subquery", b) for b in scans), scans


def test_other_buckets_are_not_opened(spark, tmp_path):
    from reelrank.sources.tables import bucket_of, buckets_of
    path = tmp_path / "t"
    write_lookup_table(spark.range(200).selectExpr("CAST(id AS INT) AS mid", "id AS x"), str(path), "mid", 8)
    keys = spark.createDataFrame([(5,), (6,), (5,)], "k int")
    hit = {r[0] for r in keys.select(bucket_of("k", 8)).collect()}
    table = read_table(spark, str(path))
    for d in path.glob("v*/mid_b8=*"):
        if int(d.name.split("=")[1]) not in hit:
            for f in d.glob("*.parquet"):
                f.write_bytes(b"broken")
            for f in d.glob(".*.crc"):
                f.unlink()
    rows = buckets_of(table, "mid", keys, "k").join(keys, F.col("mid") == F.col("k"), "left_semi").collect()
    assert sorted(r.x for r in rows) == [5, 6]
    assert buckets_of(table, "mid", keys.where("k > 9"), "k").count() == 0
