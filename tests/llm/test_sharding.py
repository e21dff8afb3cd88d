import zlib
from collections import Counter, defaultdict

from reelrank.llm import sharding


def check(docs, shards=16):
    rows = sharding.op9_sharding(docs, shards).collect()
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
                   for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted((tuple(r[:3]) for r in rows), key=str) == want
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_whole_table_and_edges(spark, sf, edge_docs, no_docs):
    check(spark.read.parquet(f"{sf}/documents.parquet"))
    check(edge_docs)
    assert sharding.op9_sharding(no_docs).count() == 0


def test_order_against_plain_ranks(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    draw = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(42, cast(doc_id as string)) AS h").collect()}
    by = defaultdict(list)
    for r in docs.collect():
        by[r.source].append(r.doc_id)
    line = sorted(((i + 0.5) / len(ids), draw[d], d) for ids in by.values() for i, d in enumerate(sorted(ids, key=lambda d: (draw[d], d))))
    n = len(line)
    want = {d: p * 16 // n for p, (_, _, d) in enumerate(line)}
    assert {r.doc_id: r.shard for r in sharding.op9_sharding(docs).collect()} == want


def test_every_shard_has_the_mixture(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 7) END AS source")
    rows = sharding.interleaved_shards(docs).collect()
    total = Counter(r.source for r in rows)
    for s in range(16):
        here = Counter(r.source for r in rows if r.shard == s)
        assert all(abs(here[k] - n / 16) <= 2 for k, n in total.items())


def test_no_python_in_the_plans(spark, sf):
    plan = sharding.op9_sharding(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
