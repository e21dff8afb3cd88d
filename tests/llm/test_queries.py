import duckdb

import __spark_entry__ as entry
from reelrank.llm.queries import ORACLES, QUERIES


def test_all_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_oracles(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, sf)
        want = con.sql(sql)
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        order = [want.columns.index(c) for c in cols]
        assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)
