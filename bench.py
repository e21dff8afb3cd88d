"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Every query is executed in full through the ``noop`` sink (nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "popular_movies", "popular_by_month", "average_movies", "genre_top_movies",
    "item_similarity", "user_topk", "content_similarity",
    "stream_tables", "stream_candidates", "stream_scores", "stream_recs",
    "als_train", "als_user_recs", "als_item_recs",
]


def main() -> None:
    from reelrank.plans import queries

    # the ALS lists are timed apart from the fit (rank 200) they all read, and what the stream does apart
    # from the similarity, rated and recent tables it looks up
    stored: dict = {}

    def lookups(s, d):
        if d not in stored:
            stored[d] = queries._lookups(s, d)
        return stored[d]

    QUERIES = dict(queries.QUERIES) | {
        "stream_tables": lambda s, d: lookups(s, d)[1],
        "stream_candidates": lambda s, d: queries._candidates(s, d, None, lookups(s, d)),
        "stream_scores": lambda s, d: queries._scores(s, d, None, lookups(s, d)),
        "stream_recs": lambda s, d: queries.q_stream_recs(s, d, lookups(s, d)),
        "als_train": lambda s, d: queries._model(s, d, False).userFactors,
        "als_user_recs": queries.als_user_lists, "als_item_recs": queries.als_item_lists,
    }
    from reelrank.session import build_session, drop_scratch

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # warm-up: JVM, Python workers and the parquet footers of the inputs
    QUERIES["popular_movies"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr)
    drop_scratch(spark)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
