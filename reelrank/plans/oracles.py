"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The domain views of FIXTURES.md §2 are inlined as CTEs over the driver's raw tables.
"""

from __future__ import annotations

from ..constants import ALS_GRID_RANKS, ALS_GRID_REGS, GENRES

_G = "[" + ", ".join(f"'{g}'" for g in GENRES) + "]"

_EVENT_MOVIE = ("CAST((event_id * 7919 + user_id * 104729) "
                "% (SELECT max(vec_id) + 1 FROM embeddings) AS INTEGER)")

CTE = {
    "ratings": """ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(l_partkey AS INTEGER) AS mid,
         CAST(ceil(l_quantity / 5) / 2 AS DOUBLE) AS score,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "movies": f"""movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
         {_G}[p_size % 20 + 1] || '|' || {_G}[CAST((length(p_type) * 7 + p_partkey // 100) % 20 + 1 AS INTEGER)] AS genres
  FROM part)""",
    "genres": "genres AS (SELECT unnest(" + _G + ") AS genre)",
    "event_ratings": f"""event_ratings AS (
  SELECT CAST(user_id AS INTEGER) AS uid, {_EVENT_MOVIE} AS mid,
         CAST(CAST(floor(value) AS BIGINT) % 10 + 1 AS DOUBLE) / 2 AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts, event_id
  FROM events)""",
    "tags": f"""tags AS (
  SELECT CAST(user_id AS INTEGER) AS uid, {_EVENT_MOVIE} AS mid,
         event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events)""",
    "vectors": """vectors AS (
  SELECT CAST(vec_id AS INTEGER) AS mid, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)""",
    "averages": """averages AS (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid)""",
    # all neighbours with cosine > 0.25, self pairs excluded
    "vnorm": """vnorm AS (SELECT mid, v, sqrt(list_dot_product(v, v)) AS n FROM vectors)""",
    "sims": """sims AS (
  SELECT mid, mid2, sim, row_number() OVER (PARTITION BY mid ORDER BY round(sim, 12) DESC, mid2) AS rank
  FROM (SELECT a.mid, b.mid AS mid2, list_dot_product(a.v, b.v) / (a.n * b.n) AS sim
        FROM vnorm a JOIN vnorm b ON a.mid <> b.mid WHERE a.n > 0 AND b.n > 0)
  WHERE sim > 0.25)""",
    # --- fixed values: bucket of each genre word under Spark 4's HashingTF(numFeatures=20) ---
    "buckets": """buckets(token, dim) AS (VALUES
  ('action', 13), ('adventure', 13), ('animation', 13), ('comedy', 12), ('crime', 11),
  ('documentary', 12), ('drama', 4), ('family', 17), ('fantasy', 19), ('foreign', 6),
  ('history', 3), ('horror', 6), ('music', 10), ('mystery', 19), ('romance', 6),
  ('science', 3), ('tv', 7), ('thriller', 6), ('war', 19), ('western', 4), ('', 12))""",
    "words": """words AS (SELECT mid, string_split(lower(replace(genres, '|', ' ')), ' ') AS words FROM movies)""",
    "tf": """tf AS (
  SELECT mid, dim, CAST(count(*) AS DOUBLE) AS tf
  FROM (SELECT mid, unnest(words) AS token FROM words) JOIN buckets USING (token)
  GROUP BY mid, dim)""",
    "tfidf": """tfidf AS (
  SELECT tf.mid, tf.dim, tf.tf * ln((nd.m + 1.0) / (d.df + 1.0)) AS w
  FROM tf JOIN (SELECT dim, count(DISTINCT mid) AS df FROM tf GROUP BY dim) d USING (dim),
       (SELECT count(*) AS m FROM movies) nd)""",
    "content_pairs": """content_pairs AS (
  SELECT d.mid, d.mid2, d.dot / (na.n * nb.n) AS sim
  FROM (SELECT a.mid, b.mid AS mid2, sum(a.w * b.w) AS dot
        FROM tfidf a JOIN tfidf b ON a.dim = b.dim AND a.mid <> b.mid GROUP BY a.mid, b.mid) d
  JOIN (SELECT mid, sqrt(sum(w * w)) AS n FROM tfidf GROUP BY mid) na ON na.mid = d.mid
  JOIN (SELECT mid, sqrt(sum(w * w)) AS n FROM tfidf GROUP BY mid) nb ON nb.mid = d.mid2
  WHERE na.n > 0 AND nb.n > 0 AND d.dot / (na.n * nb.n) > 0.6)""",
    # stream test set: newest event per user, newest 21 ratings, all rated pairs
    "event": """event AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn
                 FROM event_ratings) WHERE rn = 1)""",
    "recent": """recent AS (
  SELECT uid, CAST(pos AS INTEGER) AS pos, mid, score FROM (
    SELECT uid, mid, score, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS pos
    FROM event_ratings) WHERE pos <= 21)""",
    "cand": """cand AS (
  SELECT * FROM (
    SELECT e.uid, e.event_id, s.mid2 AS mid, s.sim,
           row_number() OVER (PARTITION BY e.uid, e.event_id ORDER BY round(s.sim, 12) DESC, s.mid2) AS rank
    FROM event e JOIN sims s ON s.mid = e.mid
    WHERE NOT EXISTS (SELECT 1 FROM event_ratings r WHERE r.uid = e.uid AND r.mid = s.mid2))
  WHERE rank <= 20)""",
    "scores": """scores AS (
  SELECT uid, event_id, mid,
         avg(sim * rscore) + log10(greatest(count(*) FILTER (WHERE rscore > 3), 1))
                           - log10(greatest(count(*) FILTER (WHERE rscore <= 3), 1)) AS score
  FROM (SELECT c.uid, c.event_id, c.mid, r.score AS rscore, s.sim
        FROM cand c JOIN recent r ON r.uid = c.uid
        JOIN sims s ON s.mid = c.mid AND s.mid2 = r.mid WHERE s.sim > 0.3)
  GROUP BY uid, event_id, mid)""",
    "split": """split AS (
  SELECT *, CAST('0x' || substr(md5(uid || ':' || mid), 1, 8) AS BIGINT) % 100 < 80 AS is_train
  FROM ratings)""",
}


def _with(names: list[str], body: str) -> str:
    return "WITH " + ",\n".join(CTE[n] for n in names) + "\n" + body


_EMPTY = ", ".join(f"'' AS {c}" for c in ("descri", "timelong", "issue", "shoot", "language"))

_CAND_OUT = "SELECT uid, CAST(rank AS INTEGER) AS rank, mid, round(sim, 6) AS sim FROM cand"

_SCORES_OUT = """
SELECT uid, CAST(row_number() OVER (PARTITION BY uid, event_id ORDER BY round(score, 12) DESC, mid) AS INTEGER) AS rank,
       mid, round(score, 6) AS score FROM scores"""

# held-out rows whose user and movie were trained on
_SCORED = """
, scored AS (
  SELECT * FROM split WHERE NOT is_train
    AND uid IN (SELECT uid FROM split WHERE is_train) AND mid IN (SELECT mid FROM split WHERE is_train))
"""

_STREAM = ["event_ratings", "vectors", "vnorm", "sims", "event", "recent", "cand", "scores"]

_MONTH = ("CAST(year(make_timestamp(\"timestamp\" * 1000000)) * 100 "
          "+ month(make_timestamp(\"timestamp\" * 1000000)) AS INTEGER)")

ORACLES: dict[str, str] = {
    "popular_movies": _with(["ratings"], "SELECT mid, count(mid) AS count FROM ratings GROUP BY mid"),
    "popular_by_month": _with(["ratings"], f"""
SELECT mid, count(mid) AS count, month
FROM (SELECT mid, {_MONTH} AS month FROM ratings) GROUP BY month, mid"""),
    "popular_by_month_sql": _with(["ratings"], f"""
SELECT mid, count(mid) AS count, month
FROM (SELECT mid, {_MONTH} AS month FROM ratings) GROUP BY month, mid"""),
    "average_movies": _with(["ratings"], "SELECT mid, round(avg(score), 6) AS avg FROM ratings GROUP BY mid"),
    "rating_month": _with(["ratings"], f"SELECT uid, mid, {_MONTH} AS month, score FROM ratings"),
    "movies_with_avg": _with(["ratings", "movies", "averages"], """
SELECT m.mid, m.name, round(a.avg, 6) AS avg FROM movies m JOIN averages a ON m.mid = a.mid"""),
    "movie_genre_match": _with(["movies", "genres"], """
SELECT g.genre, m.mid FROM movies m JOIN genres g ON contains(lower(m.genres), lower(g.genre))"""),
    "genre_top_movies": _with(["ratings", "movies", "averages", "genres"], """
SELECT genre, CAST(rank AS INTEGER) AS rank, mid, round(score, 6) AS score FROM (
  SELECT g.genre, m.mid, a.avg AS score,
         row_number() OVER (PARTITION BY g.genre ORDER BY a.avg DESC, m.mid ASC) AS rank
  FROM movies m JOIN averages a ON m.mid = a.mid
  JOIN genres g ON contains(lower(m.genres), lower(g.genre)))
WHERE rank <= 10"""),
    "distinct_ids": _with(["ratings"], """
SELECT DISTINCT 'user' AS kind, uid AS id FROM ratings
UNION ALL SELECT DISTINCT 'movie' AS kind, mid AS id FROM ratings"""),
    "load_movies": _with(["movies"], f"""
SELECT mid, name, {_EMPTY}, genres, '' AS actors, '' AS directors FROM movies"""),
    "load_ratings": _with(["ratings"], "SELECT uid, mid, score, \"timestamp\" FROM ratings"),
    "load_tags": _with(["tags"], "SELECT uid, mid, tag, \"timestamp\" FROM tags"),
    "parse_rating_messages": _with(["event_ratings"], "SELECT uid, mid, score, ts FROM event_ratings"),
    "table_roundtrip": _with(["ratings"], "SELECT uid, mid, score, \"timestamp\" FROM ratings"),
    "vector_cosine": _with(["vectors"], """
SELECT mid, label, round(list_dot_product(v, m) / nullif(sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(m, m)), 0), 6) AS sim
FROM vectors JOIN (
  SELECT label, list(x ORDER BY pos) AS m FROM (
    SELECT label, pos, avg(x) AS x
    FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vectors) GROUP BY label, pos)
  GROUP BY label) USING (label)"""),
    "item_similarity": _with(["vectors", "vnorm", "sims"], """
SELECT mid, CAST(rank AS INTEGER) AS rank, mid2, round(sim, 6) AS sim FROM sims"""),
    "similarity_map": _with(["vectors", "vnorm", "sims"], """
SELECT mid, count(*) AS n_entries FROM sims GROUP BY mid"""),
    "user_topk": _with(["vectors"], """
SELECT uid, CAST(rank AS INTEGER) AS rank, mid, round(score, 6) AS score FROM (
  SELECT uid, mid, score, row_number() OVER (PARTITION BY uid ORDER BY round(score, 12) DESC, mid) AS rank
  FROM (SELECT a.mid AS uid, b.mid AS mid, list_dot_product(a.v, b.v) AS score
        FROM vectors a, vectors b) WHERE score > 0)
WHERE rank <= 20"""),
    "user_topk_unseen": _with(["vectors", "event_ratings"], """
SELECT uid, CAST(rank AS INTEGER) AS rank, mid, round(score, 6) AS score FROM (
  SELECT uid, mid, score, row_number() OVER (PARTITION BY uid ORDER BY round(score, 12) DESC, mid) AS rank
  FROM (SELECT a.mid AS uid, b.mid AS mid, list_dot_product(a.v, b.v) AS score
        FROM vectors a, vectors b) p
  WHERE score > 0 AND NOT EXISTS (SELECT 1 FROM event_ratings r WHERE r.uid = p.uid AND r.mid = p.mid))
WHERE rank <= 20"""),
    "content_tokens": _with(["movies", "words"], """
SELECT mid, CAST(unnest(generate_series(1, len(words))) AS INTEGER) AS pos, unnest(words) AS token FROM words"""),
    "content_tf": _with(["movies", "words", "buckets", "tf"], "SELECT mid, dim, tf FROM tf"),
    "content_tfidf": _with(["movies", "words", "buckets", "tf", "tfidf"],
                           "SELECT mid, dim, round(w, 6) AS w FROM tfidf"),
    "content_similarity": _with(["movies", "words", "buckets", "tf", "tfidf", "content_pairs"], """
SELECT mid, CAST(row_number() OVER (PARTITION BY mid ORDER BY round(sim, 12) DESC, mid2) AS INTEGER) AS rank,
       mid2, round(sim, 6) AS sim FROM content_pairs QUALIFY rank <= 100"""),
    "content_signatures": _with(["movies", "words", "buckets", "tf", "tfidf", "content_pairs"], """
, sig AS (SELECT mid, list((dim, tf) ORDER BY dim) AS s FROM tf GROUP BY mid)
SELECT sig.mid, min(sig.mid) OVER (PARTITION BY s) AS sid, 1 + n AS n_similar
FROM sig JOIN (SELECT mid, count(*) AS n FROM content_pairs GROUP BY mid) USING (mid)"""),
    "content_signatures_wide": _with(["movies", "words"], """
, terms AS (SELECT mid, token AS dim, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT mid, unnest(words) AS token FROM words) GROUP BY ALL),
weights AS (
  SELECT t.mid, t.dim, t.tf, t.tf * ln((n.m + 1.0) / (d.df + 1.0)) AS w
  FROM terms t JOIN (SELECT dim, count(*) AS df FROM terms GROUP BY dim) d USING (dim), (SELECT count(*) AS m FROM movies) n),
lengths AS (SELECT mid, sqrt(sum(w * w)) AS n, list((dim, tf) ORDER BY dim) AS s FROM weights GROUP BY mid),
close AS (
  SELECT d.mid, d.mid2 FROM (
    SELECT a.mid, b.mid AS mid2, sum(a.w * b.w) AS dot FROM weights a JOIN weights b ON a.dim = b.dim GROUP BY a.mid, b.mid) d
  JOIN lengths x ON x.mid = d.mid JOIN lengths y ON y.mid = d.mid2 WHERE x.n > 0 AND y.n > 0 AND d.dot / (x.n * y.n) > 0.6)
SELECT l.mid, min(l.mid) OVER (PARTITION BY s) AS sid, c.n AS n_similar
FROM lengths l JOIN (SELECT mid, count(*) AS n FROM close GROUP BY mid) c USING (mid)"""),
    "unrated_tags": _with(["ratings", "tags"], """
SELECT uid, mid, tag, "timestamp" FROM tags t WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = t.uid AND r.mid = t.mid)"""),
    "recent_ratings": _with(["event_ratings", "recent"], "SELECT uid, pos, mid, score FROM recent"),
    "recent_items": _with(["event_ratings", "recent"], "SELECT uid, pos, mid, score FROM recent"),
    "recent_ratings_stream": _with(["event_ratings", "recent"], "SELECT uid, pos, mid, score FROM recent"),
    "published_versions": _with(["ratings", "tags"], """
SELECT uid, mid, "timestamp", 'old' AS version FROM tags UNION ALL SELECT uid, mid, "timestamp", 'new' FROM ratings"""),
    "drop_and_reload": _with(["tags"], "SELECT uid, mid, tag, \"timestamp\" FROM tags"),
    "tables_by_movie": _with(["ratings", "tags"], """
SELECT 'rating' AS "table", mid, count(*) AS n, min(uid) AS first_uid FROM ratings GROUP BY mid
UNION ALL SELECT 'tag', mid, count(*), min(uid) FROM tags GROUP BY mid"""),
    "stream_candidates": _with(["event_ratings", "vectors", "vnorm", "sims", "event", "cand"], _CAND_OUT),
    "stream_candidates_cut": _with(["event_ratings", "vectors", "vnorm", "sims", "event", "cand"], _CAND_OUT),
    "stream_scores": _with(_STREAM, _SCORES_OUT),
    "stream_scores_cut": _with(_STREAM, _SCORES_OUT),
    "stream_recs_upsert": _with(_STREAM, _SCORES_OUT),
    "stream_recs": _with(_STREAM, _SCORES_OUT),
    "train_test_split": _with(["ratings", "split"],
                              "SELECT uid, mid, score, \"timestamp\", is_train FROM split"),
    "random_split": _with(["ratings"], "SELECT uid, mid, score, \"timestamp\" FROM ratings"),
    "als_fit": _with(["ratings"], "SELECT uid, count(*) AS n_ratings, true AS solved FROM ratings GROUP BY uid"),
    "als_user_recs": _with(["ratings"], """
SELECT uid, least(20, (SELECT count(DISTINCT mid) FROM ratings)) AS n_recs, true AS ok FROM ratings GROUP BY uid"""),
    "als_item_recs": _with(["ratings"], "SELECT DISTINCT mid, true AS ok FROM ratings"),
    "als_predict_pairs": _with(["ratings", "split"], _SCORED + """
SELECT uid, mid, count(*) AS n, true AS same FROM scored GROUP BY uid, mid"""),
    "als_rmse": _with(["ratings", "split"], _SCORED + "SELECT count(*) AS n, true AS same FROM scored"),
    "als_grid_search": f"""
SELECT CAST(rank AS INTEGER) AS rank, CAST("lambda" AS DOUBLE) AS "lambda", true AS measured, true AS best_is_least
FROM (SELECT unnest({list(ALS_GRID_RANKS)}) AS rank), (SELECT unnest({list(ALS_GRID_REGS)}) AS "lambda")""",
    "rating_rmse": _with(["ratings", "split"], """
SELECT round(sqrt(avg(pow(t.score - m.prediction, 2))), 6) AS rmse, count(*) AS n
FROM (SELECT * FROM split WHERE NOT is_train) t
JOIN (SELECT mid, avg(score) AS prediction FROM split WHERE is_train GROUP BY mid) m ON m.mid = t.mid"""),
}
