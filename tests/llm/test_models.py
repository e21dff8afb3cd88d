import math
import zlib

import numpy as np
import pytest

from reelrank.llm import langid, lm, quality


# language ID

def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.op10_language_id(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*lang.values(), "und"} for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.95


def test_lang_of_held_out_rows_is_not_learned(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr(
        "doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 'zz' ELSE lang END AS lang")
    assert "zz" not in langid.fit(docs).languages


def test_chain_posteriors_by_enumeration():
    rng = np.random.default_rng(0)
    scores, log_t = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    lengths = np.array([4, 1, 2])
    got = langid.posteriors(scores, lengths, log_t)
    at = 0
    for n in lengths:
        weight = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            w = sum(scores[at + t, s] for t, s in enumerate(path)) + sum(log_t[a, b] for a, b in zip(path, path[1:]))
            w += math.log(np.exp(log_t[:, path[0]]).mean())
            for t, s in enumerate(path):
                weight[t, s] += math.exp(w)
        assert np.allclose(got[at:at + n], weight / weight.sum(axis=1, keepdims=True))
        at += n


def test_blocks_carry_the_whole_chain(monkeypatch):
    rng = np.random.default_rng(1)
    scores, log_t = rng.normal(size=(500, 4)), rng.normal(size=(4, 4)) * 2
    lengths = np.array([333, 1, 64, 65, 37])
    want = langid.posteriors(scores, lengths, log_t)
    for block in (1, 5, 1000):
        monkeypatch.setattr(langid, "BLOCK", block)
        assert np.allclose(langid.posteriors(scores, lengths, log_t), want)


def test_code_switched_words():
    en, fr = "the cat and the dog of that with from".split(), "le chat et les chiens de la maison pour".split()
    rng = np.random.default_rng(2)
    chains = [("en", list(rng.choice(en, 40))) for _ in range(60)] + [("fr", list(rng.choice(fr, 40))) for _ in range(60)]
    model = langid.train(chains, epochs=6)
    text = en * 3 + fr * 3 + en
    post = langid.Labeller(model).label([text])[0]
    gold = [0] * 27 + [1] * 27 + [0] * 9
    assert (post.argmax(axis=1) == gold).mean() > 0.95 and model.log_t[0, 0] > model.log_t[0, 1]


def test_language_edges(edge_docs, no_docs):
    model = langid.fit(edge_docs)
    rows = langid.predict(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {1, 2, 3, 10} <= und and 12 not in und and all(r.score == 0 for r in rows if r.lang_pred == "und")
    kept = langid.keep_identified(edge_docs, model, 0.0001)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r.lang_pred != "und" for r in rows)
    empty = langid.fit(no_docs)
    assert empty.languages == [] and {r.lang_pred for r in langid.predict(edge_docs, empty).collect()} == {"und"}
    assert langid.op10_language_id(no_docs).count() == 0
    assert langid.keep_identified(edge_docs, empty).count() == edge_docs.count()


# language-model scoring

def test_lm_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 0), (6, 1, 1), (None, 1, 0), (8, None, None)], "doc_id long, quality int, toxic int")
    rows = lm.op4_lm_scoring(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    assert all((r.score is None) == (r.n_tokens == 0) for r in rows) and {r.doc_id for r in rows if r.n_tokens == 0} == {1, 2, 3, None}
    assert lm.op4_lm_scoring(edge_docs, labels.where("false")).count() == edge_docs.count()
    assert lm.op4_lm_scoring(no_docs, labels).count() == 0


# quality

def test_held_out_grades(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rated = quality.graded(labels)
    train, test = rated.where("doc_id % 4 <> 0"), {r.doc_id: r.grade for r in rated.where("doc_id % 4 = 0").collect()}
    rows = [r for r in quality.score(docs, quality.fit(docs, train)).collect() if r.doc_id in test]
    mean = {g: np.mean([r.expected_grade for r in rows if test[r.doc_id] == g]) for g in (0, 1, 2)}
    assert mean[0] < mean[1] < mean[2]
    toxic = [r.p_not_lowest < 0.5 for r in rows if test[r.doc_id] == quality.TOXIC]
    clean = [r.p_not_lowest >= 0.5 for r in rows if test[r.doc_id] == quality.GOOD]
    assert np.mean(toxic) > 0.85 and np.mean(clean) > 0.97


def test_thresholds_are_ordered_and_tails_nested():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 300)
    rows = [np.unique(np.array([g, 10 + g // 2, *rng.integers(100, 140, 3)])) for g in grades]
    model = quality.train(rows, grades, levels=4)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(rows)
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.corrcoef(tails.sum(axis=1), grades)[0, 1] > 0.9


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (5, 0, 0), (6, 1, 0), (None, 1, 0), (8, None, None)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in quality.graded(labels).collect()} == {4: 0, 5: 1, 6: 2}
    rows = quality.op5_quality(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.expected_grade <= 2 for r in rows)
    assert all(r.expected_grade is None and r.selected for r in quality.op5_quality(edge_docs, labels.where("false")).collect())
    assert quality.op5_quality(no_docs, labels).count() == 0


@pytest.mark.parametrize("text", ["", "   ", "!!!", "a", None])
def test_every_text_has_features(text):
    assert len(quality.features(text)) > 0
