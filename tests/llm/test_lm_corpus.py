import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from reelrank.llm import lm


def brute(rows, mass=4.0):
    single, pair, texts = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    chains = [(r, [None, *lm.tokens(r.text)]) for r in rows]
    for r, t in chains:
        if len(t) > 1:
            single[r.target].update(t)
            pair[r.target].update(zip(t, t[1:]))
    totals = [sum(n for w, n in c.items() if w is not None) for c in single]
    scale = [min(totals) / n for n in totals] if min(totals) else [1, 1]
    vocabulary = len({w for c in single for w in c} - {None}) + 2
    out = []
    for r, t in chains:
        losses = []
        for c in (0, 1):
            own = c == r.target
            w1, w2 = (Counter(t), Counter(zip(t, t[1:]))) if own else (Counter(), Counter())
            n, loss = totals[c] - own * (len(t) - 1), 0
            for a, b in zip(t, t[1:]):
                p1 = ((single[c][b] - w1[b]) * scale[c] + 1) / (n * scale[c] + vocabulary)
                loss -= math.log(((pair[c][a, b] - w2[a, b]) * scale[c] + mass * p1) / ((single[c][a] - w1[a]) * scale[c] + mass))
            losses.append(loss / (len(t) - 1) if len(t) > 1 else None)
        out.append((r.doc_id, len(t) - 1, losses[1], losses[0]))
    return out


def same(got, want):
    def order(x):
        return [(v is not None, v or 0) for v in x[:2]] + [round(v or 0, 6) for v in x[2:]]

    got, want = sorted(((r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in got), key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        assert all((a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9)) for a, b in zip(g[2:], w[2:]))


def test_all_words_and_bigrams_count(spark):
    """More distinct words than any fixed vocabulary had."""
    n = 70_000
    rows = [(i, f"w{i} v{i} w{(i * 7) % n} v{(i * 7) % n} w{(i * 3) % n} v{(i * 3) % n}", i % 3 == 0) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target boolean").repartition(4)
    same(lm.op4_lm_scoring(docs, docs.where("target").selectExpr("doc_id", "1 quality", "0 toxic")).collect(), brute(docs.collect()))


@pytest.mark.parametrize("block, bucket, fan_in", [(1 << 24, 1 << 22, 256), (5_000, 20_000, 256), (1, 1 << 30, 1000), (5_000, 4_000, 6), (3_000, 2_000, 3)])
def test_against_plain_counts(spark, sf, block, bucket, fan_in):
    """One block, one round, and two and more rounds of merging."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    corpora = lm.marked(docs, labels)
    same(lm.corpus_scores(docs, labels, block_bytes=block, bucket_bytes=bucket, fan_in=fan_in).collect(), brute(corpora.collect()))


def test_merged_messages_come_back():
    """A node's blocks get the counts of their own keys, in their own order; its messages hold every key once."""
    blocks = {7: ["b", "a", "a b"], 9: ["c", "a"], 4: ["a b", "d", "b"]}
    sent = pa.table({"node": [2] * 3, "bucket": [5] * 3, "block": list(blocks), "keys": [lm._pack("\n".join(k).encode()) for k in blocks.values()],
                     **{c: [lm._pack(np.full(len(k), n, np.int32)) for k in blocks.values()] for n, c in enumerate(("background", "target"), 1)},
                     **{c: [n, 10 * n, 100 * n] for n, c in enumerate(lm.SUMS)}})
    up = lm._merged(4, 0, np.int32)(sent).to_pylist()
    keys = [k for r in up[1:] for k in lm._unpack(r["keys"]).decode().split("\n")]
    assert sorted(keys) == ["a", "a b", "b", "c", "d"]
    assert all(5 * 4 <= r["up"] < 6 * 4 for r in up[1:]) and sum(r["texts_t"] for r in up[1:]) == 111
    back = [up[0]] + [{**r, "state": None} for r in up[1:]]
    kinds = pa.schema([("bucket", pa.int64()), ("up", pa.int64()), ("state", pa.binary()), ("background", pa.binary()), ("target", pa.binary())])
    got = lm._handed_back(pa.Table.from_pylist(back[::-1], kinds)).to_pylist()
    holders = {k: sum(k in b for b in blocks.values()) for k in keys}
    assert [r["block"] for r in got] == list(blocks) and {r["bucket"] for r in got} == {5}
    for r in got:
        assert lm._unpack(r["background"], np.int64).tolist() == [holders[k] for k in blocks[r["block"]]]
        assert lm._unpack(r["target"], np.int64).tolist() == [2 * holders[k] for k in blocks[r["block"]]]


def test_edges_against_plain_counts(spark, edge_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 0), (6, 1, 1), (12, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.where("false")):
        corpora = lm.marked(edge_docs, given)
        same(lm.op4_lm_scoring(edge_docs, given).collect(), brute(corpora.collect()))
