import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.llm import suffix as S

SPAN = 200


def plain(texts):
    """(n_bytes, n_removed, n_spans, kept) of every text by counting all windows."""
    seen = Counter(t[i:i + SPAN] for t in texts for i in range(len(t) - SPAN + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - SPAN + 1):
            if seen[t[i:i + SPAN]] > 1:
                gone[i:i + SPAN] = b"\1" * SPAN
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone) if not g)))
    return out


def check(docs, **kw):
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(rows, plain([(r.text or "").encode() for r in rows]))), key=str)
    got = S.remove_repeats(docs, **kw).select("doc_id", "n_bytes", "n_removed", F.size("spans"), "kept").collect()
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=str) == want


@pytest.fixture(scope="module")
def spliced(spark):
    random.seed(5)
    words = ["%x" % random.getrandbits(random.choice([8, 16, 24])) for _ in range(2000)]
    base = [" ".join(random.choice(words) for _ in range(random.randint(5, 300))) for _ in range(10)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(random.randint(0, 4)):
            b = random.choice(base)
            at = random.randint(0, max(0, len(b) - 10))
            parts.append(b[at:at + random.randint(50, 900)] if random.random() < 0.7
                         else " ".join(random.choice(words) for _ in range(random.randint(0, 150))))
        docs.append((i, "é".join(parts)))
    docs += [(1002, "a" * 1000), (1003, "ab" * 300), (1004, "x" * 199), (1005, "y" * 200), (1006, "z" * 201),
             (1007, "q" * 200), (1008, "q" * 200)]
    return spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("crowd", [2, 20_000])
def test_against_all_windows(spliced, crowd):
    check(spliced, crowd=crowd)


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    assert S.op3_suffix_dedup(no_docs).count() == 0
    kept = S.drop_repeats(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    rows = {r.doc_id: r for r in kept.collect()}
    assert rows[1].text is None and rows[4].text == "" and rows[5].n_chars == len(rows[5].text) and rows[13].text == "one"
    assert S.drop_repeats(no_docs).count() == 0


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    want = sorted((r.doc_id, *x[:3], hashlib.sha256(x[3]).hexdigest())
                  for r, x in zip(rows, plain([(r.text or "").encode() for r in rows])))
    assert sorted(map(tuple, S.op3_suffix_dedup(docs).collect())) == want


def test_long_texts_go_in_steps(monkeypatch):
    rng = np.random.default_rng(3)
    text = rng.integers(97, 101, 9000).astype(np.uint8)

    def digests():
        return {(int(p), int(k), int(c)) for x in S.anchors(text, SPAN) for p, k, c in zip(x.places, x.keys, x.contexts)}

    once = digests()
    monkeypatch.setattr(S, "STEP", 700)
    assert digests() == once


def test_multikey_order_is_the_sorted_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 21)).astype(np.uint8)
    rows[100:200, :16] = rows[0, :16]
    group, last = rng.integers(0, 3, 300), rng.integers(0, 5, 300)
    order = S.multikey_order(S._words(rows), group, last)
    want = sorted(range(300), key=lambda i: (group[i], rows[i].tobytes(), last[i]))
    key = [(group[i], rows[i].tobytes(), last[i]) for i in order]
    assert key == [(group[i], rows[i].tobytes(), last[i]) for i in want]


@pytest.mark.parametrize("short, sort", [(1, 7), (3, 7), (24, 8000), (10**6, 50), (6, 8000)])
def test_buckets_against_counted_windows(monkeypatch, short, sort):
    monkeypatch.setattr(S, "SHORT", short)
    monkeypatch.setattr(S, "SORT", sort)
    rng = np.random.default_rng(4)
    passage = rng.integers(97, 123, 700).astype(np.uint8)
    left, lead = S.REACH - 1, SPAN - S.REACH + 1
    rows = {}
    for _ in range(60):
        a, b = sorted(rng.integers(0, 700, 2))
        passage[300:330] = 0  # zero bytes are text like any other
        text = np.concatenate([rng.integers(97, 123, rng.integers(0, 80)).astype(np.uint8), passage[a:b],
                               rng.integers(97, 123, rng.integers(0, 80)).astype(np.uint8)])
        for x in S.anchors(text, SPAN):
            for p, k, c in zip(x.places.tolist(), x.keys.view(np.int64).tolist(), x.contexts.view(np.int64).tolist()):
                before = min(p, left)
                rows[k, c] = (text[p - before:p + SPAN].tobytes(), before)
    order = sorted(rows, key=lambda n: rows[n][0][rows[n][1]:rows[n][1] + lead])
    seen = Counter()
    for context, at in rows.values():
        for o in range(max(0, SPAN - len(context) + at), at + 1):
            seen[context[at - o:at - o + SPAN], o] += 1
    want = {}
    for n, (context, at) in rows.items():
        mask = [0 <= at - o and at - o + SPAN <= len(context) and seen[context[at - o:at - o + SPAN], o] > 1 for o in range(S.REACH)]
        if any(mask):
            want[n] = np.packbits(np.array(mask)).tobytes()
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in order]), pa.array([c for _, c in order]), pa.array([rows[n][0] for n in order], pa.binary()),
         pa.array([rows[n][1] for n in order], pa.int32()), pa.array([True] * len(order))], ["key", "ctx", "context", "at", "alone"])
    got = {}
    for out in S._sort_bucket(SPAN)(iter([batch.slice(i, 40) for i in range(0, len(order), 40)])):
        for r in out.to_pylist():
            got[r["key"], r["ctx"]] = r["mask"]
    assert got == want and len(want) > 50


def test_hot_keys_and_repeated_rows(spark, monkeypatch):
    """With a key hot from its third row on, most joins are broadcast; rows that repeat exactly share a routing key."""
    monkeypatch.setattr(S, "HOT", 2)
    rng = random.Random(12)
    line = "".join(rng.choice("abcdefgh ") for _ in range(260))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(50, 300))) + line + str(i) * 40) for i in range(30)]
    rows += [(7, line * 3)] * 9 + [(None, line)] * 4 + [(100 + i, rows[3][1]) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept.decode()) for r in S.remove_repeats(docs).collect())
    monkeypatch.setattr(S, "HOT", 10_000)
    assert got == Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept.decode()) for r in S.remove_repeats(docs).collect())
    assert got == Counter((i, len(t), len(t) - len(k), k) for (i, t), k in zip(rows, plain_kept([t for _, t in rows], 200)))


def plain_kept(texts, span):
    seen = Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - span + 1):
            if seen[t[i:i + span]] > 1:
                gone.update(range(i, i + span))
        out.append("".join(c for i, c in enumerate(t) if i not in gone))
    return out
