import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from reelrank.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            counts[low] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def result(docs):
    rows = spelling.op12_spelling_variants(docs).collect()
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows)


def variants(rng, word, letters, k):
    out = {word}
    for _ in range(k):
        w = list(rng.choice(sorted(out)))
        i = rng.randrange(len(w) + 1)
        how = rng.randrange(3)
        if how == 0:
            w.insert(i, rng.choice(letters))
        elif i < len(w):
            w[i:i + 1] = [rng.choice(letters)] if how == 1 or len(w) <= 7 else []
        out.add("".join(w))
    return out


def test_block_against_edit_distance():
    rng = random.Random(1)
    words = set()
    for _ in range(12):
        words |= variants(rng, "".join(rng.choice("abé") for _ in range(rng.randrange(7, 12))), "abéÿ", 25)
    words |= {"a" * n for n in range(7, 80)}
    words = sorted(words)
    for m in (np.array([len(w) for w in words]), np.array([len(w) - 1 for w in words])):
        i, j = spelling.near_in_block(words, m)
        want = {(a, b) for a in range(len(words)) for b in range(len(words))
                if m[a] == len(words[a]) and len(words[b]) >= len(words[a]) and one_edit(words[a], words[b])}
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


@pytest.mark.parametrize("group", [2048, 4])
def test_all_near_pairs(spark, monkeypatch, group):
    """With groups of four the halving goes on down to single letters."""
    monkeypatch.setattr(spelling, "GROUP", group)
    monkeypatch.setattr(spelling, "BLOCK_ROWS", 16)
    rng = random.Random(2)
    words = set()
    for _ in range(15):
        words |= variants(rng, "".join(rng.choice("abcde") for _ in range(rng.randrange(7, 14))), "abcdeÀ", 20)
    words |= {"aaaa" + "".join(rng.choice("ab") for _ in range(rng.randrange(3, 7))) for _ in range(120)} | {"é" * n for n in range(7, 30)}
    words = sorted(words)
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    got = sorted(tuple(r) for r in spelling.near_words(df).collect())
    assert got == sorted((a, b, words.index(b) + 2) for a in words for b in words if one_edit(a, b))


def test_chain_of_forms_ties_and_repeats(spark):
    text = " ".join(["abcdefg"] * 2 + ["abcdefgh"] * 50 + ["abcdefghi"] * 600 + ["Abcdefghij"] * 6500 + ["bcdefgh"] * 30 + ["zzzzzzzz", "zzzzzzz"]
                    + ["ÀBCDEFÉ"] * 2 + ["Àbcdeffé"] * 30 + ["Àbcdefgé"] * 30)
    rows = [(1, text), (1, text), (None, "abcdefg abcdefg, abcdefg"), (2, None), (3, ""), (4, "abcdefg1abcdefg_abc"), (5, "x" * 50_000 + " " + "x" * 49_999)]
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string")
    got = result(docs)
    assert got == brute(rows)
    roots = {r[0]: r[2] for r in got}
    assert roots["abcdefg"] == "abcdefghij"


def test_whole_table_and_edges(spark, sf, edge_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert result(edge_docs) == brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert result(no_docs) == [] and result(edge_docs.where("text IS NULL OR text = ''")) == []
    got = result(docs)
    assert len(got) > 100 and got == brute([(r.doc_id, r.text) for r in docs.collect()])
