import random
from itertools import combinations

import numpy as np
import xxhash

from reelrank.llm import simhash as S
from reelrank.llm.common import connected_components


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    grams = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(pairs):
    """(id, fingerprint) -> {fingerprint: least id of its component}."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 2:
            root[find(b)] = find(a)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return {f: least.get(find(f)) for f in fps}


def check(docs):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    least = plain_components(rows)
    want = sorted(((i, "%016x" % f, least[f]) for i, f in rows), key=str)
    assert sorted(map(tuple, S.op1_simhash(docs).collect()), key=str) == want


def test_whole_table(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    assert S.op1_simhash(no_docs).count() == 0


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(0)
    v = rng.integers(-2**63, 2**63 - 1, 3000)
    for bits in (0, 1, 2):
        w = v.view(np.uint64)
        for _ in range(bits):
            w = w ^ (np.uint64(1) << rng.integers(0, 64, len(v)).astype(np.uint64))
        for a, b in zip(S.golay_keys(v).tolist(), S.golay_keys(w.view(np.int64)).tolist()):
            assert set(a) & set(b)


def test_hot_buckets_keep_components(spark):
    random.seed(1)
    base = random.getrandbits(64)
    fps = {base} | {base ^ sum(1 << b for b in random.sample(range(64), random.randint(1, 4))) for _ in range(400)}
    fps |= {random.getrandbits(64) for _ in range(100)}
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    frame = spark.createDataFrame(signed, "fp long")
    least = plain_components([(i, f) for i, f in enumerate(sorted(fps))])
    for bucket in (2, 64):
        roots = {r.node: r.root for r in connected_components(S.links(frame, 2, bucket)).collect()}
        groups = {}
        for f in fps:
            s = int(np.uint64(f).view(np.int64))
            groups.setdefault(roots.get(s, s), set()).add(least[f])
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(least.values()))


def test_components_of_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 200), (300, 300)]
    random.shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}


def test_keep_one(edge_docs, no_docs):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # rows without an id are copies of rows with one: of the letterless texts the first stays
    assert ids.count(4) == 1 and 7 not in ids and 6 in ids and ids.count(None) == 0 and 1 in ids and 2 not in ids
    assert S.keep_one(no_docs).count() == 0


def test_every_row_is_judged_by_its_own_text(spark):
    texts = ["one two three four five", "quite another text with other words", "a third one that nobody has seen yet"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (3, texts[0])]
    kept = S.keep_one(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, _row int"))
    assert kept.columns == ["doc_id", "text", "_row"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2])], key=str)
