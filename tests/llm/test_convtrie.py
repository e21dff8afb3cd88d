import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from reelrank.llm import convtrie


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, cs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(cs) - 1) * words
    return sorted((min(cs), len(node), min(members[node[:-1]]) if node else -10**9, len(cs), children[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(cs) if whole[c] == node).encode()).hexdigest())
                  for node, cs in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth string, run int"


def result(df, **kw):
    out = convtrie.prefix_trie(df, **kw)
    assert out.columns == COLUMNS
    return sorted(tuple(-10**9 if v is None else v for v in r) for r in out.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-45, 130), 10**12, 10**12 + 1, 2**62]:
        story = rng.randrange(4)
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
            text = f"story {story} says {t}" if rng.random() < 0.8 else f"other\t\x0b{rng.randrange(5)} x"
            rows.append((c, t, ("user", "assistant")[t % 2], text))
    rows += [(200 + i, t, "user", f"same words {t}") for i in range(60) for t in range(6)]      # copies
    rows += [(300, t, "user", f"long {t % 3}") for t in range(400)] + [(301, t, "user", f"long {t % 3}") for t in range(390)]
    rows += [(5, None, None, None), (5, None, "user", ""), (6, 1, "a", "b"), (6, 1, "a", "b"), (6, 1, "", "ab"), (None, 1, "user", "x"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [convtrie.MOST_CELLS, 1], ids=["sketch", "least"])
def test_against_brute_force(spark, monkeypatch, cells):
    """With a sketch of 64 cells nearly nothing is proven and all is grouped: the same nodes."""
    if cells == 1:
        monkeypatch.setattr(convtrie, "LEAST_CELLS", 64)
        monkeypatch.setattr(convtrie, "CHUNK_IDS", 7)
        monkeypatch.setattr(convtrie, "FLUSH_ROWS", 50)
    rows = conversations(3)
    assert result(frame(spark, rows), most_cells=cells) == brute(rows)


def test_edges(spark):
    assert result(frame(spark, [(None, 1, "u", "x")])) == []
    assert result(frame(spark, []).where("conv_id = 1")) == []
    for rows in ([(40, 1, "u", None)], [(41, 1, "u", "a b")] * 3, [(c, 0, "u", "hot turn") for c in range(400, 460)]):
        assert result(frame(spark, rows)) == brute(rows)


def test_whole_table(spark, sf):
    table = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = result(table)
    assert len(got) > 100 and got == brute(rows)


def test_sketch_never_misses_a_shared_prefix(spark):
    import numpy as np
    df = spark.range(3000).selectExpr("id % 1000 AS p1", "xxhash64(id % 1000) AS p2", "id % 7 AS depth").selectExpr("xxhash64(p1) AS p1", "p2", "p1 % 7 AS depth")
    one = spark.range(5000).selectExpr("xxhash64(id, 1) AS p1", "xxhash64(id, 2) AS p2", "id % 7 AS depth")
    both = df.unionByName(one)
    bits = convtrie.sketch(both, 1 << 16)
    p = both.toPandas().to_numpy(np.int64)
    a, b = ((bits[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 for c in convtrie._cells(p[:, 0].copy(), p[:, 1].copy(), p[:, 2].copy(), 1 << 16))
    found = (a & b).astype(bool)
    assert found[:3000].all() and found[3000:].mean() < 0.05
