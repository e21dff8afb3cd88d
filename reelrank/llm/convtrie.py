"""Prefix trie of conversations: count-min screening, local tails, exact groups for the rest.

A conversation's prefix of d turns has the digest XOR over i <= d of hash(i, turn i), two longs, so
prefixes of a conversation of any length are running XORs over sorted rows, computed run by run
(one partition's rows of one conversation) and carried from run to run. A count-min sketch of all
prefix digests, saturating at two, proves most prefixes to be in one conversation only: these rows become
nodes where they are. Only the others are grouped by digest, counted and joined, and those joins are
dealt by (digest, run) first, so a turn, prefix or conversation that holds a third of all rows is
spread over the runs it lies in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import ship_package

from .common import materialise, spread_join
from .spelling import crc32_sql

WORD = r"[^\x20\x09-\x0D]+"
SHARED_BY, HEADS = 20, 4
#: Cells of a sketch row: eight for each prefix, at most 2^26; the broadcast sketch is two rows of a
#: bit a cell, 16 MB at most. Beyond that more prefixes than needed are grouped; the result is the same.
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 26
BLOCK = 1 << 16
FLUSH_ROWS = 1 << 20
#: Ids of a chunk of a node's list of ends.
CHUNK_IDS = 1 << 16

NODE = ["depth", "p1", "p2"]
PARENT = ["depth", "q1", "q2"]
RUN = ["run", "conv"]


def _md5_long(text: Column, half: int) -> Column:
    return F.conv(F.substring(text, 1 + 16 * half, 15), 16, 10).cast("long")


def _turns(conversations: DataFrame) -> DataFrame:
    """(at, run, conv, t1, t2, words), a row a turn in order, stored; run is the sorted partition."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["conv", "turn", "role", "text"]
    sign = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "conv", sign.alias("sign"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("at"))
    return materialise(rows.select("at", F.shiftright("at", 33).alias("run"), "conv", _md5_long(F.col("sign"), 0).alias("t1"),
                                   _md5_long(F.col("sign"), 1).alias("t2"), "words"), "trie-turns")


def _before(runs: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Add to each run of a conversation the aggregates ``sums`` over that conversation's earlier runs."""
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select("*", *(F.coalesce(c.over(earlier), F.lit(0).cast("long")).alias(k) for k, c in sums.items()))


def _hashes(t1: Column, t2: Column, depth: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), t1, t2, depth.cast("long")) for seed in (1, 2)]


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, last, words, before, p1, p2, q1, q2, run): a row for each prefix of each rebuilt
    conversation, the empty one included; ``last`` is the conversation's length, ``before`` the words before the
    prefix's last turn, p its digest and q its parent's."""
    runs = _before(turns.groupBy(*RUN).agg(F.count("*").alias("n"), F.min("at").alias("first")), {"skipped": F.sum("n")})
    convs = runs.groupBy("conv").agg(F.sum("n").alias("own")).withColumn(
        "h", (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("long")).withColumn("base", F.col("conv") - F.col("conv") % SHARED_BY)
    # at most three turns of a base conversation are lent
    placed = turns.join(runs, RUN).withColumn("pos", F.col("at") - F.col("first") + F.col("skipped") + 1)
    heads = placed.where((F.col("pos") < HEADS) & (F.col("conv") % SHARED_BY == 0)).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t1", "t2", "words"))).alias("head"))
    convs = convs.join(heads, "base", "left").withColumn(
        "head", F.when(F.col("head").isNull(), F.array().cast("array<struct<pos:long,t1:long,t2:long,words:long>>")).otherwise(
            F.slice("head", F.lit(1), F.col("h").cast("int"))))
    convs = convs.withColumn("m", F.size("head").cast("long")).withColumn("last", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))

    # rows lent by the base, and the empty prefix; a handful a conversation
    zero = F.lit(0).cast("long")
    steps = F.expr("""aggregate(head, array(named_struct('depth', 0L, 'words', 0L, 'before', 0L, 'p1', 0L, 'p2', 0L, 'q1', 0L, 'q2', 0L)),
      (a, t) -> a || array(named_struct('depth', t.pos, 'words', t.words, 'before', element_at(a, -1).before + element_at(a, -1).words,
        'p1', element_at(a, -1).p1 ^ xxhash64(1, t.t1, t.t2, t.pos), 'p2', element_at(a, -1).p2 ^ xxhash64(2, t.t1, t.t2, t.pos),
        'q1', element_at(a, -1).p1, 'q2', element_at(a, -1).p2)))""")
    convs = materialise(convs.select("conv", "h", "m", "last", steps.alias("steps")), "trie-convs")
    parts = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lent = convs.select("conv", "last", F.inline("steps"), F.pmod(F.xxhash64("conv"), F.lit(parts)).alias("run"))

    # own turns after the first h: running digests within a run, then those of the runs before
    top = F.element_at("steps", -1)
    runs = runs.join(convs.select("conv", "h", "m", "last", top["p1"].alias("r1"), top["p2"].alias("r2"),
                                  (top["before"] + top["words"]).alias("lent_words")), "conv")
    own = turns.join(runs, RUN).withColumn("pos", F.col("at") - F.col("first") + F.col("skipped") + 1).where("pos > h")
    own = own.withColumn("depth", F.col("m") + F.col("pos") - F.col("h"))
    x1, x2 = _hashes(F.col("t1"), F.col("t2"), F.col("depth"))
    own = own.select(*RUN, "at", "depth", "words", x1.alias("x1"), x2.alias("x2"), "last", "r1", "r2", "lent_words")
    local = Window.partitionBy(*RUN).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = _before(own.groupBy(*RUN).agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"), F.sum("words").alias("y")),
                     {"c1": F.bit_xor("y1"), "c2": F.bit_xor("y2"), "c": F.sum("y")})
    own = own.withColumn("l1", F.bit_xor("x1").over(local)).withColumn("l2", F.bit_xor("x2").over(local)).withColumn(
        "l", F.sum("words").over(local)).join(totals.select(*RUN, "c1", "c2", "c"), RUN)
    p = [F.col(f"l{i}").bitwiseXOR(F.col(f"c{i}")).bitwiseXOR(F.col(f"r{i}")) for i in (1, 2)]
    own = own.select("conv", "last", "depth", "words", (F.col("l") + F.col("c") + F.col("lent_words") - F.col("words")).alias("before"),
                     p[0].alias("p1"), p[1].alias("p2"), p[0].bitwiseXOR(F.col("x1")).alias("q1"), p[1].bitwiseXOR(F.col("x2")).alias("q2"), "run")
    return lent.select(*own.columns).unionByName(own)


# --- screening ------------------------------------------------------------------------------------

def _cells(p1: np.ndarray, p2: np.ndarray, depth: np.ndarray, cells: int) -> list[np.ndarray]:
    """The prefix's cell in each of the two rows of the sketch."""
    step = depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return [((p.view(np.uint64) ^ step) >> np.uint64(20) & np.uint64(cells - 1)).astype(np.int64) + r * cells for r, p in enumerate((p1, p2))]


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def _count_cells(cells: int, width: int, flush_rows: int) -> Callable:
    """Partial sketches: for every block of cells touched, the offsets met once and those met again."""
    def flush(seen: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cell, n = np.unique(np.concatenate(seen), return_counts=True)
        seen.clear()
        block = cell // width
        cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(cell))
        offsets, again = (cell % width).astype("<u2"), n > 1
        out = ([], [], [])
        for a, b in zip(cuts[:-1], cuts[1:]):
            out[0].append(int(block[a]))
            out[1].append(offsets[a:b][~again[a:b]].tobytes())
            out[2].append(offsets[a:b][again[a:b]].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["block", "once", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = [], 0
        for batch in batches:
            p1, p2, depth = _columns(batch, ["p1", "p2", "depth"])
            seen += _cells(p1, p2, depth, cells)
            rows += len(p1)
            if rows >= flush_rows:
                yield from flush(seen)
                rows = 0
        if rows:
            yield from flush(seen)
    return run


def _merge_cells(width: int) -> Callable:
    """Sum the partial sketches of the blocks dealt to this task; a bit a cell says two or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, once, more in zip(*(c.to_pylist() for c in batch.columns)):
                c = counts.setdefault(block, np.zeros(width, np.uint8))
                at = np.frombuffer(once, "<u2")
                c[at] = np.minimum(c[at] + 1, 2)
                c[np.frombuffer(more, "<u2")] = 2
        for block, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(c > 1).tobytes()], pa.binary())], ["block", "bits"])
    return run


def sketch(prefixes: DataFrame, cells: int) -> np.ndarray:
    """Bits of the merged count-min sketch (two rows of ``cells`` cells): whether a cell counts two or more."""
    width = min(cells, BLOCK)
    parts = max(1, min(2 * cells // width, int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    partial = prefixes.select("p1", "p2", "depth").mapInArrow(_count_cells(cells, width, FLUSH_ROWS), "block int, once binary, more binary")
    merged = partial.repartition(parts, "block").mapInArrow(_merge_cells(width), "block int, bits binary")
    bits = np.zeros(2 * cells // 8, np.uint8)
    size = width // 8
    for row in merged.toLocalIterator():  # 2 * cells bits in all
        bits[row["block"] * size:(row["block"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _screen(bits, cells: int) -> Callable:
    def possible(table: np.ndarray, p1: np.ndarray, p2: np.ndarray, depth: np.ndarray) -> np.ndarray:
        a, b = ((table[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 for c in _cells(p1, p2, depth, cells))
        return (a & b).astype(bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            p1, p2, q1, q2, depth = _columns(batch, ["p1", "p2", "q1", "q2", "depth"])
            shared = possible(table, p1, p2, depth)
            above = possible(table, q1, q2, depth - 1) & (depth > 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared), pa.array(above)], [*batch.schema.names, "shared", "above"])
    return run


# --- ends of a node -------------------------------------------------------------------------------

def _key_runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[tuple, list]]:
    """(node key, ids): pieces of at most ``most`` rows of one node, in the order of the rows."""
    key, held = None, []
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in (*NODE, "conv")]
        for *now, v in zip(*cols):
            if now != key or len(held) >= most:
                if held:
                    yield tuple(key), held
                key, held = now, []
            held.append(v)
    if held:
        yield tuple(key), held


def _node_batch(key: tuple, names: list[str], values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()) for k in key] + [pa.array([v]) for v in values], [*NODE, *names])


def _join_ids(most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, ids in _key_runs(batches, most):
            yield _node_batch(key, ["first", "ids"], [ids[0], ",".join(map(str, ids))])
    return run


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key = digest = None
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in (*NODE, "ids")]
        for *now, ids in zip(*cols):
            if now != key:
                if key is not None:
                    yield _node_batch(tuple(key), ["ends_sha256"], [digest.hexdigest()])
                key, digest = now, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
    if key is not None:
        yield _node_batch(tuple(key), ["ends_sha256"], [digest.hexdigest()])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the conversations ``ends`` (node, conv) that end at a node.

    Ids are sorted and joined to chunks by ranges of (node, conv), so a node with very many ends is
    joined by many tasks; only the hash itself, which cannot be split, reads a node's chunks one after the other.
    """
    parts = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [*NODE, "conv"]
    sorted_ids = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    node = "depth long, p1 long, p2 long, "
    chunks = sorted_ids.mapInArrow(_join_ids(CHUNK_IDS), node + "first long, ids string")
    return chunks.repartition(parts, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_hash_ids, node + "ends_sha256 string")


# --- the trie -------------------------------------------------------------------------------------

def prefix_trie(conversations: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The nodes of the trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Turns are ordered by turn (null first), then role, then text; null role or text is empty. Conversation c
    is rebuilt as the first h turns of c - c % 20 (h: CRC-32 of the decimal id, modulo 4) and its own turns
    after its first h. A node is a distinct sequence of first turns, the root included. Result: conv_id
    (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows with a null conv_id belong to no conversation; repeated rows are turns of their own; other columns
    are ignored; no rows give no nodes. Turns are the same where 120 bits of their MD5 are, prefixes where
    their two 64-bit digests are.
    """
    spark = conversations.sparkSession
    ship_package(spark)
    rows = materialise(_prefixes(_turns(conversations)), "trie-prefixes")
    cells = LEAST_CELLS
    n = rows.count()
    while cells < min(8 * n, most_cells):
        cells *= 2
    bits = spark.sparkContext.broadcast(sketch(rows, cells))
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", shared boolean, above boolean"
    rows = materialise(rows.mapInArrow(_screen(bits, cells), schema), "trie-screened")

    # a proven single prefix is a node with one member, and so is all below it
    none = F.sha2(F.lit("").cast("binary"), 256)
    alone = rows.where("NOT shared")
    maybe = rows.where("shared")

    # exact counts of the others: (node, run) first, then node
    there = maybe.groupBy(*NODE, "run").agg(F.count("*").alias("n"), F.min("conv").alias("conv_id"), F.first("q1").alias("q1"), F.first("q2").alias("q2"))
    nodes = there.groupBy(*NODE).agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("q1").alias("q1"), F.first("q2").alias("q2"))
    nodes = materialise(nodes, "trie-shared")
    child = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = nodes.where("depth > 0").select(*child).unionByName(alone.where("above").select(*child)).groupBy(*NODE).agg(
        F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")

    # what a conversation shares with smaller ones, and whether it stands for the leaf it ends at
    known = materialise(spread_join(maybe.drop("q1", "q2", "shared", "above"), NODE, nodes.select(*NODE, "conv_id", "n_children"), "run"), "trie-known")
    leaf = (F.col("depth") == F.col("last")) & (F.col("n_children") == 0) & (F.col("conv_id") == F.col("conv"))
    own = known.select("conv", F.when(F.col("conv_id") != F.col("conv"), F.col("words")).otherwise(0).alias("copied"), leaf.cast("int").alias("leaf"))
    own = own.unionByName(alone.where("depth = last").select("conv", F.lit(0).cast("long").alias("copied"), F.lit(1).alias("leaf")))
    own = own.groupBy("conv").agg(F.sum("copied").alias("copied"), F.max("leaf").alias("leaf"))
    sums = spread_join(known.select(*NODE, "conv", "before", "run"), ["conv"], own, "run").groupBy(*NODE).agg(
        F.sum(F.greatest(F.col("copied") - F.col("before"), F.lit(0))).alias("saved_tokens"), F.sum("leaf").cast("long").alias("n_leaves"))

    # parents; one without a row in ``nodes`` is a proven single of the same conversation
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    inner = nodes.where("depth > 0").withColumn("run", F.pmod(F.xxhash64("p1", "p2"), F.lit(parts)))
    parents = spread_join(inner.select(*NODE, "q1", "q2", "run"), PARENT, up, "run").select(*NODE, "parent")
    shared = nodes.join(parents, NODE, "left").join(sums, NODE).join(
        _end_digests(maybe.where("depth = last")), NODE, "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))

    one = F.lit(1).cast("long")
    tail = [F.col("conv").alias("conv_id"), "depth"]
    ends = F.col("depth") == F.col("last")
    rest = [one.alias("n_convs"), F.when(ends, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(ends, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(none).alias("ends_sha256")]
    top = spread_join(alone.where("above"), PARENT, up, "run").select(*tail, F.col("parent").alias("parent_conv_id"), *rest)
    below = alone.where("NOT above").select(*tail, F.when(F.col("depth") > 0, F.col("conv")).alias("parent_conv_id"), *rest)
    return shared.unionByName(top).unionByName(below)


def op13_conversation_trie(conversations: DataFrame) -> DataFrame:
    return prefix_trie(conversations)


OP13_SQL = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c FROM turns),
convs AS (SELECT c, c - c % 20 AS base, {crc32_sql("CAST(c AS VARCHAR)")} % 4 AS h FROM ids),
parts AS (
  SELECT v.c, 0 AS own, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.pos <= v.h
  UNION ALL SELECT v.c, 1, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h),
steps AS (
  SELECT c, row_number() OVER w AS d, md5(length(role) || ':' || role || text) AS sign,
         len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS words
  FROM parts WINDOW w AS (PARTITION BY c ORDER BY own, pos)),
prefixes AS (
  SELECT c, d, words, list(sign) OVER (PARTITION BY c ORDER BY d) AS path FROM steps
  UNION ALL SELECT c, 0, 0, [] FROM ids),
keyed AS (SELECT c, d, words, md5(array_to_string(path, ',')) AS key, CASE WHEN d > 0 THEN md5(array_to_string(path[1:d - 1], ',')) END AS up FROM prefixes),
ends AS (SELECT c, max(d) AS d FROM keyed GROUP BY c),
grouped AS (
  SELECT d, key, any_value(up) AS up, any_value(words) AS words, min(c) AS conv_id, count(*) AS n_convs FROM keyed GROUP BY d, key),
ended AS (
  SELECT k.d, k.key, sha256(string_agg(CAST(k.c AS VARCHAR), ',' ORDER BY k.c)) AS sha FROM keyed k JOIN ends e ON e.c = k.c AND e.d = k.d GROUP BY k.d, k.key),
children AS (SELECT d - 1 AS d, up AS key, count(*) AS n FROM grouped WHERE d > 0 GROUP BY ALL),
nodes AS (
  SELECT g.*, coalesce(ch.n, 0) AS n_children, coalesce(e.sha, sha256('')) AS ends_sha256
  FROM grouped g LEFT JOIN children ch ON ch.d = g.d AND ch.key = g.key LEFT JOIN ended e ON e.d = g.d AND e.key = g.key),
-- every node adds to the nodes on its least member's path
subtree AS (
  SELECT k.d, k.key, sum((n.n_children = 0)::INT) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
  FROM nodes n JOIN keyed k ON k.c = n.conv_id AND k.d <= n.d GROUP BY k.d, k.key)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtree s ON s.d = n.d AND s.key = n.key LEFT JOIN nodes p ON p.d = n.d - 1 AND p.key = n.up"""
