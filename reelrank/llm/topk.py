"""Exact top-k inner products: a KD-tree per shard, searched best first.

Each shard's tree splits at the median of its widest dimension and keeps the tight bounding box of
every node, and its ball: centre and largest distance from it. The inner product of a query with any
vector in a box is at most sum(max(q*lo, q*hi)) over the dimensions, in a ball at most
q*centre + |q|*radius; nodes are visited by the lesser bound, and a search ends
when the best bound left is below the query's kth score.

Shards lie in space: median splits of a bounded sample make cells, every row goes to its cell, and a
cell is dealt to shards by hash. A query first searches the shard it lies in; with the kth score found
there it goes on to the cells whose ball reaches that score, and a vector is shipped only to the blocks of
queries that reach its cell.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import ship_package

from .common import materialise

SHARD_ROWS = 4096
QUERY_ROWS = 4096
LEAF = 64
#: Cells at most, and sampled rows for each of them (expected) that the splits are fitted on.
CELLS, SAMPLED = 512, 32
#: Products of components below this are summed exactly by doubles up to 2^21 dimensions.
EXACT = 1 << 16

FOUND = "query_id long, vec_id long, score long"


def ball_bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """(query x ball) no less than any inner product of the query with a vector in the ball."""
    q = queries.astype(np.float64)
    size = np.sqrt((q * q).sum(axis=1))[:, None]
    far = np.sqrt((centres * centres).sum(axis=1)) + radii
    return q @ centres.T + size * radii + 1e-9 * size * far + 1


class Cells:
    """Median splits of sampled rows along the dimension of greatest variance; leaves are numbered so that
    neighbours in the tree are neighbours in number, and keep their sample's mean."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.centres: list[np.ndarray] = []
        self.root = self._grow(sample, cells)
        self.centres = np.array(self.centres)

    def _grow(self, part: np.ndarray, cells: int):
        if cells > 1 and len(part) > 1 and part.shape[1] and (part != part[0]).any():
            along = int(part.var(axis=0).argmax())
            x = part[:, along]
            cut = np.partition(x, len(x) // 2)[len(x) // 2]
            cut += int(not (x < cut).any())
            return along, cut, self._grow(part[x < cut], cells - cells // 2), self._grow(part[x >= cut], cells // 2)
        self.centres.append(part.mean(axis=0) if len(part) else np.zeros(part.shape[1]))
        return len(self.centres) - 1

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        out = np.zeros(len(vectors), np.int32)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if isinstance(node, tuple):
                along, cut, left, right = node
                low = vectors[rows, along] < cut
                todo += [(left, rows[low]), (right, rows[~low])]
            else:
                out[rows] = node
        return out


class Tree:
    """KD-tree over the rows of ``vectors`` (int64), rows in each leaf ordered by id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.lo, self.hi, self.children, self.rows = [], [], [], []
        self.centre, self.radius = [], []
        self.ids, self.vectors = ids, vectors
        self._leaf = leaf
        todo = [(np.argsort(ids, kind="stable"), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            node, part = len(self.lo), vectors[rows]
            lo, hi = part.min(axis=0), part.max(axis=0)
            self.lo.append(lo)
            self.hi.append(hi)
            self.centre.append(part.mean(axis=0))
            self.radius.append(np.sqrt(((part - self.centre[-1]) ** 2).sum(axis=1)).max())
            self.children.append([-1, -1])
            self.rows.append(None)
            if parent >= 0:
                self.children[parent][side] = node
            spread = hi.astype(np.float64) - lo
            if len(rows) <= leaf or not spread.size or not spread.max() > 0:
                self.rows[node] = rows
                continue
            x = part[:, int(spread.argmax())]
            median = np.partition(x, len(x) // 2)[len(x) // 2]
            left = x < median if (x < median).any() else x <= median
            todo += [(rows[left], node, 0), (rows[~left], node, 1)]
        self.lo, self.hi = np.array(self.lo, np.float64), np.array(self.hi, np.float64)
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(query x node) lesser of the box and ball bounds, rounded up where doubles are not exact."""
        q = queries.astype(np.float64)
        b = np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T
        size = max(np.abs(self.lo).max(initial=0), np.abs(self.hi).max(initial=0), np.abs(q).max(initial=0))
        if size >= EXACT:
            b += 1e-9 * (np.abs(q) @ np.maximum(np.abs(self.lo), np.abs(self.hi)).T) + 1
        return np.minimum(b, ball_bounds(q, self.centre, self.radius))

    def search(self, query: np.ndarray, own: int, k: int, least: float, bound: np.ndarray) -> list[tuple[int, int]]:
        """The k best (score, vec_id), ties to the smaller id, among those of at least ``least``."""
        best: list[tuple[int, int]] = []  # (score, -id): a heap whose top is the worst kept
        heap = [(-bound[0], 0)]
        while heap:
            b, node = heapq.heappop(heap)
            if -b < least:
                break
            rows = self.rows[node]
            if rows is None:
                for c in self.children[node]:
                    heapq.heappush(heap, (-bound[c], c))
                continue
            scores = self.vectors[rows] @ query
            if len(scores) > k:  # ties of the kth included; the smaller ids win below
                keep = np.flatnonzero(scores >= max(least, np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]))
                keep = keep[np.lexsort((self.ids[rows[keep]], -scores[keep]))][:k + 1]
            else:
                keep = np.flatnonzero(scores >= least)
            for j in keep:
                vec_id = int(self.ids[rows[j]])
                if vec_id == own:
                    continue
                item = (int(scores[j]), -vec_id)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(s, -i) for s, i in best]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _search(base: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Search one shard for a block of queries (query_id, v, least: null if none is known yet)."""
    if base.empty or queries.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
    width = max(map(len, [*base.v, *queries.v]))
    tree = Tree(base.vec_id.to_numpy(), _matrix(base.v, width))
    q = _matrix(queries.v, width)
    bounds = tree.bounds(q)
    rows = []
    for i, (query_id, least) in enumerate(zip(queries.query_id, queries.least)):
        least = -np.inf if pd.isna(least) else least
        rows += [(query_id, v, s) for s, v in tree.search(q[i], query_id, k, least, bounds[i])]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(np.int64)


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v) with v = floor(scale * component) as longs; unusable rows are left out."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _placed(cells, width: int):
    """(vec_id, v) -> the same with the cell and the distance from its centre."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch.v, width)
            cell = cells.value.place(x)
            yield batch.assign(cell=cell, away=np.sqrt(((x - cells.value.centres[cell]) ** 2).sum(axis=1)))
    return run


def _reaching(cells, radii: dict[int, float], width: int):
    """Queries -> the same with the cells that can hold a score of at least ``least`` (null: any)."""
    names = np.array(sorted(radii), np.int32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, radius = cells.value.centres[names], np.array([radii[c] for c in names])
        for batch in batches:
            least = batch.least.to_numpy(np.float64, na_value=-np.inf)
            least[np.isnan(least)] = -np.inf
            bounds = ball_bounds(_matrix(batch.q, width), centres, radius)
            yield batch.assign(cells=[names[b >= x].tolist() for b, x in zip(bounds, least)])
    return run


def top_products(embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = 256,
                 shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, shipped: list | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products, exactly.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows with
    another vec_id; ties go to the smaller vec_id. Vectors that are null or hold a null or
    non-finite component, and rows without a vec_id, take no part; shorter vectors count as padded
    with zeros. A query with fewer than k candidates gets them all. Repeated rows are candidates
    (and queries) once. Other columns are ignored, an empty table gives no rows.
    Components must stay below 2^28 after scaling for scores to fit a long.

    There are at most ``CELLS`` cells, split on about ``SAMPLED`` rows each; the rows of a cell, however
    many are equal, are dealt to shards of about ``shard_rows`` rows. Queries of neighbouring cells form
    blocks of about ``query_rows``; each (shard, block) that a query reaches is one group. ``shipped``
    gets (queries sent to cells, queries x cells), which costs another pass.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    vectors = materialise(quantised(embeddings, scale).dropDuplicates(), "topk-vectors")
    rows, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    width = width or 0
    wanted = min(CELLS, max(1, -(-rows // shard_rows)))
    share = min(1.0, SAMPLED * wanted / max(rows, 1))
    drawn = vectors.where(F.pmod(F.xxhash64(F.lit("cells"), "vec_id", "v"), F.lit(1 << 40)) < int(share * (1 << 40))).select("v").toPandas()
    cells = spark.sparkContext.broadcast(Cells(_matrix(drawn.v, width), wanted))
    placed = materialise(vectors.mapInPandas(_placed(cells, width), "vec_id long, v array<long>, cell int, away double"), "topk-cells")
    asks = (F.col("vec_id") % every == 0).cast("long")
    known = sorted(placed.groupBy("cell").agg(F.count("*"), F.sum(asks), F.max("away")).collect())

    plan, block, held = [], 0, 0  # blocks run over neighbouring cells; a cell of many queries has its own
    for cell, n, queries, _ in known:
        if held and held + queries > query_rows:
            block, held = block + 1, 0
        blocks = max(1, -(-queries // query_rows))
        plan.append((cell, -(-n // shard_rows), block, blocks))
        block, held = (block + blocks, 0) if blocks > 1 else (block, held + queries)
    # one row a cell
    plan = F.broadcast(spark.createDataFrame(plan, "cell int, shards int, first int, blocks int"))
    shards = plan.select("cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    placed = placed.join(plan, "cell").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))

    def home(base: pd.DataFrame) -> pd.DataFrame:
        own = base[base.vec_id % every == 0]
        return _search(base, pd.DataFrame({"query_id": own.vec_id, "v": own.v, "least": np.nan}), k)

    def away(base: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return _search(base, queries.rename(columns={"q": "v"}), k)

    base = placed.select("cell", "shard", "vec_id", "v")
    at_home = materialise(base.groupBy("cell", "shard").applyInPandas(home, FOUND), "topk-home")
    kth = at_home.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).select(
        "query_id", F.when(F.col("n") >= k, F.col("least")).cast("double").alias("least"))
    queries = placed.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("cell").alias("home"), F.col("shard").alias("part"),
        (F.col("first") + F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("blocks"))).cast("int").alias("block")).join(kth, "query_id", "left")
    radii = {cell: radius for cell, _, _, radius in known}
    queries = materialise(queries.mapInPandas(_reaching(cells, radii, width), (
        "query_id long, q array<long>, home int, part int, block int, least double, cells array<int>")), "topk-queries")
    if shipped is not None:
        shipped.append(queries.agg(F.sum(F.size("cells")), F.count("*") * len(known)).first())
    sent = queries.withColumn("cell", F.explode("cells")).join(F.broadcast(plan.select("cell", "shards")), "cell").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where("cell <> home OR shard <> part").select(
        "cell", "shard", "block", "query_id", "q", "least")
    reached = queries.select(F.col("block").alias("block"), F.explode("cells").alias("cell")).distinct().join(shards, "cell")
    elsewhere = base.join(reached, ["cell", "shard"]).groupBy("cell", "shard", "block").cogroup(
        sent.groupBy("cell", "shard", "block")).applyInPandas(away, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return at_home.unionByName(elsewhere).withColumn("rank", F.row_number().over(order).cast("int")).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_exact_topk(embeddings: DataFrame) -> DataFrame:
    return top_products(embeddings)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
