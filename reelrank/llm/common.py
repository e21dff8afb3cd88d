"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.session import shared_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id: long, text: string) of ``docs``, whose session can then run this package's Python."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def slices(batch: pa.RecordBatch, column: int, rows: int = 256, size: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most ``rows`` rows and about ``size`` bytes in ``column`` (one row at
    least), so that what a task holds besides the batch does not depend on the length of texts."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, side="right"))))
        yield batch.slice(at, end - at)
        at = end


def freeing(run: Callable) -> Callable:
    """An Arrow map ``run`` that hands unused memory back to the system when its task ends. Workers are reused, and
    the stages of a pipeline would otherwise each leave their peak behind."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return task


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not the Python work before it.
    """
    path = shared_path(df.sparkSession, f"llm/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def draw_least(df: DataFrame, n: int, group: str, keys: list[str], seed: int) -> DataFrame:
    """The ``n`` rows of each ``group`` with the least seeded hash of ``keys`` (ties: least keys).

    Rows are counted by group and the hash's first 12 bits; of a group only the rows up to the part in
    which the nth lies are ranked, about ``n`` and a 4,096th of the group.
    """
    marked = df.withColumn("_hash", F.xxhash64(F.lit(seed), *keys)).withColumn("_part", F.shiftright("_hash", 52))
    parts = marked.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    last = materialise(parts.where(F.col("_before") < n).groupBy(group).agg(F.max("_part").alias("_last")), "draw-parts")
    # one row a group
    few = marked.join(F.broadcast(last) if last.count() <= 100_000 else last, group).where("_part <= _last")
    rank = Window.partitionBy(group).orderBy("_hash", *keys)
    return few.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= n).drop("_hash", "_part", "_last", "_n")


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the component's least node.

    Alternating large-star and small-star rounds: each replaces links by links to the least
    neighbour, so the edge list never grows beyond its first size and the number of rounds is
    about the logarithm of the longest chain. Nothing but a count and a checksum of the links
    comes to the driver. Self loops and null ends are ignored.
    """
    a, b = F.col("a"), F.col("b")
    e = materialise(
        edges.where("a <> b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), name)
    state = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        both = e.unionByName(e.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(b.alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialise(large, name)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(b.alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).distinct()
        e = materialise(small, name)
    return e.select(a.alias("node"), b.alias("root")).unionByName(
        e.select(b.alias("node"), b.alias("root")).distinct())


def spread_join(rows: DataFrame, keys: list[str], table: DataFrame, salt: str) -> DataFrame:
    """``rows`` joined with ``table``, which has one row a key, on ``keys``, where one key may hold a third of ``rows``.

    The table is first dealt to the (key, salt) pairs that ``rows`` has, so a key's rows are joined by
    as many tasks as it has salts, and a key of ``table`` is shipped once a salt. Rows without a
    partner are dropped; keys must not be null.
    """
    there = rows.select(*keys, salt).distinct().join(table, keys)
    return rows.join(there, [*keys, salt])
