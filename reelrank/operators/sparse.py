"""Exact cosine join of sparse vectors by inverted lists over dimensions (J4 "join on dimension", M11).

Dimensions are ordered by how many vectors have them, rare ones first. If two unit vectors have a dot
product of at least t, the first dimension they share lies, in each of them, where the rest from there on
still has a norm of t or more: otherwise everything they share would be too short. So only this prefix of
each vector goes into the inverted lists, which keeps the long lists of common dimensions nearly empty.
Candidates that meet in a list are verified with their whole vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored
from .spread import spread_join

_SLACK = 1e-9


def sparse_long(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(sid, dim, w) of the non-zero entries of an ML vector column, without making it dense."""
    raw = vectors.select(F.col(id_col).alias("sid"), F.unwrap_udt(vec_col).alias("_v"))
    dims = F.when(F.col("_v.type") == 0, F.col("_v.indices")).otherwise(F.sequence(F.lit(0), F.size("_v.values") - 1))
    entries = raw.where(F.size("_v.values") > 0).select("sid", F.inline(F.arrays_zip(dims.alias("dim"), F.col("_v.values").alias("w"))))
    return entries.toDF("sid", "dim", "w").where("w <> 0")


def _dot(a: Column, b: Column) -> Column:
    """Dot product of two arrays of (dim, w), through a map of the second."""
    other = F.map_from_entries(b)
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x["w"] * F.coalesce(F.try_element_at(other, x["dim"]), F.lit(0.0)))


def sparse_cosine_pairs(entries: DataFrame, threshold: float, block_rows: int = 4096) -> DataFrame:
    """(sid, sid2, sim): all ordered pairs of different vectors with cosine > ``threshold`` > 0.

    ``entries`` (sid, dim, w) holds each vector's non-zero entries, each dimension once. A list of a
    dimension longer than ``block_rows`` is cut into blocks that meet pair by pair, so neither a hot
    dimension nor a vector with very many partners fills a task.
    """
    if threshold <= 0:
        raise ValueError("vectors that share no dimension are similar at such a threshold")
    rows = stored(entries.select("sid", "dim", F.col("w").cast("double").alias("w")), "sparse-entries")
    norms = rows.groupBy("sid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    counts = rows.groupBy("dim").agg(F.count("*").alias("df"))
    unit = spread_join(rows.join(norms, "sid"), ["dim"], counts, "sid").select("sid", "dim", (F.col("w") / F.col("norm")).alias("w"), "df")
    rest = Window.partitionBy("sid").orderBy("df", "dim").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    unit = stored(unit.withColumn("rest", F.sqrt(F.sum(F.col("w") * F.col("w")).over(rest))), "sparse-unit")
    # the inverted lists, long ones in blocks
    lists = unit.where(F.col("rest") >= threshold - _SLACK).select("sid", "dim")
    sizes = lists.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks"))
    lists = stored(spread_join(lists, ["dim"], sizes, "sid").withColumn(
        "block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")), "sparse-lists")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = lists.select("sid", "dim", F.col("block").alias("lb"), every.alias("rb"))
    right = lists.select(F.col("sid").alias("sid2"), "dim", every.alias("lb"), F.col("block").alias("rb"))
    pairs = left.join(right, ["dim", "lb", "rb"]).where("sid < sid2").select("sid", "sid2").distinct()
    # verified with the whole vectors
    whole = unit.groupBy("sid").agg(F.collect_list(F.struct("dim", "w")).alias("v"))
    pairs = spread_join(pairs, ["sid"], whole, "sid2")
    pairs = spread_join(pairs, ["sid2"], whole.select(F.col("sid").alias("sid2"), F.col("v").alias("v2")), "sid")
    found = stored(pairs.select("sid", "sid2", _dot(F.col("v"), F.col("v2")).alias("sim")).where(F.col("sim") > threshold), "sparse-pairs")
    return found.unionByName(found.select(F.col("sid2").alias("sid"), F.col("sid").alias("sid2"), "sim"))
