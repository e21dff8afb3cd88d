"""Shards that each hold the corpus's mixture of sources: proportional stratified interleaving.

DataFrame functions only. Ranks come from range partitions and the row counts of (partition,
source) groups, never from a window over a whole source, so a source with a third of all rows is
ranked by as many tasks as its rows fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise


def _partition() -> Column:
    return F.shiftright("at", 33)


def _numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, stored with ``at`` = partition << 33 | row."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return materialise(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), name)


def _ranked(df: DataFrame, by: list[str], rank: str, count: str) -> DataFrame:
    """Add the rank (from 0) of each row of ``_numbered`` output within ``by``, and the group's row count.

    The joined table has a row for each (partition, group) present: at most partitions + groups.
    """
    runs = df.groupBy(_partition().alias("run"), *by).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy(*by)
    before = group.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("run").alias("run"), *(F.col(c).alias(f"run_{c}") for c in by), "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(group).alias(count))
    match = _partition() == F.col("run")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"run_{c}"))
    return df.join(runs, match).withColumn(rank, F.col("at") - F.col("first") + F.col("before")).drop(
        "run", "first", "before", *(f"run_{c}" for c in by))


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot) of every row.

    Rows are ordered within their source by a seeded hash of doc_id, all rows by
    (rank + 1/2) / rows of the source, and that order is cut into ``shards`` runs whose row
    counts differ by at most one; ``slot`` counts from 0 in each. A null source is a source of its
    own, a null text has size 1 and the checksum of no bytes, a null doc_id is hashed as an empty
    string; equal rows are interchangeable. Other columns are ignored; no rows give none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = materialise(
        rows.withColumn("draw", F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "shard-rows")
    tie = ["draw", "doc_id", "text_crc32", "size"]
    strata = _ranked(_numbered(rows, ["source", *tie], "shard-strata"), ["source"], "rank", "in_source").drop("at")
    strata = strata.withColumn("fraction", (F.col("rank") + 0.5) / F.col("in_source"))
    line = _numbered(strata.drop("rank", "in_source"), ["fraction", *tie, "source"], "shard-line")
    line = _ranked(line, [], "place", "in_all")
    # shard s begins at the least place p with p * shards >= s * rows
    return line.withColumn("shard", _div(F.col("place") * shards, "in_all")).withColumn(
        "slot", F.col("place") - _div(F.col("shard") * F.col("in_all") + (shards - 1), F.lit(shards))).select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))


def _div(a, b):
    """Exact integer quotient of longs."""
    return F.call_function("div", a, F.col(b) if isinstance(b, str) else b)


def op9_sharding(docs: DataFrame, shards: int = 16) -> DataFrame:
    return interleaved_shards(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
