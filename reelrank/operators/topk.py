"""Generic top-k per key, and nesting / flattening of ranked lists.

``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before the shuffle, so each
map task forwards at most k rows per key: a key holding a third of all rows still ships only
k rows per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int | None = None,
                rank_col: str = "rank") -> DataFrame:
    """Add a 1-based dense position per key ordered by ``order``; keep ranks <= k if given."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        out = out.where(F.col(rank_col) <= k)
    return out


def nest(df: DataFrame, keys: Sequence[str], fields: Sequence[str], rank_col: str = "rank",
         out_col: str = "recs") -> DataFrame:
    """(key, rank, fields…) rows → (key, array<struct<fields>>) ordered by rank.

    Only for lists bounded by a top-k; unbounded neighbour lists stay in long form.
    """
    collected = df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("_r"), *fields))).alias("_l"))
    return collected.select(
        *keys,
        F.transform("_l", lambda s: F.struct(*[s[f].alias(f) for f in fields])).alias(out_col))


def flatten(df: DataFrame, keys: Sequence[str], recs_col: str = "recs",
            rank_col: str = "rank") -> DataFrame:
    """(key, array<struct>) → (key, rank, struct fields…); empty arrays give no rows."""
    exploded = df.select(*keys, F.posexplode(recs_col).alias("_pos", "_rec"))
    return exploded.select(*keys, (F.col("_pos") + 1).cast("int").alias(rank_col), "_rec.*")
