"""Equi-joins in which one key may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks that share a hot key.
SALTS = 64


def spread_join(rows: DataFrame, keys: list[str], table: DataFrame, by: str, salts: int = SALTS) -> DataFrame:
    """``rows`` joined with ``table`` (one row a key) on ``keys``; rows without a partner are dropped.

    The table is first dealt to the (key, salt) pairs that ``rows`` has, the salt being a hash of ``by``, so
    a key's rows are joined by up to ``salts`` tasks and a key of the table is shipped at most as often.
    Keys must not be null.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    there = salted.select(*keys, "_salt").distinct().join(table, keys)
    return salted.join(there, [*keys, "_salt"]).drop("_salt")
