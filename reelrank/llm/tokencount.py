"""Token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import path_exists, shared_path

from . import bpe
from .common import freeing, slices, spread_join, texts

#: Tasks that share the rows of one text.
SALTS = 64
CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def _count(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(path)
        for batch in batches:
            for part in slices(batch, 1):
                n = [len(x) // 4 for x in enc.ids_bytes(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(n, np.int64))], ["digest", "n_tokens"])
        enc.trim()
    return run


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text, digest): null texts become empty; digest is the SHA-256 of the UTF-8 bytes.

    The content is normalised no further, as case, white space and composition change the count.
    """
    return texts(docs).withColumn("text", F.coalesce("text", F.lit(""))).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))


def token_counts(docs: DataFrame, cache_path: str, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, from the Parquet cache at ``cache_path``.

    The cache holds (digest, tokenizer, n_tokens), where tokenizer is the digest of the vocabulary
    file and library version. Only distinct texts the cache lacks are encoded, once each, and
    appended; copies meet in the partial aggregate of their own input partition before they are
    shuffled. Null and empty texts have 0 tokens. Repeated rows come back as often as they are
    there, a null doc_id stays null, other columns are ignored, an empty table gives no rows.
    Two runs that append the same text at once leave it twice; reading takes one.
    """
    spark = docs.sparkSession
    version = bpe.version(tokenizer_path)
    seen = digests(docs)

    def cached() -> DataFrame:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version)

    misses = seen
    if path_exists(spark, cache_path):
        misses = misses.join(cached().select("digest").distinct(), "digest", "left_anti")
    misses = misses.groupBy("digest").agg(F.first("text").alias("text"))
    misses.select("digest", "text").mapInArrow(freeing(_count(tokenizer_path)), "digest binary, n_tokens long").select(
        "digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    counts = cached().groupBy("digest").agg(F.first("n_tokens").alias("n_tokens"))
    # copies of one text may be a third of all rows
    rows = seen.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return spread_join(rows, ["digest"], counts, "salt").select("doc_id", "n_bytes", "n_tokens")


def op8_token_counts(docs: DataFrame, limit: int = 512) -> DataFrame:
    """Counts of ``docs`` with a cache of this call's own, so that every distinct text is encoded here."""
    cache = shared_path(docs.sparkSession, "llm/token-cache")
    return token_counts(docs, cache).withColumn("over_limit", F.col("n_tokens") > limit)
