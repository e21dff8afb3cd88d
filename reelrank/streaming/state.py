"""S7 kept by the stream itself: each user's most recent ratings.

A micro-batch keeps the newest k of its own rows a user (limited on the map side, so a user with a
third of the stream ships k rows per input partition), reads the stored lists of its users from their
buckets, ranks both together and upserts the newest k. What a batch reads follows the batch, not the
number of users. A replayed batch starts from the lists before it, so it writes the same rows again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import RECENT_K, STREAM_INTERVAL
from ..operators.topk import flatten, nest, rank_within
from ..sources.loaders import parse_rating_messages
from ..sources.tables import KeyedStore

_FIELDS = ["mid", "score", "ts", "event_id"]
RECENT_SCHEMA = "uid int, recs array<struct<mid:int,score:double,ts:long,event_id:long>>"


def recent_store(spark: SparkSession, path: str, buckets: int = 64) -> KeyedStore:
    """The store of the recent ratings; a later batch's list replaces an earlier one."""
    return KeyedStore(spark, path, order=("batch_id",), schema=RECENT_SCHEMA, buckets=buckets)


def _newest(rows: DataFrame, k: int) -> DataFrame:
    return rank_within(rows, ["uid"], [F.desc("ts"), F.desc("event_id")], k, rank_col="pos")


def merge_recent(batch: DataFrame, stored: DataFrame | None, k: int = RECENT_K) -> DataFrame:
    """(uid, recs[{mid, score, ts, event_id}]): the newest k of the batch's users, stored ones included."""
    rows = batch.select("uid", *_FIELDS)
    if stored is not None:
        mine = stored.join(rows.select("uid").distinct(), "uid", "left_semi")
        rows = rows.unionByName(mine.select("uid", F.inline("recs")).select("uid", *_FIELDS)).dropDuplicates(["uid", "event_id"])
    return nest(_newest(rows, k), ["uid"], _FIELDS, rank_col="pos")


def start_recent_stream(messages: DataFrame, store: KeyedStore, checkpoint_location: str,
                        k: int = RECENT_K, available_now: bool = False,
                        interval: str = STREAM_INTERVAL, compact_every: int = 500) -> StreamingQuery:
    """Keep the recent-ratings table (``recent_store``) current from the rating stream."""
    def body(df: DataFrame, batch_id: int) -> None:
        rows = _newest(df.select("uid", *_FIELDS), k).drop("pos").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = store.current(upto_batch=batch_id - 1, keys=rows)
            store.upsert(merge_recent(rows, before.select("uid", "recs"), k), batch_id)
        finally:
            rows.unpersist()
        if batch_id and batch_id % compact_every == 0:
            store.compact(batch_id - 1)

    writer = parse_rating_messages(messages).writeStream.foreachBatch(body) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def recent_table(store: KeyedStore) -> DataFrame:
    """The stored lists in long form (uid, pos, mid, score)."""
    return flatten(store.current().select("uid", "recs"), ["uid"], rank_col="pos").select("uid", "pos", "mid", "score")
