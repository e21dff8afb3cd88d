"""Sequence packing: best fit within partitions, then tree-merged rounds over underfull bins."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import ship_package

from . import bpe
from .common import freeing, materialise, slices, texts

END = 2
#: Items that one best-fit call packs at once; a task's input is taken in chunks of this many.
CHUNK = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones at the end, a shorter one, if any, first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def _pieces(capacity: int, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = bpe.encoder(path), np.array([END], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), enc.ids_bytes(part.column(1).to_pylist())):
                    ids += end
                    for i, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((doc_id, i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])
        enc.trim()
    return run


def pieces(docs: DataFrame, capacity: int = 1024, tokenizer_path: str | None = None) -> DataFrame:
    """Token pieces of every document: its ids and an end id, cut if longer than ``capacity``."""
    return texts(docs).withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(
        freeing(_pieces(capacity, tokenizer_path)), PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit, longest item first: bin number and offset in the bin of each item."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_at: dict[int, list[int]] = {}  # residual capacity -> bins
    residuals: list[int] = []
    n = 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        j = bisect_left(residuals, need)
        if j < len(residuals):
            room = residuals[j]
            b = open_at[room].pop()
            if not open_at[room]:
                residuals.pop(j)
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        if room := room - need:
            if not open_at.setdefault(room, []):
                insort(residuals, room)
            open_at[room].append(b)
    return bins, offsets


def _pack(capacity: int, level: int):
    """(item, length) -> (item, bin, offset, total); a bin number names its round, task, chunk and place."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, chunk, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pd.DataFrame:
            nonlocal chunk
            df = pd.concat(held).sort_values(["length", "item"], ascending=[False, True], ignore_index=True)
            bins, offsets = best_fit(df.length.to_numpy(), capacity)
            totals = np.bincount(bins, df.length.to_numpy()).astype(np.int64)
            base = (level << 58) | (task << 36) | (chunk << 22)
            chunk += 1
            return pd.DataFrame({"item": df.item, "bin": bins + base, "offset": offsets, "total": totals[bins]})

        for df in frames:
            for at in range(0, len(df), CHUNK):
                held.append(df[at:at + CHUNK])
                rows += len(held[-1])
                if rows >= CHUNK:
                    yield flush()
                    held, rows = [], 0
        if rows:
            yield flush()
    return run


PACKED = "item long, bin long, offset long, total long"


def going_on(bins: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of the ``bins`` (total -> number) go on to the next round.

    All of at most half the capacity, and of the fuller ones, fullest first, as many as can be given one of
    those to themselves, the largest that fits. What is left over could only meet bins it does not fit with.
    """
    on = {t: n for t, n in bins.items() if 2 * t <= capacity}
    free, small = dict(on), sorted(on)
    for total in sorted((t for t in bins if 2 * t > capacity), reverse=True):
        left = bins[total]
        while left:
            j = bisect_right(small, capacity - total) - 1
            if j < 0:
                break
            n = min(left, free[small[j]])
            on[total], left = on.get(total, 0) + n, left - n
            free[small[j]] -= n
            if not free[small[j]]:
                small.pop(j)
    return on


def pack(items: DataFrame, capacity: int = 1024, full: float = 0.99) -> DataFrame:
    """(item, sequence_id, offset) for ``items`` (item: unique long, length: 1 to capacity).

    Every partition packs its items best-fit. Bins filled to ``full`` of the capacity are emitted. Of the
    others, those that can find a partner (``going_on``, of each total a share drawn by hash) become items
    of the next round, which merges as many partitions as give a task ``CHUNK`` of them, until a round has
    run over a single chunk or leaves nine tenths of its items. Best-fit calls take at most ``CHUNK`` items,
    so a task holds a bounded number however many bins stay underfull.
    """
    ship_package(items.sparkSession)
    tasks = items.rdd.getNumPartitions()
    rounds = [materialise(items.select("item", "length").mapInPandas(_pack(capacity, 1), PACKED), "pack-1")]
    rows = rounds[0].count()
    while tasks > 1 or rows > CHUNK:
        under = rounds[-1].where(F.col("total") < capacity * full).groupBy(F.col("bin").alias("item")).agg(
            F.first("total").alias("length"))
        # one row for each total, at most the capacity
        bins = {r.length: r["count"] for r in under.groupBy("length").count().collect()}
        on = going_on(bins, capacity)
        left, before = sum(on.values()), rows
        after = -(-left // CHUNK)
        if left < 2 or (after >= tasks and left > 0.9 * before):
            break
        share = F.broadcast(items.sparkSession.createDataFrame(
            [(t, -(-(n << 30) // bins[t])) for t, n in on.items()], "length long, share long"))
        drawn = under.join(share, "length").where(F.pmod(F.xxhash64("item"), F.lit(1 << 30)) < F.col("share"))
        tasks, rows, level = after, left, len(rounds) + 1
        rounds.append(materialise(
            drawn.select("item", "length").coalesce(tasks).mapInPandas(_pack(capacity, level), PACKED), f"pack-{level}"))
    # from the last round to the first: where each bin that went on has come to lie
    place = rounds[-1].select("item", F.col("bin").alias("sequence_id"), "offset")
    for packed in reversed(rounds[:-1]):
        onward = place.select(F.col("item").alias("bin"), "sequence_id", F.col("offset").alias("moved"))
        place = packed.join(onward, "bin", "left").select(
            "item", F.coalesce("sequence_id", "bin").alias("sequence_id"),
            (F.col("offset") + F.coalesce("moved", F.lit(0))).alias("offset"))
    return place


def pack_documents(docs: DataFrame, capacity: int = 1024, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``docs``.

    A null or empty text is the end id alone. Repeated rows and null doc_ids are packed like any
    other row, other columns are ignored, and an empty table gives no rows. Sequence numbers are
    arbitrary; the offsets in a sequence have no gaps.
    """
    kept = materialise(
        pieces(docs, capacity, tokenizer_path).withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    return kept.join(pack(kept, capacity), "item").drop("item")


def op6_best_fit_packing(docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
