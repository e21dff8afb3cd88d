"""Near-duplicate groups from SimHash fingerprints, matched through Golay-code keys.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. Two fingerprints that differ in
at most two bits agree on at least one whole segment (pigeonhole), and on the segment after it
they differ in at most two bits. A segment of up to 23 bits is a word of the perfect binary Golay
code: every word lies within three bits of one codeword, and a word three bits away has exactly
five more codewords at distance four. Two words at most two bits apart always share one of these
codewords (the codeword nearest to a point midway is within four bits of both). So the keys
(whole segment, index of a nearby codeword of the next segment), at most 18 a fingerprint, bring
every linked pair together; pairs that meet are verified by their bit distance.

Keys shared by more than ``bucket`` fingerprints take a route whose work grows linearly: each
fingerprint is filed under itself and its 64 one-bit neighbours. Two fingerprints at distance two
or less share such a point, and all under one point are linked, so one link each to the least of
them (at most 65 in a group) keeps the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, freeing, materialise, texts

SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the [23, 12] Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
BLOCK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of whole UTF-8 ``text``; 0 if it has no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1).cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    return texts(docs).mapInArrow(freeing(_fingerprints(shingle)), "doc_id long, fp long")


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each of the 23 bits, and for every syndrome the error patterns of weight <= 4.

    Rows have six patterns; short rows repeat their first.
    """
    def syndrome(v: int) -> int:
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= GENERATOR << (i - 11)
        return v

    bits = np.array([syndrome(1 << i) for i in range(23)], np.int64)
    rows: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            s = 0
            for p in places:
                s ^= int(bits[p])
            rows[s].append(sum(1 << p for p in places))
    errors = np.array([(r + r[:1] * 6)[:6] for r in rows], np.int64)
    return bits, errors


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """The six (repeats possible) 12-bit indices of the codewords within four bits of each word."""
    bits, errors = golay_tables()
    s = np.zeros(len(words), np.int64)
    for i in range(23):
        s ^= np.where(words >> i & 1, bits[i], 0)
    return (words[:, None] ^ errors[s]) >> 11


def golay_keys(fps: np.ndarray) -> np.ndarray:
    """Matrix (fingerprint x 18) of keys; repeats possible."""
    u = fps.astype(np.int64).view(np.uint64)
    seg = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    return np.concatenate(
        [(np.int64(i) << 34 | seg[i] << 12)[:, None] | codeword_indices(seg[(i + 1) % 3]) for i in range(3)], axis=1)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        keys = np.sort(golay_keys(fps), axis=1)
        new = np.ones(keys.shape, bool)
        new[:, 1:] = keys[:, 1:] != keys[:, :-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[new]), pa.array(np.repeat(fps, new.sum(axis=1)))], ["k", "fp"])


def _emit_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for batch in batches:
        fps = batch.column(0).to_numpy()
        points = (fps.view(np.uint64)[:, None] ^ flips).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(points.ravel()), pa.array(np.repeat(fps, 65))], ["k", "fp"])


def links(fps: DataFrame, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """Links (a > b) between the distinct fingerprints ``fps`` (fp) that join all within ``max_bits``.

    ``max_bits`` is 0, 1 or 2. Every pair in a bucket of at most ``bucket`` fingerprints is
    verified; in larger ones a pair may be joined through a third fingerprint linked to both.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("the keys find fingerprints at most two bits apart")
    keys = fps.mapInArrow(_emit_keys, "k long, fp long")
    shared = keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    met = materialise(keys.join(shared, "k"), "simhash-met")
    cold = met.where(F.col("n") <= bucket).select("k", "fp")
    near = cold.select("k", F.col("fp").alias("a")).join(cold.select("k", F.col("fp").alias("b")), "k").where(
        (F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")
    if max_bits == 2:
        points = met.where(F.col("n") > bucket).select("fp").distinct().mapInArrow(_emit_points, "k long, fp long")
        near = near.unionByName(_star(points))
    elif max_bits == 1:  # the one-bit neighbours that are there themselves
        hot = met.where(F.col("n") > bucket).select("fp").distinct()
        points = hot.mapInArrow(_emit_points, "k long, fp long").where("k <> fp")
        near = near.unionByName(points.join(hot.select(F.col("fp").alias("k")), "k").select(
            F.greatest("k", "fp").alias("a"), F.least("k", "fp").alias("b")))
    return near.distinct()


def _star(points: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    return points.withColumn("b", F.min("fp").over(Window.partitionBy("k"))).where("fp <> b").select(
        F.col("fp").alias("a"), "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """(doc_id, fp, component_id): groups of documents linked by fingerprints at most ``max_bits`` apart.

    ``component_id`` is the least doc_id that can be reached over links, the row's own included.
    Texts that are null, empty or without a word have fingerprint 0 and are linked like any other.
    Rows without a doc_id get the component of their fingerprint (null if no row of it has an id).
    Repeated rows come back as often as they are there; other columns are ignored; no rows give none.
    """
    marked = materialise(fingerprints(docs, shingle), "simhash-fp")
    least = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected_components(links(least.select("fp"), max_bits, bucket), "simhash-cc")
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialise(rooted.join(named, "root").select("fp", "component_id"), "simhash-classes")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, all their columns, of one row a group: that with the least doc_id (rows
    without one last; of rows that repeat exactly one stays).

    Every row is judged by its own text: rows without a doc_id, or with a doc_id that other texts have
    too, belong to the group of their text. Rows are told apart by a 64-bit hash of doc_id and text.
    """
    key = "_row"
    while key in docs.columns:
        key = f"_{key}"
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    rows = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), shingle, max_bits).groupBy(
        F.col("doc_id").alias(key), F.col("component_id").alias("group")).agg(F.count("*").alias("n"))
    ids = keyed.select(key, F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col(key).alias("c")).alias("order")).distinct()
    rows = materialise(rows.join(ids, key), "simhash-groups")
    first = rows.groupBy("group").agg(F.min("order").alias("first")).select(F.col("first.c").alias(key))
    gone = materialise(rows.join(first, key, "left_anti").select(key), "simhash-gone")
    repeated = materialise(rows.where("n > 1").select(key), "simhash-repeated")
    stay = keyed.join(gone, key, "left_anti")
    return stay.join(repeated, key, "left_anti").select(*docs.columns).unionByName(
        stay.join(repeated, key, "left_semi").dropDuplicates([key]).select(*docs.columns))


def op1_simhash(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
