"""Cross-entropy difference of two matched bigram models, one per corpus, over one vocabulary.

``corpus_scores`` (the operator) counts every word and bigram of both corpora. Texts are cut into
blocks and numbered once; a block sends each of its distinct words and bigrams, with its own counts, to
the bucket of that key, and gets the counts of the whole corpus back. Beyond ``FAN_IN`` blocks the messages go
up in rounds: groups of at most about that many blocks merge bucket by bucket, and what is merged is dealt to as
many finer buckets for the next round; the counts come down the same way. So a message holds about as many keys, and a
task as many messages, at any size of the input. Keys are the words themselves and the driver sees sums only.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import ship_package

from .common import materialise, texts

TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Bytes of text in a block, and of all text for each bucket of keys.
BLOCK_BYTES, BUCKET_BYTES = 14 << 20, 4 << 20
#: Blocks whose messages meet in one task at most (groups are drawn by hash, three quarters of it on average).
FAN_IN = 256
#: Tokens that are scored together.
PART = 400_000
STATE, MARKS = -2, -1


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def _good(labels: DataFrame) -> DataFrame:
    return labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select(
        F.col("doc_id").alias("good_id")).distinct()


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, target): target marks documents labelled of good quality and not toxic."""
    # labels grow with the documents: both sides are shuffled at any size
    return texts(docs).join(_good(labels).hint("merge"), F.col("doc_id") == F.col("good_id"), "left").select("doc_id", "text", F.col("good_id").isNotNull().alias("target"))


class _Numbers(dict):
    """Words numbered as they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


_ZSTD = pa.Codec("zstd", compression_level=6)


def _pack(data: bytes | np.ndarray) -> bytes:
    """Compressed; numbers by their first bytes, second bytes and so on."""
    if isinstance(data, np.ndarray):
        data = np.ascontiguousarray(data.view(np.uint8).reshape(-1, data.itemsize).T).tobytes()
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def _unpack(part: bytes, kind: type | None = None) -> bytes | np.ndarray:
    data = _ZSTD.decompress(part[8:], int.from_bytes(part[:8], "little"), asbytes=True)
    if kind is None:
        return data
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _pairs(ids: np.ndarray, lengths: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word before each token, the distinct bigrams, the bigram of each token) of texts laid end to
    end; ``n_words`` is the start mark, a bigram v w the number v * (n_words + 1) + w."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = n_words
    found, place = np.unique(before * (n_words + 1) + ids, return_inverse=True)
    return before, found, place


def _dealt(hashes: np.ndarray, pairs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bucket of each entry in that order); entries are a block's words, then its bigrams."""
    n = len(hashes)
    first, second = hashes.astype(np.uint64), np.append(hashes, 0).astype(np.uint64)
    x = np.concatenate([first, (second[pairs // (n + 1)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + second[pairs % (n + 1)]])
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = ((x ^ x >> np.uint64(29)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


BLOCKS = "block long, doc_ids array<long>, state binary, ids binary, words binary"
SUMS = ("texts_b", "texts_t", "tokens_b", "tokens_t")
REQUESTS = "block long, bucket long, keys binary, background binary, target binary, " + ", ".join(f"{c} long" for c in SUMS)
ANSWERS = "block long, bucket long, background binary, target binary"
#: A merged node has one row with its state and one for each finer bucket ``up``.
MERGED = REQUESTS.replace("block long, bucket long", "node long, bucket long, up long, state binary")


def _blocks(block_bytes: int):
    """(doc_id, text) -> blocks of about ``block_bytes`` of text, each with its words and their numbers in each text."""
    def row(block: int, doc_ids: list, lines: list[np.ndarray], numbers: _Numbers) -> pa.RecordBatch:
        words = list(numbers)
        hashes = np.array([zlib.crc32(w.encode()) for w in words], np.uint32)
        state = _pack(pickle.dumps((np.array([len(x) for x in lines], np.int64), hashes)))
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([state], pa.binary()),
            pa.array([_pack(np.concatenate(lines))], pa.binary()), pa.array([_pack("\n".join(words).encode())], pa.binary())],
            ["block", "doc_ids", "state", "ids", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, doc_ids, lines, numbers = TaskContext.get().partitionId() << 32, 0, [], [], _Numbers()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                found = tokens(text)
                doc_ids.append(doc_id)
                lines.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                size += len(text or "") + 64
                if size >= block_bytes:
                    yield row(block, doc_ids, lines, numbers)
                    block, size, doc_ids, lines, numbers = block + 1, 0, [], [], _Numbers()
        if doc_ids:
            yield row(block, doc_ids, lines, numbers)
    return run


def _opened(group: pa.Table) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[dict]]:
    """(state row, text lengths, target marks, word numbers, word hashes, other rows by bucket) of one block."""
    rows = sorted(group.to_pylist(), key=lambda r: r["bucket"])
    lengths, hashes = pickle.loads(_unpack(rows[0]["state"]))
    member = np.zeros(len(lengths), bool)
    at = 1
    if len(rows) > 1 and rows[1]["bucket"] == MARKS:
        member[rows[1]["marks"]] = True
        at = 2
    return rows[0], lengths, member, _unpack(rows[0]["ids"], np.int32).astype(np.int64), hashes, rows[at:]


def _requests(buckets: int):
    """State and marks of one block -> its distinct words and bigrams with its own counts, a row for each bucket."""
    def run(group: pa.Table) -> pa.Table:
        state, lengths, member, ids, hashes, _ = _opened(group)
        n = len(hashes)
        _, pairs, place = _pairs(ids, lengths, n)
        order, dealt = _dealt(hashes, pairs, buckets)
        marks = np.repeat(member, lengths)
        counts = [np.concatenate([np.bincount(ids[m], minlength=n), np.bincount(place[m], minlength=len(pairs))])[order].astype(np.int32)
                  for m in (~marks, marks)]
        known = pa.array([*(_unpack(state["words"]).decode().split("\n") if n else ()), ""], pa.large_string())
        bigrams = pc.binary_join_element_wise(known.take(pa.array(pairs // (n + 1))), known.take(pa.array(pairs % (n + 1))), pa.scalar(" ", pa.large_string()))
        keys = pa.concat_arrays([known[:n], bigrams]).take(pa.array(order))
        has = lengths > 0
        sums = (int((has & ~member).sum()), int((has & member).sum()), int(lengths[~member].sum()), int(lengths[member].sum()))
        cuts = [*np.flatnonzero(np.diff(dealt, prepend=-1)).tolist(), len(dealt)]
        rows = [(state["block"], int(dealt[a]), _pack("\n".join(keys.slice(a, b - a).to_pylist()).encode()), _pack(counts[0][a:b]),
                 _pack(counts[1][a:b]), *(sums if a == 0 else (0, 0, 0, 0))) for a, b in zip(cuts, cuts[1:])]
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 3, *[pa.int64()] * 4)
        return pa.table([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], ["block", "bucket", "keys", "background", "target", *SUMS])
    return run


def _totals(requests: pa.Table, width: type) -> tuple[list[int], pa.Array, np.ndarray, list[np.ndarray]]:
    """(keys in each message, the distinct keys, the place of each key among these, their background and target counts)."""
    parts = [pa.array(_unpack(x).decode().split("\n"), pa.large_string()) for x in requests.column("keys").to_pylist()]
    coded = pa.concat_arrays(parts).dictionary_encode()
    at = coded.indices.to_numpy()
    totals = [np.bincount(at, weights=np.concatenate([_unpack(x, width) for x in requests.column(c).to_pylist()])).astype(np.int64)
              for c in ("background", "target")]
    return [len(p) for p in parts], coded.dictionary, at, totals


def _merged(finer: int, level: int, width: type):
    """The messages of some blocks to one bucket -> one message to each of ``finer`` buckets, and the way back."""
    def run(requests: pa.Table) -> pa.Table:
        lengths, keys, at, totals = _totals(requests, width)
        part = np.fromiter((xxhash.xxh64_intdigest(k, level) % finer for k in keys.to_pylist()), np.int64, len(keys))
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        keys, part, totals = keys.take(pa.array(order)), part[order], [t[order] for t in totals]
        node, bucket = requests.column("node")[0].as_py(), requests.column("bucket")[0].as_py()
        sums = [pc.sum(requests.column(c)).as_py() for c in SUMS]
        state = pickle.dumps((requests.column("block").to_pylist(), lengths, _pack(place[at])))
        cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
        rows = [(node, bucket, None, state, None, None, None, *[None] * 4)]
        rows += [(node, bucket, bucket * finer + int(part[a]), None, _pack("\n".join(keys.slice(a, b - a).to_pylist()).encode()),
                  _pack(totals[0][a:b]), _pack(totals[1][a:b]), *(sums if a == 0 else (0, 0, 0, 0))) for a, b in zip(cuts, cuts[1:])]
        kinds = (*[pa.int64()] * 3, *[pa.binary()] * 4, *[pa.int64()] * 4)
        return pa.table([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)],
                        ["node", "bucket", "up", "state", "keys", "background", "target", *SUMS])
    return run


def _handed_back(group: pa.Table) -> pa.Table:
    """State of one merged node and the answers to its messages -> an answer to each of its blocks."""
    rows = sorted(group.to_pylist(), key=lambda r: -1 if r["up"] is None else r["up"])
    blocks, lengths, place = pickle.loads(rows[0]["state"])
    place, ends = _unpack(place, np.int32), np.cumsum(lengths)
    answers = []
    for name in ("background", "target"):
        found = np.concatenate([_unpack(r[name], np.int64) for r in rows[1:]])[place]
        answers.append(pa.array([_pack(found[e - n:e]) for e, n in zip(ends, lengths)], pa.binary()))
    return pa.table([pa.array(blocks, pa.int64()), pa.array([rows[0]["bucket"]] * len(blocks), pa.int64()), *answers],
                    ["block", "bucket", "background", "target"])


def _answers(width: type):
    """The requests of one bucket -> for each sender the counts of its keys in the whole corpus."""
    def run(requests: pa.Table) -> pa.Table:
        lengths, keys, at, totals = _totals(requests, width)
        n_words = pc.sum(pc.invert(pc.match_substring(keys, " "))).as_py()
        ends = np.cumsum(lengths)
        answers = [pa.array([_pack(t[at[e - n:e]]) for e, n in zip(ends, lengths)], pa.binary()) for t in totals]
        return pa.table([requests.column("block"), requests.column("bucket"), *answers, pa.array([n_words, *[0] * (len(lengths) - 1)], pa.int64()),
                         *(requests.column(c) for c in SUMS)], ["block", "bucket", "background", "target", "words", *SUMS])
    return run


def _block_scores(texts_of: tuple[int, int], totals_of: tuple[int, int], vocabulary: int, buckets: int, mass: float):
    """State and answers of one block -> (doc_id, n_tokens, target_loss, background_loss)."""
    sums = np.array(totals_of, np.float64)
    scale = sums.min() / np.maximum(sums, 1) if sums.min() > 0 else np.ones(2)

    def run(group: pa.Table) -> pa.Table:
        state, lengths, member, ids, hashes, rows = _opened(group)
        n = len(hashes)
        before, pairs, place = _pairs(ids, lengths, n)
        order, _ = _dealt(hashes, pairs, buckets)
        losses = np.zeros((2, len(lengths)))
        ends = np.cumsum(lengths)
        counts = []
        for name in ("background", "target"):
            found = np.empty(len(order), np.int64)
            found[order] = np.concatenate([np.zeros(0, np.int64), *(_unpack(r[name], np.int64) for r in rows)])
            counts.append(found)
        a = 0
        while a < len(lengths):
            begin = int(ends[a] - lengths[a])
            b = max(a + 1, int(np.searchsorted(ends, begin + PART, side="right")))
            end = int(ends[b - 1])
            doc = np.repeat(np.arange(a, b), lengths[a:b])
            now, v, p = ids[begin:end], before[begin:end], place[begin:end]
            # a text's own counts: of each word, of each bigram
            _, at, own = np.unique(doc * n + now, return_inverse=True, return_counts=True)
            own_word = own[at]
            first = v == n
            lead = doc * n + np.where(first, now, v)
            names = np.unique(doc * n + now)
            own_before = np.where(first, 1, own[np.searchsorted(names, lead)])
            _, at, own = np.unique(doc * len(pairs) + p, return_inverse=True, return_counts=True)
            own_pair = own[at]
            for c in (0, 1):
                mine = member[doc] == bool(c)
                word, pair = counts[c][:n], counts[c][n:]
                history = (np.where(first, texts_of[c], word[np.where(first, 0, v)]) - mine * own_before) * scale[c]
                total = (totals_of[c] - mine * lengths[doc]) * scale[c]
                single = ((word[now] - mine * own_word) * scale[c] + 1) / (total + vocabulary + 2)
                loss = -np.log(((pair[p] - mine * own_pair) * scale[c] + mass * single) / (history + mass))
                losses[c, a:b] = np.bincount(doc - a, weights=loss, minlength=b - a)
            a = b
        means = [pa.array(x / np.maximum(lengths, 1), mask=lengths == 0) for x in losses]
        return pa.table({"doc_id": pa.array(state["doc_ids"], pa.int64()), "n_tokens": pa.array(lengths), "target_loss": means[1], "background_loss": means[0]})
    return run


def corpus_scores(docs: DataFrame, labels: DataFrame, mass: float = 4.0, block_bytes: int = BLOCK_BYTES,
                  bucket_bytes: int = BUCKET_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row of ``docs``, under models of
    all words and bigrams of the other rows; ``labels`` tell the corpus of a row as in ``marked``.

    Losses are means over a text's tokens in nats; score = target - background, lower for texts
    more like the target. P(w | v) = (c(v w) + mass * P(w)) / (c(v) + mass), P(w) = (c(w) + 1) / (N + V
    + 2) with V the number of distinct words; a text's own counts are taken out of its corpus, and
    counts of the larger corpus are scaled to the size of the smaller. Null and empty texts have no
    tokens and null losses. Repeated rows score alike, a null doc_id stays null, other columns are
    ignored, an empty table gives no rows.

    A text is tokenised whole in one block. Up to ``fan_in`` blocks there is one round of messages; each further round
    merges groups of about three quarters of ``fan_in`` senders, so 100 times the input adds about one round.
    """
    plain = texts(docs)
    size = plain.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # as many buckets as the whole input needs, or a group of blocks
    buckets = max(1, -(-min(size, fan_in * block_bytes) // bucket_bytes))
    blocks = materialise(plain.mapInArrow(_blocks(block_bytes), BLOCKS), "lm-blocks")
    # only ids meet the labels: the texts are not shuffled
    places = blocks.select("block", F.posexplode("doc_ids").alias("at", "doc_id"))
    marks = materialise(places.join(_good(labels).hint("merge"), F.col("doc_id") == F.col("good_id")).groupBy("block").agg(
        F.collect_list("at").alias("marks")).withColumn("bucket", F.lit(MARKS)), "lm-marks")
    states = blocks.withColumn("bucket", F.lit(STATE))
    requests, width, levels = states.select("block", "bucket", "state", "ids", "words").unionByName(
        marks, allowMissingColumns=True).groupBy("block").applyInArrow(_requests(buckets), REQUESTS), np.int32, []
    senders = blocks.count()
    while senders > fan_in:
        senders = -(-senders * 4 // (fan_in * 3))
        node = F.pmod(F.xxhash64(F.lit(len(levels)), "block"), F.lit(senders)).alias("node")
        merged = materialise(requests.select("*", node).groupBy("node", "bucket").applyInArrow(_merged(fan_in, len(levels), width), MERGED), "lm-merged")
        requests, width = merged.where("up IS NOT NULL").select(F.col("node").alias("block"), F.col("up").alias("bucket"), "keys", "background", "target", *SUMS), np.int64
        levels.append(merged.where("up IS NULL").select("node", "bucket", "state"))
    answers = materialise(requests.groupBy("bucket").applyInArrow(
        _answers(width), ANSWERS + ", words long, " + ", ".join(f"{c} long" for c in SUMS)), "lm-answers")
    texts_b, texts_t, tokens_b, tokens_t, vocabulary = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in (*SUMS, "words"))).first()
    for level in reversed(levels):
        below = answers.select(F.col("block").alias("node"), F.expr(f"bucket DIV {fan_in}").alias("bucket"), F.col("bucket").alias("up"), "background", "target")
        answers = materialise(level.unionByName(below, allowMissingColumns=True).groupBy("node", "bucket").applyInArrow(_handed_back, ANSWERS), "lm-answers")
    return states.select("block", "bucket", "doc_ids", "state", "ids").unionByName(marks, allowMissingColumns=True).unionByName(
        answers.select("block", "bucket", "background", "target"), allowMissingColumns=True).groupBy("block").applyInArrow(
        _block_scores((texts_b, texts_t), (tokens_b, tokens_t), vocabulary, buckets, mass),
        "doc_id long, n_tokens long, target_loss double, background_loss double").withColumn(
        "score", F.col("target_loss") - F.col("background_loss"))


def op4_lm_scoring(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return corpus_scores(docs, labels)
