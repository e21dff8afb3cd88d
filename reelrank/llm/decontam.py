"""Benchmark passages in documents: pigeonhole pieces and Myers' bit-parallel distance.

Texts are compared as lower-case words joined by single spaces. An item of n characters may occur
with up to k = floor(rate * n) edits. Cut into k + 1 pieces, at least one piece of any such
occurrence is unharmed, so exact hits of the pieces (one Aho-Corasick pass over each document) give
every candidate place. Myers' distance is taken of ever larger parts of the item to the text around
a hit, each with its share of the edits, and at last of the whole item.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeing, materialise, texts

#: ASCII white space, punctuation and controls become spaces; other bytes stay.
_ASCII = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_OTHER = re.compile(r"[^\w\x00-\x7f]+")
#: The word rule: items with fewer characters must begin and end with a word, as inside words they would be chance.
SHORT = 25
HITS = "doc_id long, item_id long, distance int, budget int, begin long, end long"


def normalise(text: str | None) -> str:
    """Lower-case words (letters and digits) joined by single spaces."""
    if not text:
        return ""
    text = text.lower()
    if not text.isascii():
        text = _OTHER.sub(" ", text)
    return b" ".join(text.encode().translate(_ASCII).split()).decode()


def budget(n: int, rate: float) -> int:
    return int(rate * n)


def split(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces of nearly equal length."""
    at = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


def ancestors(bounds: list[int]) -> list[list[tuple[int, int, int]]]:
    """For every piece, the (begin, end, budget) of the joined pieces above it, least first.

    Pieces are joined in a binary tree; a node over l pieces has the budget l - 1. If a node's text
    occurs within its budget, so does the text of one of its halves: an occurrence of the item
    within its budget therefore passes every test on the way up from some piece hit exactly.
    """
    above: list[list[tuple[int, int, int]]] = [[] for _ in bounds[1:]]

    def walk(a: int, b: int) -> None:
        if b - a > 1:
            walk(a, (a + b) // 2)
            walk((a + b) // 2, b)
            if b - a < len(above):
                for i in range(a, b):
                    above[i].append((bounds[a], bounds[b], b - a - 1))

    walk(0, len(above))
    return above


def masks(pattern: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << i
    return found


def myers(pattern_masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of ``text``, and the first such end."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    get = pattern_masks.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph <<= 1
        pv = (mh << 1 | ~(xv | ph)) & full
        mv = ph & xv & full
        if score < best:
            best, end = score, j + 1
    return best, end


def myers_from(pattern_masks: dict[str, int], m: int, text: str) -> Iterator[int]:
    """Edit distance of the whole pattern to text[:1], text[:2], …: the occurrence begins where the text does."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    get = pattern_masks.get
    for c in text:
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ph << 1 | 1
        pv = (mh << 1 | ~(xv | ph)) & full
        mv = ph & xv & full
        yield score


class Item:
    """A normalised item with its budget and what its tests need."""

    def __init__(self, text: str, rate: float):
        self.text, self.size, self.budget = text, len(text), budget(len(text), rate)
        self.masks = masks(text)
        self.backwards = masks(text[::-1])

    def between_words(self, text: str, origins: list[int]) -> tuple[int, int, int] | None:
        """(distance, begin, end) of the best run of whole words within the budget that begins within
        the budget of one of ``origins``: Myers' distance from every such word on."""
        k, best = self.budget, None
        begins = {b for origin in origins for b in range(max(0, origin - k), min(origin + k, len(text)) + 1)
                  if not b or text[b - 1] == " "}
        for b in sorted(begins):
            for n, d in enumerate(myers_from(self.masks, self.size, text[b:b + self.size + k]), 1):
                if d <= k and (best is None or d < best[0]) and (b + n == len(text) or text[b + n] == " "):
                    best = (d, b, b + n)
        return best

    def begin(self, text: str, end: int, distance: int) -> int:
        """Where an occurrence that ends at ``end`` with that many edits begins: Myers' distance read backwards."""
        before = text[max(0, end - self.size - distance):end][::-1]
        for n, d in enumerate(myers_from(self.backwards, self.size, before), 1):
            if d == distance:
                return end - n
        return end

    def anywhere(self, text: str, origins: list[int]) -> tuple[int, int, int] | None:
        """(distance, begin, end) of the best place around ``origins`` within the budget."""
        k, reach = self.budget, self.size + self.budget
        best, begin, end = (k + 1, 0), None, 0
        for s in [*sorted(o - k for o in origins), None]:
            if begin is not None and (s is None or s > end):
                at = max(0, begin)
                d, stop = myers(self.masks, self.size, text[at:end])
                if d < best[0]:
                    best = (d, at + stop)
                begin = None
            if s is not None:
                begin, end = (s if begin is None else begin), s + k + reach
        return (best[0], self.begin(text, best[1], best[0]), best[1]) if best[0] <= k else None


class Matcher:
    """Finds the items of one block, a list of (item_id, normalised text, repeats), in normalised texts.

    Items shorter than ``bounded`` count only where they begin and end with a word of the text.
    """

    def __init__(self, items: list[tuple[int, str, int]], rate: float, bounded: int = SHORT):
        import ahocorasick

        self.items, self.ids, self.bounded = [], defaultdict(list), bounded
        for item_id, text, repeats in items:
            if text:
                self.ids[text].append((item_id, repeats))
        pieces: dict[str, list[tuple[int, int, list]]] = defaultdict(list)
        for n, text in enumerate(self.ids):
            item = Item(text, rate)
            self.items.append(item)
            cuts = split(text, item.budget)
            tests: dict[tuple[int, int, int], tuple] = {}
            for (at, piece), above in zip(cuts, ancestors([*(a for a, _ in cuts), len(text)])):
                for node in above:
                    if node not in tests:
                        tests[node] = (*node, masks(text[node[0]:node[1]]))
                pieces[piece].append((n, at, [tests[x] for x in above]))
        self.pieces = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.pieces.add_word(piece, (len(piece), places))
        if pieces:
            self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int, int, int]]:
        """(item_id, distance, budget, begin, end, repeats) of the best place of each item found."""
        spans: dict[int, list[int]] = defaultdict(list)
        if self.items and text:
            for last, (n, places) in self.pieces.iter(text):
                for item, at, above in places:
                    origin = last + 1 - n - at  # where the item would begin without edits
                    for a, b, k, found in above:
                        if myers(found, b - a, text[max(0, origin + a - k):origin + b + k])[0] > k:
                            break
                    else:
                        spans[item].append(origin)
        out = []
        for n, origins in spans.items():
            item = self.items[n]
            hit = (item.between_words if item.size < self.bounded else item.anywhere)(text, origins)
            if hit is not None:
                out.extend((i, hit[0], item.budget, hit[1], hit[2], repeats) for i, repeats in self.ids[item.text])
        return out


def _scan(items, rate: float, bounded: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, rate, bounded)
        for batch in batches:
            rows = [(doc_id, *hit) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for hit in matcher.find(normalise(text.as_py()))]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)],
                ["doc_id", "item_id", "distance", "budget", "begin", "end", "repeats"])
    return run


def _without(items, rate: float, bounded: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, rate, bounded)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.find(normalise(text.as_py())) for text in batch.column(at)], pa.bool_()))
    return run


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator:
    """Broadcasts of the distinct items, in blocks of at most ``block_bytes`` (or one longer item)."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        F.octet_length("text") > 0).groupBy("item_id", "text").agg(F.count("*").alias("repeats"))
    sized = materialise(items.withColumn("size", F.octet_length("text").cast("long") + 16).withColumn("draw", F.xxhash64("item_id", "text")), "decontam-items")
    total, rows = sized.agg(F.sum("size"), F.count("*")).first()
    blocks = 1
    while total and blocks < rows:
        block = F.pmod("draw", F.lit(blocks))
        if sized.groupBy(block).agg(F.sum("size").alias("s")).agg(F.max("s")).first()[0] <= block_bytes:
            break
        blocks *= 2
    for b in range(blocks if total else 0):
        block = sized.where(F.pmod("draw", F.lit(blocks)) == b).select("item_id", "text", "repeats").collect()
        yield spark.sparkContext.broadcast([(r.item_id, normalise(r.text), r.repeats) for r in block])


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, block_bytes: int = 8 << 20,
                 bounded: int = SHORT) -> DataFrame:
    """(doc_id, item_id, distance, budget, begin, end): the items that each document holds.

    ``begin`` and ``end`` are places in the normalised text of an occurrence with the fewest edits. Items of
    all lengths have a budget of ``rate`` of their characters; those shorter than ``bounded`` normalised
    characters count only where they begin and end with a word. Items that are null or hold no word
    match nothing, as do null and empty documents. Repeated items and documents are reported each; a
    null doc_id stays null; a very long document is read whole; other columns are ignored; an empty table
    on either side gives no rows.

    Distinct items are shipped to the tasks in blocks of at most ``block_bytes`` (or one longer item), and
    each block is one pass over the documents, so nothing that is shipped grows with the benchmark.
    """
    plain = texts(docs)
    out = docs.sparkSession.createDataFrame([], HITS + ", repeats long")
    for items in _blocks(benchmark, block_bytes):
        out = out.unionByName(plain.mapInArrow(freeing(_scan(items, rate, bounded)), HITS + ", repeats long"))
    return out.withColumn("repeats", F.explode(F.expr("array_repeat(0, CAST(repeats AS INT))"))).drop("repeats")


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, block_bytes: int = 8 << 20,
                  bounded: int = SHORT) -> DataFrame:
    """The rows of ``docs``, all their columns, that hold no benchmark item. Every row is judged by its own
    text, whatever its doc_id. Four blocks of items are one pass; then what is left is stored."""
    texts(docs)
    out, at = docs, docs.columns.index("text")
    for n, items in enumerate(_blocks(benchmark, block_bytes), 1):
        out = out.mapInArrow(freeing(_without(items, rate, bounded, at)), docs.schema)
        if n % 4 == 0:
            out = materialise(out, "decontam")
    return out


def op2_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All items, of any length, inside all documents; items under ``SHORT`` characters between words."""
    return contaminated(docs, benchmark)
