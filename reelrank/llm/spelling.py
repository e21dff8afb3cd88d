"""Spelling variants: words one edit apart, found by a bit-sliced position index.

Words meet by pieces: an edit leaves the first or the second half of the shorter word whole, so
each word is dealt by both halves, for its own length and for the length below. Groups of more than
``GROUP`` words are dealt again with the half that may hold the edit halved, until one letter is
left; a group is then bounded by the alphabet. Groups are laid side by side in blocks; a block has
a bitset over its words for each (position, letter), and all words of the block run through them at
once: 64 index words an operation, with zero-error and one-error sets side by side.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.session import ship_package

from .common import materialise, spread_join

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO, CUT_EVERY = 7, 2, 10, 31
#: Largest group that goes into a block as it is, and the rows and letters a block holds beyond one group.
GROUP, BLOCK_ROWS, BLOCK_LETTERS = 2048, 1024, 1 << 18
SALTS = 64

PAIRS = "word string, other string, other_n long"


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of at least seven code points that occur twice or more in all texts.

    Words are maximal runs of letters, A-Z in lower case; where 31 divides the CRC32 of
    ``doc_id:word`` the letter at CRC32 modulo length is taken out. A null text has no words, a null
    doc_id counts as an empty string.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"), F.length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    word = F.when(F.col("h") % CUT_EVERY == 0, short).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _key(m: Column, lo: Column, hi: Column) -> Column:
    """Digest of what an edit between ``lo`` and ``hi`` leaves whole. Equal digests of other pieces only
    add words to a group."""
    return F.xxhash64(m, lo, hi, F.substring("word", F.lit(1), lo),
                      F.when(m > hi, F.expr("right(word, m - hi)")).otherwise(""))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice, for an edit in the first and in the second half of lo to hi."""
    mid = F.expr("(lo + hi) div 2").cast("int")
    halves = F.array(F.struct(F.col("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi")))
    rows = rows.select("word", "n", "m", F.inline(halves))
    return rows.withColumn("key", _key(F.col("m"), F.col("lo"), F.col("hi")))


def _groups(words: DataFrame) -> DataFrame:
    """(word, n, m, key): rows of one key are a group of 2 to about ``GROUP`` words; any two words one
    edit apart share a group, where m is the length of the shorter one."""
    size = F.length("word")
    classes = F.array(size, size - 1)
    rows = words.select("word", "n", F.explode(classes).alias("m")).where(F.col("m") >= LEAST_LENGTH)
    rows = _halved(rows.select("word", "n", "m", F.lit(0).alias("lo"), F.col("m").alias("hi")))
    settled = None
    while True:
        rows = materialise(rows.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")), "spell-rows")
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.col("hi") - F.col("lo")).alias("room")).where("size > 1")
        rows = materialise(spread_join(rows, ["key"], sizes, "salt"), "spell-sized")
        large = (F.col("size") > GROUP) & (F.col("room") > 1)
        done = rows.where(~large).select("word", "n", "m", "key")
        settled = done if settled is None else settled.unionByName(done)
        rows = rows.where(large)
        if rows.isEmpty():
            return settled
        # a group whose pieces differ under one digest may hold several lo, hi
        rows = _halved(rows.where("hi - lo > 1").select("word", "n", "m", "lo", "hi"))


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    packed = np.packbits(flags, axis=1, bitorder="little")
    pad = -packed.shape[1] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, pad)))).view(np.uint64)


def near_in_block(words: list[str], m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of words one edit apart, where i has the class's shorter length ``m[i]``; a
    replacement comes in both directions, an added letter of j from i's side only."""
    sizes = np.array([len(w) for w in words])
    deep = int(sizes.max())
    codes = np.zeros((len(words), deep + 2), np.uint32)  # 0 is no letter
    codes[:, :deep] = np.array(words).astype(f"<U{deep}").view(np.uint32).reshape(len(words), -1)
    asks = np.flatnonzero(sizes == m)
    if not len(asks):
        return asks, asks
    ask, ask_size = codes[asks], sizes[asks]
    ones = _bits(np.ones((1, len(words)), bool))

    def index(p: int) -> tuple[np.ndarray, np.ndarray]:
        """Letters at position p, and a bitset of the words for each; then one of no and one of all words."""
        letters, which = np.unique(codes[:, p], return_inverse=True)
        sets = _bits(which[None, :] == np.arange(len(letters))[:, None])
        return letters, np.vstack([sets, np.zeros_like(ones), ones])

    def match(slot: tuple[np.ndarray, np.ndarray], letter: np.ndarray, ended: np.ndarray) -> np.ndarray:
        letters, sets = slot
        row = np.searchsorted(letters, letter)
        row = np.where(np.append(letters, 0)[row] == letter, row, len(letters))
        return sets[np.where(ended, len(letters) + 1, row)]

    same = np.repeat(ones, len(asks), axis=0)       # no error so far
    other = np.zeros_like(same)                     # at most one letter replaced
    longer = np.zeros_like(same)                    # one letter more in the index word
    here = index(0)
    for p in range(int(ask_size.max())):
        after = index(p + 1)
        ended = ask_size <= p
        longer = (longer | same) & match(after, ask[:, p], ended)
        hit = match(here, ask[:, p], ended)
        other = (other & hit) | same
        same &= hit
        here = after
    lengths, which = np.unique(sizes, return_inverse=True)
    of_length = (lengths, np.vstack([_bits(which[None, :] == np.arange(len(lengths))[:, None]), np.zeros_like(ones), ones]))
    never = np.zeros(len(asks), bool)
    found = (other & ~same & match(of_length, ask_size, never)) | ((longer | same) & match(of_length, ask_size + 1, never))
    i, j = np.nonzero(np.unpackbits(found.view(np.uint8), axis=1, count=len(words), bitorder="little"))
    return asks[i], j


def _pairs(words: list[str], n: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    i, j = near_in_block(words, m)
    w = pa.array(words)
    back = np.array([len(words[a]) != len(words[b]) for a, b in zip(i.tolist(), j.tolist())], bool)
    left, right = np.concatenate([i, j[back]]), np.concatenate([j, i[back]])
    return pa.RecordBatch.from_arrays([w.take(pa.array(left)), w.take(pa.array(right)), pa.array(n[right])], ["word", "other", "other_n"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows (word, n, m, key) that come sorted by (m, key), block by block."""
    held: list[tuple] = []     # whole groups
    group: list[tuple] = []    # the group that may go on
    letters = last = None

    def block() -> Iterator[pa.RecordBatch]:
        if held:
            words, n, m = (list(x) for x in zip(*held))
            held.clear()
            yield _pairs(words, np.array(n, np.int64), np.array(m))

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal letters
        size = sum(len(w) for w, _, _ in group)
        if held and (len(held) + len(group) > BLOCK_ROWS or letters + size > BLOCK_LETTERS):
            yield from block()
        letters = size + (letters if held else 0)
        held.extend(group)
        group.clear()

    for batch in batches:
        for word, n, m, key in zip(*(c.to_pylist() for c in batch.columns)):
            if (m, key) != last:
                yield from close()
                last = (m, key)
            group.append((word, n, m))
    yield from close()
    yield from block()


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n): all ordered pairs of ``words`` (word, n) that differ by one inserted, deleted
    or replaced code point, each once. Words must be distinct and of seven code points or more."""
    ship_package(words.sparkSession)
    rows = _groups(words.select("word", "n"))
    parts = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # groups are small by now, whatever the words
    dealt = rows.repartition(parts, "key").sortWithinPartitions("m", "key").select("word", "n", "m", "key")
    return dealt.mapInArrow(_near, PAIRS).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word on the way from form to form. A form is at least ten times as
    frequent as its word, so there are no circles; each round doubles the way."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")), "spell-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def spelling_groups(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``vocabulary(docs)``.

    ``n_near`` counts the words one edit away; ``form`` is the most frequent of them (ties: the smallest in
    code-point order) if it occurs at least ten times as often as the word; ``root`` is the last word from
    form to form. Repeated rows count as often as they are there; very long texts and words are
    read whole; an empty table, or none but null and empty texts, gives no rows; other columns
    are ignored.
    """
    words = materialise(vocabulary(docs), "spell-words")
    # a word has a bounded number of near words: places times letters
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    formed = (-F.col("best.less")) >= F.col("n") * FORM_RATIO
    rows = words.join(best, "word", "left").select(
        "word", F.when(formed, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, -F.col("best.less")).alias("form_n"))
    rows = materialise(rows, "spell-forms")
    roots = _roots(rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(docs: DataFrame) -> DataFrame:
    return spelling_groups(docs)


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of a string's UTF-8 bytes, bit by bit."""
    byte_list = (f"list_transform(range(1, length(hex(encode({text}))) // 2 + 1), "
                 f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte_list}), lambda a, b: list_reduce("
            "[xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")


OP12_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(text, '{LETTERS}+')), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run
  FROM documents),
hashed AS (SELECT run, id || ':' || run AS s FROM runs WHERE length(run) >= 7),
summed AS (SELECT run, {crc32_sql("s")} AS h FROM hashed),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM summed),
words AS (SELECT word, count(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gap
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.gap
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.gap),
best AS (
  SELECT word, n_near, other, other_n FROM (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k FROM near)
  WHERE k = 1),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
         CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
way(word, stop) AS (SELECT word, word FROM forms UNION ALL SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.stop WHERE f.form IS NOT NULL),
roots AS (SELECT way.word, stop AS root FROM way JOIN forms f ON f.word = way.stop WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word"""
