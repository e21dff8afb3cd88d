"""Exact repeated passages by sorting sampled suffixes in range partitions.

A passage is a string of ``span`` bytes that starts at two or more places. Of all suffixes only
those at anchors are handled: the position of the least 16-byte hash among the first ``REACH``
positions of a passage-long window. Equal windows have their anchor at the same place, so two equal
windows always show as two anchor suffixes with the same ``span - REACH + 1`` leading bytes.

1. Every anchor gives the digest of its leading bytes and that of its surroundings (all bytes that
   a window with this anchor can cover). Leading bytes that occur once are done with. Surroundings
   that occur twice are repeated throughout.
2. Of the rest, one suffix bundle (the surroundings themselves) for each distinct surroundings goes
   to a bucket by its leading bytes, between splitters taken from a sample of the texts. A bucket
   sorts its bundles by leading bytes and compares those in a run of equal ones: in short runs
   each with each, by how far they agree to the left and right of the anchor; long runs are sorted
   by multikey quicksort, eight bytes a step, going on with ties only, once as suffixes from the
   anchor on and once as prefixes read backwards from it. Agreement with the neighbour in either
   order gives, for every distance, the classes of equal suffix and prefix parts, and bundles in the
   same two classes share the window at that distance. Equal leading bytes never lie on two
   sides of a splitter, and the run that a read batch breaks off is carried into the next one, so
   no comparison is lost at a boundary.
3. Leading bytes with more than ``crowd`` different surroundings would make one large sort. Their
   windows are counted one by one through 128-bit digests, spread over all tasks.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeing, materialise, slices, texts

REACH = 136
GRAM = 16
#: Window starts that are handled at once; longer texts go in steps.
STEP = 1 << 19
#: Bundles that one sort takes, but for the rest of a run of equal leading bytes.
SORT = 8000
#: Runs up to this long are compared each with each.
SHORT = 6
#: Share of the texts that splitters are taken from.
SAMPLE = 0.02
#: Least number of rows that makes a key hot.
HOT = 10_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    if base not in _powers or len(_powers[base]) < n:
        x = np.full(max(n, 1 << 14), base, np.uint64)
        x[0] = 1
        _powers[base] = np.cumprod(x, dtype=np.uint64)
    return _powers[base][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def _sums(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(base, len(data)), out=out[1:])
    return out


def _digest(sums: np.ndarray, begin: np.ndarray, end: np.ndarray, inverse: int = _INVERSE) -> np.ndarray:
    """Digest of data[begin:end], wherever it lies."""
    return (sums[end] - sums[begin]) * _power(inverse, len(sums))[begin]


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every ``width`` neighbours: len(x) - width + 1 values."""
    n = len(x)
    padded = np.concatenate([x, np.full(-n % width, x[-1])]).reshape(-1, width)
    ahead = pick.accumulate(padded, axis=1).ravel()
    back = pick.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n - width + 1], ahead[width - 1:n])


class Anchors:
    """The anchors of one step of a text: positions, digests, and the windows that chose them."""

    def __init__(self, text: np.ndarray, at: int, span: int):
        n, left, lead = len(text), REACH - 1, span - REACH + 1
        self.span, self.text = span, text
        last = min(at + STEP, n - span + 1)  # window starts at .. last - 1
        low, high = max(0, at - left), min(n, last + left + span)
        data = text[low:high]
        sums = _sums(data)
        base = at - low
        grams = last - at + left
        gram = sums[base + GRAM:base + GRAM + grams] - sums[base:base + grams]
        gram *= _power(_INVERSE, base + grams)[base:]
        order = (_mix(gram) >> np.uint64(32)).astype(np.uint32)
        least = _sliding(order, REACH, np.minimum)  # of window at + i
        chosen = np.concatenate([np.zeros(left, np.uint32), least, np.zeros(left, np.uint32)])
        place = np.flatnonzero(_sliding(chosen, REACH, np.maximum) == order)
        self.places = place + at
        begin = place + base
        self.keys = _mix(_digest(sums, begin, begin + lead) + np.uint64(lead))
        before, after = np.minimum(self.places, left), np.minimum(n - self.places, span)
        clip = before.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + after.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)
        self.contexts = _mix(_digest(sums, begin - before, begin + after) + clip)


def anchors(text: np.ndarray, span: int) -> Iterator[Anchors]:
    for at in range(0, len(text) - span + 1, STEP):
        yield Anchors(text, at, span)


def _bytes(value) -> np.ndarray:
    raw = value.as_buffer()
    return np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


def _emit_anchors(span: int):
    """(dk, text) -> (dk, key, ctx, n): distinct anchor digests of each row and how often it has them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dk, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = list(anchors(_bytes(value), span))
                if not found:
                    continue
                pair = np.zeros(sum(len(x.keys) for x in found), "u8,u8")
                pair["f0"] = np.concatenate([x.keys for x in found])
                pair["f1"] = np.concatenate([x.contexts for x in found])
                if len(found) > 1:  # an anchor near the end of a step may be chosen in two
                    _, once = np.unique(np.concatenate([x.places for x in found]), return_index=True)
                    pair = pair[once]
                order = np.lexsort((pair["f1"], pair["f0"]))
                pair = pair[order]
                new = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
                n = np.diff(np.append(new, len(pair)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(new), dk, np.int64)), pa.array(pair["f0"][new].view(np.int64)),
                     pa.array(pair["f1"][new].view(np.int64)), pa.array(n.astype(np.int64))], ["dk", "key", "ctx", "n"])
    return run


def _grouped(emit):
    """Join small record batches into larger ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in emit(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= 20_000:
                yield pa.concat_batches(held)
                held, rows = [], 0
        if held:
            yield pa.concat_batches(held)
    return run


BUNDLE = "key long, ctx long, alone boolean, context binary, at int, bucket int"


def _leading(text: np.ndarray, place: int) -> int:
    """The eight bytes at ``place`` as a signed long that sorts as they do."""
    return int.from_bytes(text[place:place + 8].tobytes(), "big") - (1 << 63)


def _emit_leading(span: int):
    """(data) -> (lead): the eight leading bytes of every anchor suffix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_here = [_bytes(v) for v in batch.column(0)]
            leads = [_leading(t, p) for t in texts_here for x in anchors(t, span) for p in x.places.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(leads, pa.int64())], ["lead"])
    return run


def _emit_bundles(span: int, splitters: list[int], at: int):
    """(..., text in column ``at``, ..., wanted: [(key, ctx, alone)]) -> bundles, one for each wanted digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, at, 512)):
            rows = []
            for value, wanted in zip(batch.column(at), batch.column(batch.num_columns - 1).to_pylist()):
                text = _bytes(value)
                left = {(w["key"], w["ctx"]): w["alone"] for w in wanted}
                contexts = np.array([c for _, c in left], np.int64)
                for x in anchors(text, span):
                    found = np.flatnonzero(np.isin(x.contexts.view(np.int64), contexts))
                    for name, a in zip(zip(x.keys.view(np.int64)[found].tolist(), x.contexts.view(np.int64)[found].tolist()),
                                       x.places[found].tolist()):
                        if name in left:
                            before = min(a, REACH - 1)
                            rows.append((*name, left.pop(name), text[a - before:a + span].tobytes(), before,
                                         bisect_right(splitters, _leading(text, a))))
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)],
                                             ["key", "ctx", "alone", "context", "at", "bucket"])
    return run


def multikey_order(words: np.ndarray, group: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Order of rows by group, then by their words from the first column on, then by ``last``.

    Multikey quicksort with a word (eight bytes) as one character: sort each class of ties by its
    next character, split it where that changes, go on with the classes that have more than one row.
    """
    order = np.argsort(group, kind="stable")
    cls = group[order]
    cls = np.maximum.accumulate(np.where(np.append(True, cls[1:] != cls[:-1]), np.arange(len(cls)), 0))
    for column in [*words.T, last]:
        alive = np.flatnonzero(np.bincount(cls, minlength=len(cls))[cls] > 1)
        if not len(alive):
            break
        rows, mine = order[alive], cls[alive]
        k = np.lexsort((column[rows], mine))
        order[alive] = rows = rows[k]
        char = column[rows]
        new = np.append(True, (mine[1:] != mine[:-1]) | (char[1:] != char[:-1]))
        cls[alive] = alive[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    return order


def _words(part: np.ndarray) -> np.ndarray:
    """The bytes of each row as big-endian eight-byte words (zeros at the end)."""
    wide = np.zeros((len(part), -(-part.shape[1] // 8) * 8), np.uint8)
    wide[:, :part.shape[1]] = part
    return wide.view(">u8").astype(np.uint64)


def _neighbours(part: np.ndarray, size: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows (of ``size`` bytes, zeros beyond) within runs: the order, and how many bytes each
    agrees in with the one before it (-1 at the start of a run).

    A row that ends early is the least of all that begin with it, so it never stands between two
    rows that agree further.
    """
    order = multikey_order(_words(part), run, size)
    sorted_part = part[order]
    agree = np.full(len(part), -1, np.int64)
    agree[1:] = np.minimum(_agree(sorted_part[1:] == sorted_part[:-1]), np.minimum(size[order][1:], size[order][:-1]))
    agree[1:][run[order][1:] != run[order][:-1]] = -1
    return order, agree


def run_ties(grid: np.ndarray, before: np.ndarray, after: np.ndarray, run: np.ndarray, span: int) -> np.ndarray:
    """(bundle x distance) mask of repeated windows within runs of any length."""
    left = REACH - 1
    right_order, right = _neighbours(np.ascontiguousarray(grid[:, left:]), after, run)
    left_order, leftward = _neighbours(np.ascontiguousarray(grid[:, left - 1::-1]), before, run)
    mask = np.zeros((len(grid), REACH), bool)
    suffix, prefix = np.empty(len(grid), np.int64), np.empty(len(grid), np.int64)
    for o in range(REACH):
        valid = np.flatnonzero((before >= o) & (after >= span - o))
        if len(valid) > 1:
            suffix[right_order] = np.cumsum(right < span - o)
            prefix[left_order] = np.cumsum(leftward < o)
            pair = suffix[valid] * (len(grid) + 1) + prefix[valid]
            k = np.argsort(pair)
            same = pair[k][1:] == pair[k][:-1]
            mask[valid[k[1:][same]], o] = True
            mask[valid[k[:-1][same]], o] = True
    return mask


MASKS = "key long, ctx long, mask binary"


def _agree(same: np.ndarray) -> np.ndarray:
    """Leading True values of each row."""
    return np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


def pair_ties(grid: np.ndarray, before: np.ndarray, after: np.ndarray, runs: np.ndarray, span: int) -> np.ndarray:
    """(bundle x distance) mask of repeated windows, comparing each bundle with each of its run.

    Two bundles that agree on l bytes left and r bytes right of their anchors share the windows
    whose start is span - r to l bytes ahead of the anchor. ``runs``: (first, size) of runs of at
    most ``SHORT`` bundles.
    """
    left = REACH - 1
    edge = np.zeros((len(grid), REACH + 1), np.int32)
    for size in np.unique(runs[:, 1]):
        first = runs[runs[:, 1] == size, 0]
        for a in range(size):
            for b in range(a + 1, size):
                for k in range(0, len(first), SORT):
                    i, j = first[k:k + SORT] + a, first[k:k + SORT] + b
                    same = grid[i] == grid[j]
                    l = np.minimum(_agree(same[:, left - 1::-1]), np.minimum(before[i], before[j]))
                    r = np.minimum(_agree(same[:, left:]), np.minimum(after[i], after[j]))
                    low = np.maximum(span - r, 0)
                    hit = low <= l
                    for x in (i[hit], j[hit]):  # a bundle comes once in each of the two
                        edge[x, low[hit]] += 1
                        edge[x, l[hit] + 1] -= 1
    return np.cumsum(edge, axis=1)[:, :REACH] > 0


def _sorted_ties(table: pa.Table, span: int) -> pa.RecordBatch:
    """Compare the bundles of a table that is sorted by leading bytes."""
    left, lead, width = REACH - 1, span - REACH + 1, REACH - 1 + span
    context = table.column("context").combine_chunks()
    before = table.column("at").to_numpy().astype(np.int64)
    rows = len(before)
    offsets = np.frombuffer(context.buffers()[1], np.int32)[context.offset:context.offset + rows + 1].astype(np.int64)
    size = np.diff(offsets)
    after = size - before
    grid = np.zeros((rows, width + 8), np.uint8)
    place = np.repeat(np.arange(rows) * (width + 8) + left - before - offsets[:-1], size) + np.arange(offsets[0], offsets[-1])
    grid.ravel()[place] = np.frombuffer(context.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    first = np.flatnonzero(np.append(True, (grid[1:, left:left + lead] != grid[:-1, left:left + lead]).any(axis=1)))
    runs = np.stack([first, np.diff(np.append(first, rows))], axis=1)
    mask = pair_ties(grid[:, :width], before, after, runs[(runs[:, 1] > 1) & (runs[:, 1] <= SHORT)], span)
    long = runs[runs[:, 1] > SHORT]
    if len(long):
        mine = np.concatenate([np.arange(a, a + n) for a, n in long])
        run = np.repeat(np.arange(len(long)), long[:, 1])
        mask[mine] = run_ties(grid[mine, :width], before[mine], after[mine], run, span)
    hit = np.flatnonzero(mask.any(axis=1) & table.column("alone").to_numpy())
    return _masks(table.column("key").to_numpy()[hit], table.column("ctx").to_numpy()[hit], mask[hit])


def _masks(keys: np.ndarray, contexts: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
    packed = np.packbits(mask, axis=1)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(contexts, pa.int64()), pa.array([p.tobytes() for p in packed], pa.binary())],
        ["key", "ctx", "mask"])


def _sort_bucket(span: int):
    lead = span - REACH + 1

    def leading(table: pa.Table, i: int) -> bytes:
        at = table.column("at")[i].as_py()
        return table.column("context")[i].as_py()[at:at + lead]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            for k in range(0, batch.num_rows, SORT):
                part = pa.Table.from_batches([batch.slice(k, SORT)])
                held = part if held is None else pa.concat_tables([held, part])
                if held.num_rows >= SORT:
                    # keep the last run back: the next rows may go on with it
                    last, at = leading(held, held.num_rows - 1), held.num_rows - 1
                    while at and leading(held, at - 1) == last:
                        at -= 1
                    if at:
                        yield _sorted_ties(held.slice(0, at), span)
                        held = held.slice(at)
        if held is not None and held.num_rows:
            yield _sorted_ties(held, span)
    return run


_SECOND = 0xC2B2AE3D27D4EB4F
_SECOND_INVERSE = pow(_SECOND, -1, 1 << 64)


def _emit_windows(span: int):
    """Crowded bundles -> (w1, w2, key, ctx, o): a digest of each window and its distance to the anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["context"], np.uint8)
                o = np.arange(max(0, span - len(data) + r["at"]), r["at"] + 1)
                begin = r["at"] - o
                w1 = _mix(_digest(_sums(data), begin, begin + span))
                w2 = _mix(_digest(_sums(data, _SECOND), begin, begin + span, _SECOND_INVERSE))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.full(len(o), r["key"])),
                     pa.array(np.full(len(o), r["ctx"])), pa.array(np.full(len(o), r["alone"])), pa.array(o.astype(np.int32))],
                    ["w1", "w2", "key", "ctx", "alone", "o"])
    return run


def _pack_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ctx, distances) -> (key, ctx, mask)."""
    for batch in batches:
        mask = np.zeros((batch.num_rows, REACH), bool)
        for i, o in enumerate(batch.column(2)):
            mask[i, np.asarray(o.values)] = True
        yield _masks(batch.column(0).to_numpy(), batch.column(1).to_numpy(), mask)


def _remove(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, 512)):
            out = []
            for value, hits in zip(batch.column(1), batch.column(2).to_pylist()):
                text = _bytes(value)
                begins, ends = repeated_runs(text, hits or [], span)
                keep = np.ones(len(text), bool)
                for b, e in zip(begins, ends):
                    keep[b:e] = False
                out.append((len(text), int(len(text) - keep.sum()), text[keep].tobytes(),
                            [{"begin": int(b), "end": int(e)} for b, e in zip(begins, ends)]))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([x[j] for x in out], t) for j, t in enumerate(kinds))],
                ["doc_id", "n_bytes", "n_removed", "kept", "spans"])
    return run


def _replace(span: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, at, 512)):
            n = batch.num_columns - 1
            out = []
            for value, hits in zip(batch.column(at), batch.column(n).to_pylist()):
                text = _bytes(value)
                begins, ends = repeated_runs(text, hits or [], span)
                edges = [0, *(int(e) for pair in zip(begins, ends) for e in pair), len(text)]
                kept = b"".join(text[b:e].tobytes() for b, e in zip(edges[::2], edges[1::2]))
                out.append(kept.decode("utf-8", "ignore") if value.is_valid else None)
            columns = batch.columns[:n]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:n])
    return run


def repeated_runs(text: np.ndarray, hits: list[dict], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs covered by repeated windows.

    ``hits``: (ctx, mask) of this text's anchors; a null mask means that all windows are repeated.
    """
    if not hits or len(text) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    masks = {h["ctx"]: h["mask"] for h in hits}
    wanted = np.array(list(masks), np.int64)
    edge = np.zeros(len(text) + 1, np.int32)  # of covered bytes
    for x in anchors(text, span):
        contexts = x.contexts.view(np.int64)
        found = np.flatnonzero(np.isin(contexts, wanted))
        held = [masks[c] for c in contexts[found].tolist()]
        whole = np.array([m is None for m in held], bool)
        a = x.places[found[whole]]
        np.add.at(edge, np.maximum(0, a - REACH + 1), 1)
        np.add.at(edge, np.minimum(len(text), a + span), -1)
        partly = x.places[found[~whole]]
        if len(partly):
            bits = np.unpackbits(np.frombuffer(b"".join(m for m in held if m is not None), np.uint8).reshape(len(partly), -1), axis=1)
            turn = np.diff(np.pad(bits[:, :REACH].astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, o = np.nonzero(turn)  # runs of distances: each covers one stretch
            begins, ends = turn[row, o] == 1, turn[row, o] == -1
            np.add.at(edge, partly[row[ends]] - (o[ends] - 1), 1)
            np.add.at(edge, partly[row[begins]] - o[begins] + span, -1)
    covered = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    turns = np.flatnonzero(covered[1:] != covered[:-1])
    return turns[::2], turns[1::2]


def remove_repeats(docs: DataFrame, span: int = 200, crowd: int = 20_000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, kept: binary, spans) of every row.

    Removes each byte covered by a ``span``-byte string of the row's UTF-8 text that also starts
    anywhere else, in another row or in the same one, overlapping or not; all occurrences go.
    Repeats are judged on the input. Repeated rows are occurrences of each other. Null texts
    count as empty; texts shorter than ``span`` lose nothing. A null doc_id stays null, other columns
    are ignored, an empty table gives no rows.
    """
    whole, hits, (dk, found) = _hits(texts(docs), span, crowd)
    return whole.join(hits, dk, "left").select("doc_id", "text", found).mapInArrow(
        freeing(_remove(span)), "doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<begin: long, end: long>>")


def drop_repeats(docs: DataFrame, span: int = 200, crowd: int = 20_000) -> DataFrame:
    """``docs`` with repeated bytes taken out of ``text``, and ``n_chars``, if there, counted anew.

    All rows and columns stay. Bytes of a character that a removed run cuts go with it; a null
    text stays null.
    """
    texts(docs)
    whole, hits, (dk, found) = _hits(docs, span, crowd)
    out = whole.join(hits, dk, "left").select(*docs.columns, found).mapInArrow(
        freeing(_replace(span, docs.columns.index("text"))), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _hot_join(rows: DataFrame, table: DataFrame, keys: list[str], hot: int) -> DataFrame:
    """``rows`` joined with ``table``, which has one row a key and its number of ``rows``. Keys with more than ``hot`` rows
    are broadcast, so none of their rows meet in one task."""
    many = F.broadcast(table.where(F.col("rows") > hot).drop("rows"))
    few = table.where(F.col("rows") <= hot).drop("rows")
    return rows.join(many, keys).unionByName(rows.join(many.select(*keys), keys, "left_anti").join(few, keys).select(*rows.join(many, keys).columns))


def _hits(docs: DataFrame, span: int, crowd: int) -> tuple[DataFrame, DataFrame, tuple[str, str]]:
    """``docs`` with the text as bytes and a routing key, (key, hits) of the texts that hold repeats,
    and the names of these two columns, which ``docs`` does not have."""
    mark = "_"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    route, found_hits = f"{mark}dk", f"{mark}hits"
    if span < REACH + GRAM:
        raise ValueError(f"span must be at least {REACH + GRAM} bytes")
    spark = docs.sparkSession
    # the routing key only brings rows together: two documents that share one do no harm
    whole = docs.withColumn("text", F.col("text").cast("string").cast("binary")).withColumn(
        route, F.xxhash64("doc_id", "text"))
    rows = materialise(whole.select(F.col(route).alias("dk"), "text").mapInArrow(
        freeing(_grouped(_emit_anchors(span))), "dk long, key long, ctx long, n long"), "suffix-anchors")
    # no more than a million keys can have as many rows: these are joined by broadcast, where the rows lie
    hot = max(HOT, rows.count() // 1_000_000)
    shared = materialise(rows.groupBy("key").agg(
        F.sum("n").alias("all"), (F.min("ctx") != F.max("ctx")).alias("mixed"), F.count("*").alias("rows")).where(
        F.col("all") > 1).select("key", "mixed", "rows"), "suffix-keys")
    found = materialise(_hot_join(rows, shared, ["key"], hot), "suffix-shared")
    mixed = materialise(found.where("mixed").groupBy("key", "ctx").agg(
        F.sum("n").alias("n"), F.min("dk").alias("dk"), F.count("*").alias("rows")), "suffix-pairs")
    crowds = mixed.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > crowd).select("key", "rows", F.lit(True).alias("crowded"))
    crowds = materialise(crowds, "suffix-crowds")
    mixed = mixed.join(F.broadcast(crowds.drop("rows")) if crowds.count() <= 1_000_000 else crowds.drop("rows"), "key", "left")
    mixed = mixed.withColumn("crowded", F.coalesce("crowded", F.lit(False))).withColumn("alone", F.col("n") == 1)

    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    splitters = []
    if buckets > 1:
        leads = whole.select("text").sample(SAMPLE, 42).mapInArrow(_grouped(_emit_leading(span)), "lead long")
        cuts = leads.agg(F.percentile_approx("lead", [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0]
        splitters = sorted(set(cuts or []))

    def bundles(crowded: bool) -> DataFrame:
        wanted = mixed.where(F.col("crowded") == crowded).groupBy(F.col("dk").alias(route)).agg(
            F.collect_list(F.struct("key", "ctx", "alone")).alias(found_hits))
        # all columns go along, so that this and the last join of the texts share one shuffle
        return whole.join(wanted, route).select(*docs.columns, route, found_hits)

    text_at = docs.columns.index("text")

    lead = F.expr(f"substring(context, at + 1, {span - REACH + 1})")
    ties = bundles(False).mapInArrow(freeing(_emit_bundles(span, splitters, text_at)), BUNDLE).repartitionById(buckets, F.col("bucket")).sortWithinPartitions(lead).select(
        "key", "ctx", "alone", "context", "at").mapInArrow(freeing(_sort_bucket(span)), MASKS)
    emit, window = _emit_bundles(span, splitters, text_at), _grouped(_emit_windows(span))
    windows = bundles(True).mapInArrow(freeing(lambda batches: window(emit(batches))), "w1 long, w2 long, key long, ctx long, alone boolean, o int")
    # with ties for the least hash a window has several anchors: it is counted once for each distance
    again = windows.groupBy("w1", "w2", "o").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2", "o")
    crowd_ties = windows.where("alone").join(again, ["w1", "w2", "o"]).groupBy("key", "ctx").agg(F.collect_list("o").alias("o")).mapInArrow(
        _pack_masks, MASKS)
    none = F.lit(None).cast("binary").alias("mask")
    marks = mixed.where("NOT alone").select("key", "ctx", none, "rows")
    for part in (ties, crowd_ties):
        marks = marks.unionByName(part.withColumn("rows", F.lit(1).cast("long")))
    hits = _hot_join(found.where("mixed").select("dk", "key", "ctx"), marks, ["key", "ctx"], hot).select("dk", "ctx", "mask").unionByName(
        found.where("NOT mixed").select("dk", "ctx", none))
    # rows that repeat exactly share dk: their hits are the same and are kept once
    hits = hits.groupBy(F.col("dk").alias(route)).agg(F.collect_set(F.struct("ctx", "mask")).alias(found_hits))
    return whole, hits, (route, found_hits)


def op3_suffix_dedup(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
