"""Language of code-switched text: a linear-chain CRF labels every word.

States are the languages of the training rows. A word's features are its affixes, character
n-grams and itself (a learned lexicon), hashed into one weight table; transitions between
neighbouring words' languages are learned with them. A whole text is one chain: blocks of words
are summarised by transfer matrices, the forward and backward vectors are carried from block to
block, and every word gets its exact posterior, whatever the text's length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.session import ship_package

from .common import draw_least, freeing, materialise, slices, texts

WORD = re.compile(r"[^\W\d_]+")
#: Words in a block of the chain, and in a training chain.
BLOCK = 64
DIM = 1 << 17
#: Words whose emission scores a worker keeps.
CACHE = 150_000
#: Longer runs of letters (as in scripts without spaces) are several words of the chain.
LONG = 40
#: Stands at the end of a part where its run goes on.
ON = "\0"


def parts(run: str) -> list[str]:
    """A long run in nearly equal parts, each with the three letters after it, so that every n-gram of
    the run begins in one of them."""
    n = -(-len(run) // LONG)
    at = [i * len(run) // n for i in range(n + 1)]
    return [(ON if a else "") + run[a:b + 3] + (ON if b < len(run) else "") for a, b in zip(at, at[1:])]


def words(text: str | None) -> list[str]:
    found = WORD.findall(text.lower()) if text else []
    if found and max(map(len, found)) > LONG:
        found = [p for w in found for p in (parts(w) if len(w) > LONG else (w,))]
    return found


def has_letter(found: list[str]) -> bool:
    return any(c.isalpha() for w in found for c in w)


def feature_rows(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(indices, row starts) of the hashed features of words, one row after the other.

    Features are the 2-, 3- and 4-grams of ``^word$`` (those with a mark are its affixes) and the
    word itself. A part of a run has no mark where the run goes on. Index ``DIM`` stands for no feature.
    """
    marked = [f"^{w}$".replace("^" + ON, "").replace(ON + "$", "") for w in found]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(size)
    left = np.repeat(ends, size) - np.arange(len(codes))  # letters to the end of the word
    columns = []
    gram = codes.copy()
    for n in (2, 3, 4):
        gram = gram[:len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
        at = np.full(len(codes), DIM, np.int64)
        mixed = (gram ^ gram >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
        at[:len(gram)] = (mixed >> np.uint64(64 - DIM.bit_length() + 1)).astype(np.int64)
        at[left < n] = DIM
        columns.append(at)
    # the letters after a cut are the next part's: n-grams that begin there are counted with it
    beyond = np.repeat(np.fromiter((w.endswith(ON) for w in found), bool, len(found)), size) & (left <= 3)
    for column in columns:
        column[beyond] = DIM
    whole = np.full(len(codes), DIM, np.int64)
    whole[ends - size] = [zlib.crc32(w.encode()) & (DIM - 1) for w in found]
    columns.append(whole)
    return np.stack(columns, axis=1).ravel(), (ends - size) * 4


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def posteriors(scores: np.ndarray, lengths: np.ndarray, log_t: np.ndarray) -> np.ndarray:
    """Posterior of each state at each word of chains laid end to end (lengths >= 1)."""
    s = scores.shape[1]
    t_mat = np.exp(log_t - log_t.max())
    blocks = -(-lengths // BLOCK)
    first = np.cumsum(blocks) - blocks
    inside = np.arange(len(scores)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    b_of, t_of = np.repeat(first, lengths) + inside // BLOCK, inside % BLOCK
    pot = np.ones((BLOCK, int(blocks.sum()), s))
    there = np.zeros(pot.shape[:2], bool)
    pot[t_of, b_of] = np.exp(scores - scores.max(axis=1, keepdims=True))
    there[t_of, b_of] = True
    # transfer matrix of each block: from the state before its first word to that of its last
    step = np.broadcast_to(np.eye(s), (pot.shape[1], s, s)).copy()
    for t in range(BLOCK):
        new = (step.reshape(-1, s) @ t_mat).reshape(step.shape) * pot[t][:, None, :]
        np.copyto(step, new, where=there[t][:, None, None])
        if t % 8 == 7:
            step /= np.maximum(step.max(axis=(1, 2), keepdims=True), 1e-300)
    into, out = np.full((pot.shape[1], s), 1 / s), np.ones((pot.shape[1], s))
    longest = int(blocks.max())
    for r in range(1, longest):
        at = first[blocks > r] + r
        into[at] = _unit(np.einsum("bi,bij->bj", into[at - 1], step[at - 1]))
    for r in range(longest - 1, 0, -1):
        at = first[blocks > r] + r
        out[at - 1] = _unit(np.einsum("bij,bj->bi", step[at], out[at]))
    alpha = np.empty_like(pot)
    for t in range(BLOCK):
        into = _unit((into @ t_mat) * pot[t])  # beyond a chain's last word nothing reads it
        alpha[t] = into
    for t in range(BLOCK - 1, -1, -1):
        alpha[t] *= out
        np.copyto(out, _unit((pot[t] * out) @ t_mat.T), where=there[t][:, None])
    return _unit(alpha[t_of, b_of])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    log_t: np.ndarray


def train(chains: list[tuple[str, list[str]]], epochs: int = 3, batch: int = 256, rate: float = 0.15,
          seed: int = 42) -> Model:
    """Fit on (language, words) chains of at most ``BLOCK`` words.

    Each chain is used as it is and spliced into one of another draw at a random word, so that
    the transition weights see switches. Adagrad ascent on the chain likelihood.
    """
    rng = np.random.default_rng(seed)
    langs = sorted({x for x, _ in chains})
    s = len(langs)
    vocabulary: dict[str, int] = {}
    for _, found in chains:
        for w in found:
            vocabulary.setdefault(w, len(vocabulary))
    indices, starts = feature_rows(list(vocabulary))
    owner = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(starts, len(indices))))
    indices, owner = indices[indices < DIM], owner[indices < DIM]
    starts = np.searchsorted(owner, np.arange(len(vocabulary) + 1))
    data = [(np.array([vocabulary[w] for w in found]), langs.index(x)) for x, found in chains if found]
    weights, log_t = np.zeros((DIM, s)), np.zeros((s, s))
    w_sum, t_sum = np.full((DIM, s), 1e-8), np.full((s, s), 1e-8)
    for _ in range(epochs):
        order, mates = rng.permutation(len(data)), rng.permutation(len(data))
        spliced = []
        for i, j in zip(order, mates):
            (a, x), (b, y) = data[i], data[j]
            at = int(rng.integers(0, len(a) + 1)) if rng.random() < 0.5 else len(a)
            ids = np.concatenate([a[:at], b[at:BLOCK]])[:BLOCK]
            spliced.append((ids, np.r_[np.full(min(at, len(ids)), x), np.full(len(ids) - min(at, len(ids)), y)]))
        for k in range(0, len(spliced), batch):
            part = [p for p in spliced[k:k + batch] if len(p[0])]
            n = np.array([len(p[0]) for p in part])
            ids, gold = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
            used, where = np.unique(ids, return_inverse=True)
            many = starts[used + 1] - starts[used]
            rows = np.repeat(np.arange(len(used)), many)
            feats = indices[np.repeat(starts[used] - np.cumsum(many) + many, many) + np.arange(len(rows))]
            scores = np.add.reduceat(weights[feats], np.cumsum(many) - many)[where]
            post, g_t = _gradient(scores, n, log_t, gold)
            miss = np.eye(s)[gold] - post
            touched, feats = np.unique(feats, return_inverse=True)
            g = np.empty((len(touched), s))
            for j in range(s):
                word = np.bincount(where, miss[:, j], len(used))
                g[:, j] = np.bincount(feats, word[rows], len(touched))
            g = g / len(part) - 1e-6 * weights[touched]
            w_sum[touched] += g * g
            weights[touched] += rate * g / np.sqrt(w_sum[touched])
            g_t = g_t / len(part)
            t_sum += g_t * g_t
            log_t += rate * g_t / np.sqrt(t_sum)
    return Model(langs, weights.astype(np.float32), log_t)


def _gradient(scores: np.ndarray, lengths: np.ndarray, log_t: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word posteriors, and observed less expected transitions, of chains of at most ``BLOCK`` words."""
    s = scores.shape[1]
    t_mat = np.exp(log_t)
    begin = np.cumsum(lengths) - lengths
    pot = np.exp(scores - scores.max(axis=1, keepdims=True))
    alpha, beta = np.empty_like(pot), np.ones_like(pot)
    longest = int(lengths.max())
    alpha[begin] = _unit((np.full((1, s), 1 / s) @ t_mat) * pot[begin])
    for t in range(1, longest):
        at = begin[lengths > t] + t
        alpha[at] = _unit((alpha[at - 1] @ t_mat) * pot[at])
    for t in range(longest - 1, 0, -1):
        at = begin[lengths > t] + t
        beta[at - 1] = _unit((pot[at] * beta[at]) @ t_mat.T)
    later = np.ones(len(scores), bool)
    later[begin] = False
    at = np.flatnonzero(later)
    pair = alpha[at - 1][:, :, None] * t_mat * (pot[at] * beta[at])[:, None, :]
    pair /= np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)
    seen = np.bincount(gold[at - 1] * s + gold[at], minlength=s * s).reshape(s, s)
    return _unit(alpha * beta), seen - pair.sum(axis=0)


class Labeller:
    """Word posteriors of texts under a model, with a bounded cache of word scores."""

    def __init__(self, model: Model):
        self.model = model
        self._known: dict[str, int] = {}
        self._scores = np.empty((0, len(model.languages)), np.float32)
        self._weights = np.vstack([model.weights, np.zeros((1, len(model.languages)), np.float32)])

    def _look_up(self, found: list[str]) -> np.ndarray:
        if len(self._known) > CACHE:
            self._known, self._scores = {}, self._scores[:0]
        new = list(set(found).difference(self._known))
        if new:
            indices, starts = feature_rows(new)
            self._scores = np.concatenate([self._scores, np.add.reduceat(self._weights[indices], starts)])
            self._known.update(zip(new, range(len(self._known), len(self._known) + len(new))))
        return self._scores[np.fromiter(map(self._known.__getitem__, found), np.int64, len(found))]

    def label(self, found: list[list[str]]) -> list[np.ndarray]:
        """For each non-empty word list, the (words x languages) posteriors."""
        lengths = np.array([len(w) for w in found])
        post = posteriors(self._look_up([w for t in found for w in t]).astype(np.float64), lengths, self.model.log_t)
        return np.split(post, np.cumsum(lengths)[:-1])


def label_texts(labeller: Labeller, values: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text; ``und`` and 0 where there is none to tell."""
    langs = labeller.model.languages
    found = [words(t) for t in values]
    usable = [bool(langs) and has_letter(w) for w in found]
    means = iter([p.mean(axis=0) for p in labeller.label([w for w, u in zip(found, usable) if u])] if any(usable) else [])
    best = [next(means) if u else None for u in usable]
    return (["und" if m is None else langs[int(m.argmax())] for m in best],
            [0.0 if m is None else min(1.0, float(m.max())) for m in best])


def _predict(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model_of.value)
        for batch in batches:
            for part in slices(batch, 1):
                pred, score = label_texts(labeller, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"])
    return run


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(i, lang, k, " ".join(w[k:k + BLOCK]))
                for i, lang, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), map(words, batch.column(2).to_pylist()))
                for k in range(0, len(w), BLOCK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.string()))],
            ["doc_id", "lang", "k", "chain"])


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, rows_per_language: int = 400, chains_per_language: int = 2000, seed: int = 42) -> Model:
    """Train on a bounded sample of the rows that are not held out and have a lang and a text.

    ``rows_per_language`` rows of each language, drawn by a hash of doc_id, are cut into chains of
    ``BLOCK`` words, of which ``chains_per_language`` are drawn the same way.
    """
    ship_package(docs.sparkSession)
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())

    # stored first: Spark then knows how small it is and need not shuffle the texts to join it
    drawn = materialise(draw_least(usable.select("doc_id", "lang"), rows_per_language, "lang", ["doc_id"], seed).distinct(), "langid-sample")
    chains = usable.join(drawn, ["doc_id", "lang"], "left_semi").select("doc_id", "lang", "text").mapInArrow(
        _chains, "doc_id long, lang string, k long, chain string")
    chains = materialise(chains, "langid-chains")
    sample = draw_least(chains, chains_per_language, "lang", ["doc_id", "k"], seed).orderBy("lang", "doc_id", "k").collect()
    if not sample:
        return Model([], np.zeros((DIM, 0), np.float32), np.zeros((0, 0)))
    return train([(r.lang, r.chain.split(" ")) for r in sample], seed=seed)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    lang_pred is the language with the greatest mean word posterior, score that mean. Null texts,
    texts without a letter, and all texts under a model without languages are ``und`` with score
    0; ties go to the first language by name. Repeated rows are predicted alike, a null doc_id
    stays null and counts as held out, other columns are ignored, no rows give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x languages floats and a square matrix
    return texts(docs).withColumn("held_out", held_out()).mapInArrow(
        freeing(_predict(shared)), "doc_id long, held_out boolean, lang_pred string, score double")


def _filter(model_of, at: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model_of.value)
        for batch in batches:
            for part in slices(batch, at):
                scores = label_texts(labeller, part.column(at).to_pylist())[1]
                yield part.filter(pa.array([s >= least for s in scores]))
    return run


#: How far a score must lie above that of a uniform guess, as a share of the way to certainty.
ABOVE_CHANCE = 1 / 15


def keep_identified(docs: DataFrame, model: Model, above_chance: float = ABOVE_CHANCE) -> DataFrame:
    """The rows of ``docs``, all their columns, whose language is told.

    Rejected are texts that are null or have no letter (score 0) and texts whose best language's mean
    posterior lies less than ``above_chance`` of the way from 1 / languages, which says nothing, to 1. The
    rule does not depend on how many languages were learned; with one, any letter will do. A model
    without languages rejects nothing.
    """
    ship_package(docs.sparkSession)
    if not model.languages:
        return docs
    chance = 1 / len(model.languages)
    least = max(chance + above_chance * (1 - chance), 1e-9) if len(model.languages) > 1 else 1e-9
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(freeing(_filter(shared, docs.columns.index("text"), least)), docs.schema)


def op10_language_id(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))
