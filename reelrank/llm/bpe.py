"""Byte-level BPE ids of whole texts through ``tokenizers``, with a cache per distinct piece.

The byte-level pre-tokenizer never joins characters across a space that stands between two
non-space characters, so a text may be cut before each such space and the ids of the pieces put
together. Pieces (words with their punctuation) repeat often; each distinct one is encoded by the
library once per worker and kept, in a bounded cache, as little-endian 32-bit ids. Texts in which
two spaces stand in one run of white space are encoded whole. Special strings in a text are
handled as the library's default does.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import islice

import numpy as np

LIMIT = 400_000
#: Pieces that stay from one task to the next.
LASTING = 100_000
#: Pieces that are encoded in one call of the library.
ROW = 256
KEEP = 100
_RUN = re.compile(r" \s* ")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def version(path: str | None = None) -> str:
    """Digest of the tokenizer's file and the library's version."""
    import tokenizers

    with open(path or default_path(), "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


class Encoder:
    """ids_bytes(texts): the ids of each text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str | None = None, limit: int = LIMIT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path or default_path())
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._limit = limit
        vocabulary = self._tokenizer.get_vocab()
        self._spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if "\u0120" in token]] = True  # how a space is written
        self._inner: dict[str, bytes] = {}  # ids of " " + piece

    def trim(self) -> None:
        """Keep the pieces met first, the frequent ones among them, for the worker's next task."""
        if len(self._inner) > LASTING:
            self._inner = dict(islice(self._inner.items(), LASTING))

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of " " + piece for each piece.

        Pieces that neither begin nor end with white space are encoded in long rows: each then
        begins with the row's next token that holds a space.
        """
        plain = [p for p in pieces if p and not (p[0].isspace() or p[-1].isspace())]
        out: dict[str, bytes] = {}
        rows = [plain[i:i + ROW] for i in range(0, len(plain), ROW)]
        for row, ids in zip(rows, self._encode([" " + " ".join(r) for r in rows])):
            starts = np.flatnonzero(self._spaced[np.frombuffer(ids, "<u4")]) * 4
            if len(starts) == len(row):
                ends = [*starts[1:].tolist(), len(ids)]
                out.update(zip(row, map(ids.__getitem__, map(slice, starts.tolist(), ends))))
        rest = [p for p in pieces if p not in out]
        out.update(zip(rest, self._encode([" " + p for p in rest])))
        return out

    def ids_bytes(self, texts: list[str]) -> list[bytes]:
        whole = {i for i, t in enumerate(texts) if _RUN.search(t)}
        cut = [[] if i in whole else t.split(" ") for i, t in enumerate(texts)]
        inner = self._inner
        if len(inner) > self._limit:
            self.trim()
            inner = self._inner
        new = list(set().union(*(p[1:] for p in cut)).difference(inner))
        long = [p for p in new if len(p) > KEEP]
        inner.update(self._encode_pieces(new))
        firsts = iter(self._encode([texts[i] if i in whole else p[0] for i, p in enumerate(cut)]))
        get = inner.__getitem__
        out = [next(firsts) + b"".join(map(get, p[1:])) for p in cut]
        for p in long:
            del inner[p]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for ``path``; its cache outlives the task."""
    key = path or default_path()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(key)
    return _ENCODERS[key]
