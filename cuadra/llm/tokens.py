"""Token ids of whole texts, encoded word by word.

Both tokenizers cut a text into words before any merge, and no word of theirs reaches over the end of
a run of visible characters. So a text can be cut there, each distinct piece encoded once by the
tokenizers library, and the ids put together again. Natural text repeats its words, which saves most
of the work. Texts where this could differ (special tokens written out, separators that the libraries
see differently) are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A worker remembers the ids of up to twice so many pieces; the ids do not depend on it.
CACHE_PIECES = 700_000
# So many of them stay when a task is over. The worker lives on, idle or in other stages, and its memory is the executor's.
KEPT_PIECES = 150_000

_SEPARATORS = "\x1c\x1d\x1e\x1f"
_SPACED = re.compile(r"\s*\S+|\s+")
# Latin letters with at most one space before and ASCII punctuation behind, without the apostrophe,
# which may belong to a contraction. Every other piece goes through the whole tokenizer.
_WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def words(text: str) -> list[str]:
    """Pieces for tokenizers that drop white space."""
    return text.split()


def spaced(text: str) -> list[str]:
    """Pieces for byte-level tokenizers: a run of visible characters with the white space before it."""
    return _SPACED.findall(text)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Known(dict):
    """Piece to ids. A missing piece is encoded by the library; seldom used ones are forgotten."""

    def __init__(self, tokenizer, lower: bool):
        super().__init__()
        self.tokenizer, self.lower, self.older = tokenizer, lower, {}
        self.model, self.letters = tokenizer.model, _byte_letters()
        self.space = self.letters[32]

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encoded(piece)
        if len(self) >= CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def trim(self, most: int = KEPT_PIECES) -> None:
        """Forget all but ``most`` pieces, those met first: frequent words come early."""
        if len(self) + len(self.older) > most:
            kept = dict(islice(chain(self.items(), self.older.items()), most))
            self.older = {}
            self.clear()
            self.update(kept)

    def encoded(self, piece: str) -> bytes:
        """The ids of one piece; only the word inside it is remembered."""
        word = _WORD.fullmatch(piece)
        if word is None:
            return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if word[2]:
            return self[word[1]] + self[word[2]]
        # What the tokenizer's own steps before its model do to such a word.
        if self.lower:
            piece = piece.lower()
        letters = piece.replace(" ", self.space) if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()


class Encoder:
    """Text to little-endian unsigned 32-bit ids.

    ``pieces`` is ``words`` for a vocabulary that lower-cases and drops white space, ``spaced`` for a
    byte-level one.
    """

    def __init__(self, path: str, pieces: Callable[[str], list[str]]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.pieces = Tokenizer.from_file(path), pieces
        self.known = _Known(self.tokenizer, lower=pieces is words)

    def encode(self, text: str) -> bytes:
        if "<|" in text or any(c in text for c in _SEPARATORS):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.known.__getitem__, self.pieces(text)))


class WordIds:
    """Ids of many texts at once, for a vocabulary of ``words``.

    A batch is cut into words by array work, each distinct word is looked up in an array of known words
    and only new ones go through the encoder one by one. The ids do not depend on what is known.
    """

    def __init__(self, encoder: Encoder, most: int = CACHE_PIECES):
        self.encoder, self.most = encoder, most
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _numbers(self, distinct: pa.Array) -> np.ndarray:
        """The places of some words among the known ones; new ones are added."""
        if len(self.known) + len(distinct) > self.most:
            self._forget()
        places = pc.index_in(distinct, value_set=self.known)
        if places.null_count:
            new = distinct.filter(places.is_null())
            coded = [self.encoder.known.encoded(w) if w else b"" for w in new.to_pylist()]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(coded), "<u4")])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            added = np.cumsum(places.is_null().to_numpy(zero_copy_only=False)) - 1 + len(self.known)
            self.known = pa.concat_arrays([self.known, new])
            return np.where(places.is_null().to_numpy(zero_copy_only=False), added, places.fill_null(0).to_numpy())
        return places.to_numpy()

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        whole = pc.match_substring_regex(texts, f"<\\||[{_SEPARATORS}]").to_numpy(zero_copy_only=False)
        cut = pc.utf8_split_whitespace(pc.if_else(pa.array(whole), pa.scalar(""), texts) if whole.any() else texts)
        words = cut.values.dictionary_encode()
        number = self._numbers(words.dictionary)[words.indices.to_numpy()]
        first = self.ends[number]
        count = self.ends[number + 1] - first
        ends = np.cumsum(count)
        out = self.ids[np.repeat(first - (ends - count), count) + np.arange(int(count.sum()))]
        edges = np.append(0, ends)[cut.offsets.to_numpy()]
        runs = [out[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        for i in np.flatnonzero(whole):
            runs[i] = np.frombuffer(self.encoder.encode(texts[int(i)].as_py()), "<u4")
        return runs


@lru_cache(maxsize=2)
def shared_encoder(path: str, pieces: Callable[[str], list[str]]) -> Encoder:
    """One encoder for all tasks of a Python worker, so that a task starts with the pieces of earlier ones."""
    return Encoder(path, pieces)


@lru_cache(maxsize=2)
def shared_words(path: str) -> WordIds:
    """The same for batches of texts."""
    return WordIds(shared_encoder(path, words))
