"""Token ids of whole texts by the tokenizers library, at the speed of a dictionary.

The word tokenizer drops white space and never joins across it, so the ids of a text are the ids of its white-space
separated pieces one after another. Each task keeps the ids of pieces it has met (bounded: ``CACHE`` pieces) and asks the
library once for all new ones of a batch. ASCII letters are lower-cased first, as the tokenizer does itself; a full stop
or comma behind an ASCII letter or digit and before white space is a piece of its own to the tokenizer, so it is cut off.
New pieces of plain lower-case letters go to the same vocabulary without its normaliser and splitter, which leave them be.
Texts that hold ``<|`` (special tokens begin so) go to the library whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from .common import ranges, text_bytes, worker_memory

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

CACHE = 800_000
PLAIN = re.compile("[a-zß-öø-ÿ]+")  # letters that the tokenizer's normaliser and splitter leave as they are
ALNUM, SPACE, POINT = (np.isin(np.arange(256), list(x)) for x in (b"abcdefghijklmnopqrstuvwxyz0123456789", b" \t\n\x0b\x0c\r", b".,"))
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


class WordEncoder:
    """Encodes batches; one per process and tokenizer file (see ``encoder``)."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.clear()

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 20, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.used = 0

    def _add(self, pieces: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros(max(len(ids), len(self.flat)), np.int32))
        self.flat[self.used : self.used + len(ids)] = ids
        self.known.update(zip(pieces, range(len(self.starts), len(self.starts) + len(pieces)), strict=True))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used += len(ids)

    def _learn(self, pieces: set[bytes]) -> None:
        words = {p: p.decode() for p in pieces}
        easy = [p for p, w in words.items() if PLAIN.fullmatch(w)]
        other = list(pieces.difference(easy))
        for library, part in ((self.plain, easy), (self.library, other)):
            ids = [e.ids for e in library.encode_batch_fast([words[p] for p in part], add_special_tokens=False)]
            self._add(part, np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and the number of each text's ids. Null counts as empty."""
        raw, ends = text_bytes(col)
        whole = raw.tobytes()
        special = {}
        if b"<|" in whole:
            special = {i: self._ids(whole[ends[i] : ends[i + 1]].decode()) for i in range(len(col)) if b"<|" in whole[ends[i] : ends[i + 1]]}
        whole, ends = _spaced(raw, ends)
        words = [[] if i in special else whole[a:b].split() for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))]
        if len(self.known) > CACHE:
            self.clear()
        all_words = list(chain.from_iterable(words))
        at = np.fromiter(map(self.known.get, all_words, repeat(-1)), np.int64, len(all_words))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._learn({all_words[i] for i in new})
            at[new] = [self.known[all_words[i]] for i in new]
        lengths = self.lengths[at]
        ids = self.flat[ranges(self.starts[at], lengths)]
        per_text = np.array([len(w) for w in words], np.int64)
        border = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(per_text)])]
        counts = np.diff(border)
        if special:
            parts = [np.array(special[i], np.int32) if i in special else ids[border[i] : border[i + 1]] for i in range(len(words))]
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, counts


def _spaced(raw: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """ASCII letters lower-cased, and a space before each full stop or comma between an ASCII letter or digit and white
    space or the text's end; with the new borders."""
    low = LOWER[raw]
    if len(low) < 2:
        return low.tobytes(), ends
    at = np.flatnonzero(POINT[low[1:]] & ALNUM[low[:-1]]) + 1
    starts = np.isin(at, ends[:-1])  # the byte before belongs to another text
    closes = np.isin(at + 1, ends[1:]) | SPACE[low[np.minimum(at + 1, len(low) - 1)]]
    at = at[closes & ~starts]
    return np.insert(low, at, 32).tobytes(), ends + np.searchsorted(at, ends, "left")


def encoder(path: str) -> WordEncoder:
    kept = worker_memory("tokens")
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` behind each text's."""
    return np.insert(ids, np.cumsum(counts), end).astype(np.int32), counts + 1
