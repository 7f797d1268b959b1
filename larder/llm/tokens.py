"""Token ids of whole texts by a vocabulary file of the tokenizers library.

A text is cut where the tokenizer's own rule for words always cuts: at white space, and between two ASCII
characters of which one is a digit or which are of different kind (letter, other).  Equal pieces, whatever their
ASCII case, have equal ids, so that each piece is encoded once per task and ids are gathered by numpy.  Texts in which
a special token, an apostrophe contraction or an unusual piece could reach over a cut are handled whole: pieces with an
apostrophe stay uncut, texts with "<|" are encoded directly.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from larder.llm.words import LOWER, SLICE_BYTES, U64, Words, raw, slices

KNOWN_PIECES = 1 << 19
SLOTS = 1 << 19
BATCH = 4096
# Kinds of bytes: 0 separator, 1 ASCII letter, 2 digit, 3 other ASCII, 4 part of a character beyond ASCII.
KIND = np.full(256, 3, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[65:91] = KIND[97:123] = 1
KIND[48:58] = 2
KIND[128:] = 4
KIND[:9] = KIND[14:32] = KIND[127] = 4  # controls: whether they are white space is left to the tokenizer


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker process, with the pieces it has learnt."""
    return Encoder(path)


class Encoder:
    """`ids(col)` yields, slice by slice, the ids of the texts of an Arrow column: (first text, counts, ids)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.key, self.at, self.count, self.pool = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        # A direct-mapped cache over the sorted keys: the piece that a slot was last used for.
        self.slot_key, self.slot_at, self.slot_count = np.zeros(SLOTS, U64), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        body, off = raw(col)
        for i, j in slices(off, SLICE_BYTES):
            part, at = body[off[i] : off[j]], off[i : j + 1] - off[i]
            yield i, *self._slice(part, at)

    def _slice(self, body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        odd = {}
        if b"<|" in body.tobytes():
            for k in range(len(off) - 1):
                one = body[off[k] : off[k + 1]].tobytes()
                if b"<|" in one:
                    odd[k] = self.whole(one.decode())
        pieces = Pieces(body, off)
        start, count = self._look_up(pieces)
        total = int(count.sum())
        begin = np.cumsum(count) - count
        flat = self.pool[np.repeat(start - begin, count) + np.arange(total)]
        ends = np.append(0, np.cumsum(count))
        bounds = ends[pieces.first]
        if not odd:
            return np.diff(bounds), flat
        parts = [odd.get(k, flat[bounds[k] : bounds[k + 1]]) for k in range(len(off) - 1)]
        return np.array([len(p) for p in parts], np.int64), np.concatenate(parts)

    def _look_up(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's ids start in the pool, and their count."""
        if len(self.key) > KNOWN_PIECES or len(self.pool) > 1 << 30:
            self._forget()
        h = pieces.hashes(lower=True)
        h[h == 0] = 1  # 0 is an empty slot
        slot = (h & U64(SLOTS - 1)).astype(np.int32)
        start, count = self.slot_at[slot], self.slot_count[slot]
        miss = np.flatnonzero(self.slot_key[slot] != h)
        if len(miss):
            key, place, back = np.unique(h[miss], return_index=True, return_inverse=True)
            self._learn(pieces, key, miss[place])
            at = np.searchsorted(self.key, key)
            start[miss], count[miss] = self.at[at][back], self.count[at][back]
            used = slot[miss[place]]
            self.slot_key[used], self.slot_at[used], self.slot_count[used] = key, self.at[at], self.count[at]
        return start, count

    def _learn(self, pieces: Pieces, key: np.ndarray, place: np.ndarray) -> None:
        """Encode those of the sorted keys that are new; place: a piece of each."""
        at = np.searchsorted(self.key, key)
        new = at == len(self.key)
        new[~new] = self.key[at[~new]] != key[~new]
        if not new.any():
            return
        low = LOWER[pieces.body].tobytes()
        text = [low[s:e].decode() for s, e in zip(pieces.start[place[new]].tolist(), pieces.end[place[new]].tolist(), strict=True)]
        ids, count = self._encode(text)
        begin = np.cumsum(count) - count + len(self.pool)
        self.pool = np.concatenate([self.pool, ids])
        self.key = np.insert(self.key, at[new], key[new])
        self.at = np.insert(self.at, at[new], begin)
        self.count = np.insert(self.count, at[new], count)

    def _encode(self, text: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and their counts; texts are joined by spaces, at which the tokenizer cuts."""
        ids, counts = [], []
        for i in range(0, len(text), BATCH):
            part = text[i : i + BATCH]
            size = np.array([len(t) for t in part], np.int64)
            begin = np.cumsum(size + 1) - size - 1
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids.append(np.array(got.ids, np.uint32))
            if len(got.ids):
                owner = np.searchsorted(begin, np.array(got.offsets, np.int64)[:, 0], "right") - 1
                counts.append(np.bincount(owner, minlength=len(part)))
            else:
                counts.append(np.zeros(len(part), np.int64))
        return np.concatenate(ids), np.concatenate(counts)


class Pieces(Words):
    """Words cut further between ASCII characters of different kind."""

    def __init__(self, body: np.ndarray, off: np.ndarray):
        kind = KIND[body]
        left, right = kind[:-1], kind[1:]
        cut = np.zeros(len(body), bool)
        cut[1:] = ((left != right) | (left == 2)) & (left < 4) & (right < 4)
        if (body == 39).any():
            words = Words(body, off)
            quoted = np.zeros(len(words.start), bool)
            quoted[np.searchsorted(words.start, np.flatnonzero(body == 39), "right") - 1] = True
            for s, e in zip(words.start[quoted].tolist(), words.end[quoted].tolist(), strict=True):
                cut[s + 1 : e] = False
        super().__init__(body, off, kind > 0, cut)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
