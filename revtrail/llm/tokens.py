"""Token ids of many texts by a ``tokenizers`` file, with a cache of chunks.

A text is cut where its pre-tokens surely part: at ASCII white space behind
a plain character, and between a letter and ASCII punctuation (not the
apostrophe, which starts contractions).  So the ids of a text are the ids of
its chunks in a row.  Cuts are found on the UTF-8 bytes of a whole Arrow
column; each distinct chunk is looked up once, and each Python worker keeps
the ids of the chunks it has seen.  That cache is emptied when it holds
``MOST_CHUNKS`` chunks or ``MOST_BYTES`` bytes, which bounds its memory.
"""

from __future__ import annotations

import itertools
import os
import sys
import types

import numpy as np

from .text import span_hashes, string_bytes

MOST_CHUNKS, MOST_BYTES = 1_000_000, 32_000_000
#: Byte classes.
OTHER, SPACE, LETTER, MARK, DIGIT = range(5)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[65:91] = CLASS[97:123] = LETTER
CLASS[48:58] = DIGIT
CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = MARK


def worker_state() -> dict:
    """A dict that lives as long as this Python worker does."""
    module = sys.modules.setdefault("_revtrail_worker_state", types.ModuleType("_revtrail_worker_state"))
    return module.__dict__


def shifted(x: np.ndarray, by: int, fill) -> np.ndarray:
    """x[i - by] at i (by > 0: what stands before)."""
    out = np.full_like(x, fill)
    if by > 0:
        out[by:] = x[:-by]
    else:
        out[:by] = x[-by:]
    return out


class ChunkEncoder:
    """Ids of texts; ``words_only`` for a tokenizer that drops white space
    and lowers letters (a chunk's key then has neither)."""

    def __init__(self, path: str, words_only: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.words_only = words_only
        self.clear()

    def clear(self):
        self.index: dict[bytes, int] = {}
        self.flat = np.zeros(0, self.dtype)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes = 0

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes (lowered for words_only; eight more at the end), starts and ends of the chunks."""
        n = len(data)
        low = np.zeros(n + 8, np.uint8)
        low[:n] = data
        kind = CLASS[data]
        latin = np.flatnonzero(data[:-1] == 0xC3)  # À to ÿ are letters but for × and ÷
        second = data[latin + 1]
        letters = latin[(second >= 0x80) & (second != 0x97) & (second != 0xB7)]
        kind[letters] = kind[letters + 1] = LETTER
        before = shifted(kind, 1, OTHER)
        space = kind == SPACE
        cut = space & (before >= LETTER)
        if self.words_only:
            cut |= (before == SPACE) & ~space
            capital = (data >= 65) & (data <= 90)
            low[:n][capital] += 32
            upper = letters[data[letters + 1] <= 0x9E] + 1
            low[upper] += 32
        else:
            newline = shifted(data == 10, 1, False) & (shifted(kind, 2, OTHER) >= LETTER)
            cut |= newline & (kind >= LETTER)
        if b"<|" not in data.tobytes():  # else a special token's string could be cut
            cut |= ((kind == MARK) & (before == LETTER)) | ((kind == LETTER) & (before == MARK))
        cut[offsets[:-1][offsets[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        if self.words_only:  # a chunk of white space has no ids; a space at the end is none either
            keep = ~space[starts]
            starts, ends = starts[keep], ends[keep]
        return low, starts, ends

    def learn(self, keys: list[bytes]) -> None:
        found = [x.ids for x in self.tokenizer.encode_batch_fast([k.decode() for k in keys], add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        start = len(self.flat) + np.cumsum(size) - size
        flat = np.fromiter(itertools.chain.from_iterable(found), self.dtype, int(size.sum()))
        self.index.update(zip(keys, range(len(self.start), len(self.start) + len(keys))))
        self.flat = np.concatenate([self.flat, flat])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.bytes += sum(map(len, keys))

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an Arrow string column in a row (null: none), and n + 1 offsets."""
        if len(self.index) > MOST_CHUNKS or self.bytes > MOST_BYTES:
            self.clear()
        data, offsets = string_bytes(column)
        if len(data) == 0:
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        low, starts, ends = self.spans(data, offsets)
        if len(starts) == 0:
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        first, which = distinct(low, starts, ends - starts)
        raw = low.tobytes()
        keys = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        index = self.index
        if unknown := [k for k in keys if k not in index]:
            self.learn(unknown)
        at = np.fromiter(map(index.__getitem__, keys), np.int64, len(keys))[which]
        size = self.size[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.start[at] - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(starts, offsets)]


def distinct(low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one chunk of each distinct kind (by 64-bit hash), and for every chunk its kind."""
    _, first, which = np.unique(span_hashes(low, starts, sizes), return_index=True, return_inverse=True)
    return first, which


def encoder(path: str, words_only: bool) -> ChunkEncoder:
    """This worker's encoder for the file."""
    state = worker_state()
    key = ("encoder", path, words_only)
    if key not in state:
        state[key] = ChunkEncoder(path, words_only)
    return state[key]
