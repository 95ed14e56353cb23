"""Words and n-grams of whole Arrow string columns as numpy arrays.

A word is a maximal run of digits, ASCII letters (lower-cased) and bytes
of non-ASCII characters, i.e. ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on the text
with A-Z lowered.  Words are compared by a 64-bit hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

U8, U64 = np.uint8, np.uint64
LOWER = np.arange(256, dtype=U8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True
#: The other kind of word: all but space, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[9:14] = NOT_BLANK[32] = False
#: Words beyond this many bytes are hashed one at a time.
LONG_WORD = 4096
FEW_BYTES = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=U64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), new array."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values (null: empty) and their n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, U8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, U8) if data is not None else np.zeros(0, U8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20):
    """Slices of a batch of about ``most_bytes`` of text (one row at least)."""
    i = batch.schema.get_field_index(column)
    _, offsets = string_bytes(batch.column(i))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes (eight more at the end), starts and sizes of all words,
    the runs of the bytes of ``kind``."""
    low = np.zeros(len(data) + 8, U8)
    low[:len(data)] = LOWER[data]
    inside = kind[low[:len(data)]]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # first bytes of values that have any
    before[edges] = False
    after[edges[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return low, starts, np.flatnonzero(inside & ~after) + 1 - starts


def span_hashes(low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``low``, which has eight bytes more."""
    eight = np.ndarray((len(low) - 7,), "<u8", low, 0, (1,))
    h = mix((eight[starts] & FEW_BYTES[np.minimum(sizes, 8)]) + sizes.astype(U64) * U64(0x9E3779B97F4A7C15))
    live, done = np.flatnonzero(sizes > 8), 8
    while len(live) and done < LONG_WORD:
        left = np.minimum(sizes[live] - done, 8)
        h[live] = mix(h[live] * U64(0x9E3779B97F4A7C15) + (eight[starts[live] + done] & FEW_BYTES[left]))
        done += 8
        live = live[sizes[live] > done]
    for i in live:  # rare: words of thousands of bytes
        rest = low[starts[i] + done:starts[i] + sizes[i]].tobytes()
        digest = hashlib.blake2b(rest, digest_size=8).digest()
        h[i] = mix(h[i:i + 1] + np.frombuffer(digest, "<u8"))[0]
    return h


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for the n values their n + 1 word offsets."""
    if len(data) == 0:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    low, starts, sizes = word_spans(data, offsets, kind)
    return span_hashes(low, starts, sizes), np.searchsorted(starts, offsets).astype(np.int64)


def ngrams(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words of every value, and their offsets.  A
    value of fewer than n words, but not none, has one: all its words."""
    count = np.diff(offsets)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out_offsets = np.concatenate([[0], np.cumsum(grams)]).astype(np.int64)
    total = int(out_offsets[-1])
    if total == 0:
        return np.zeros(0, U64), out_offsets
    at = np.repeat(offsets[:-1] - out_offsets[:-1], grams) + np.arange(total)
    padded = np.concatenate([hashes, np.zeros(n, U64)])
    last = np.repeat(offsets[1:], grams)
    h = np.zeros(total, U64)
    for k in range(n):
        h = h * U64(0x9E3779B97F4A7C15) + np.where(at + k < last, padded[at + k], U64(k + 1))
    return mix(h), out_offsets


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of a few texts, one array each."""
    h, offsets = words(*string_bytes(pa.array(texts, pa.string())))
    return [h[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
