"""Words, n-grams and token ids against plain Python."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from revtrail.llm.text import LONG_WORD, ngrams, parts, string_bytes, words
from revtrail.llm.tokens import ChunkEncoder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}
ALPHABET = list(" \n\t.'ab1É́ſ ,é’sT<|re\x00\x1c　日") + ["'re", "  ", "\r\n", "###"]


def texts(seed, n=800):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_words_are_told_apart_like_strings():
    sample = [None, "", *texts(1), "w" * (LONG_WORD + 9), "w" * (LONG_WORD + 10), "w" * (LONG_WORD + 9)]
    h, offsets = words(*string_bytes(pa.array(sample)))
    plain = [w for t in sample for w in WORD.findall((t or "").translate(LOW))]
    assert len(plain) == len(h)
    assert [b - a for a, b in zip(offsets, offsets[1:])] == [len(WORD.findall((t or "").translate(LOW))) for t in sample]
    assert len(set(plain)) == len(set(h.tolist())) == len(set(zip(plain, h.tolist())))


def test_ngrams():
    sample = [None, "a b", "a b c d e f", "b c d e f", "a b c d", "A, b"]
    h, offsets = words(*string_bytes(pa.array(sample)))
    g, at = ngrams(h, offsets, 5)
    sets = [set(g[a:b].tolist()) for a, b in zip(at, at[1:])]
    assert [len(s) for s in sets] == [0, 1, 2, 1, 1, 1]
    assert sets[2] >= sets[3] and sets[1] == sets[5] and not sets[4] & sets[2]


def test_parts_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100, None, "", "y" * 5000, "z"])], names=["text"])
    for most in (1, 150, 10**6):
        got = [t for p in parts(batch, "text", most) for t in p.column(0).to_pylist()]
        assert got == batch.column(0).to_pylist()


@pytest.mark.parametrize("name, words_only", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_chunked_ids_equal_the_librarys(name, words_only):
    enc = ChunkEncoder(public_tokenizers.path(name), words_only)
    plain = ["it's don't 'S x's,", "a   b\t\tc ", "x\n", "\nx", "end.\n\nNew", "foo_bar __ x_", "×÷ ÀÉß×a", "é.É.", "x" * 500 + " ab." * 90]
    for sample in (plain, texts(2), [None, "", " "], ["<|endoftext|> a<|endoftext|>b.c"], texts(3)):
        ids, offsets = enc.encode(pa.array(sample, pa.string()))
        for i, t in enumerate(sample):
            want = enc.tokenizer.encode(t or "", add_special_tokens=False).ids
            assert ids[offsets[i]:offsets[i + 1]].tolist() == want, repr(t)


def test_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr("revtrail.llm.tokens.MOST_CHUNKS", 3)
    enc = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), False)
    first, _ = enc.encode(pa.array(["one two three four five six"]))
    enc.encode(pa.array(["seven eight nine"]))
    assert len(enc.index) == 3
    again, _ = enc.encode(pa.array(["one two three four five six"]))
    assert np.array_equal(first, again)
