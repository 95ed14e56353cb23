"""Packing (op3), exact duplicates (op5) and the token store (op7)."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from revtrail.llm.exact_dedup import drop_copies, exact_groups
from revtrail.llm.packing import best_two_fit, pack, pack_documents, pattern_runs, sequences, token_pieces
from revtrail.llm.scratch import folder, written
from revtrail.llm.token_store import pack_values, read_tokens, round_trip, store_tokens, unpack_values

WORD_BPE, BYTE_BPE = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.mark.parametrize("seed", range(8))
def test_patterns_use_up_all_counts(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 300])
    counts = {}
    for _ in range(rng.choice([3, 60, 2000])):
        x = min(capacity, 1 + int(rng.expovariate(4 / capacity)))
        counts[x] = counts.get(x, 0) + 1
    plan = best_two_fit(counts, capacity)
    used = {}
    for times, taken in plan:
        assert times > 0 and sum(x * k for x, k in taken.items()) <= capacity
        for x, k in taken.items():
            used[x] = used.get(x, 0) + times * k
    assert used == counts
    bins, total = sum(t for t, _ in plan), sum(x * k for x, k in counts.items())
    assert bins <= 1.25 * -(-total // capacity) + 1


def test_smallest_is_replaced_by_two_that_fit_more_tightly():
    # 6 + 3 leaves a gap of 1; the 3 gives way to 2 + 2, which fill the sequence
    assert best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == (1, {6: 1, 2: 2})


def test_plan_size_follows_the_lengths_not_the_pieces():
    counts = {x: 10**9 + x for x in range(1, 2049)}
    plan = best_two_fit(counts, 2048)
    assert len(plan) < 3 * 2048
    total = sum(x * n for x, n in counts.items())
    assert sum(t for t, _ in plan) <= 1.001 * total / 2048
    assert len(pattern_runs(plan)) < 10 * 2048


def pieces_of(rows, capacity):
    t = Tokenizer.from_file(WORD_BPE)
    out = {}
    for doc_id, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            out[doc_id, k] = (at, len(ids[at:at + capacity]), zlib.crc32(ids[at:at + capacity].tobytes()))
    return out


def test_packed_documents(spark, docs_of, sentence, odd_texts):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(i, sentence(rng, rng.choice([3, 40, 200, 900]))) for i in range(20, 120)]
    got = pack_documents(docs_of(rows), WORD_BPE, 0, 256).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == pieces_of(rows, 256)
    assert len(got) == len({(r.doc_id, r.piece) for r in got})
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 256
    assert len(by) <= 1.02 * -(-sum(r.length for r in got) // 256) + 1


def test_sequences_hold_their_pieces(spark, docs_of, sentence):
    rng = random.Random(4)
    docs = docs_of([(i, sentence(rng, rng.randint(1, 90))) for i in range(40)] + [(None, "a b"), (7, "a b"), (7, "a b")])
    pieces = written(token_pieces(docs, WORD_BPE, 0, 64, with_ids=True), "test")
    packed = written(pack(pieces, 64), "test")
    ids = {r.sequence_id: bytes(r.ids) for r in sequences(packed).collect()}
    rows = packed.collect()
    assert len(rows) == pieces.count()
    for r in rows:
        assert ids[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_packing_nothing(docs_of):
    assert pack_documents(docs_of([]), WORD_BPE).collect() == []


def test_pieces_are_packed_twice(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 5, 7), (2, 0, 0, 3, 8)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    first, second = pack(pieces, 8), pack(pieces, 8)
    assert first.columns == second.columns == [*pieces.columns, "sequence_id", "offset"]
    assert sorted(first.collect()) == sorted(second.collect()) and pieces.columns[-1] == "ids_crc32"


@pytest.mark.parametrize("ids", [[1, 2, 3, 4], [1, 1, None, 4]])
def test_filters_keep_columns_with_dots(spark, ids):
    from revtrail.llm.decontam import drop_contaminated
    from revtrail.llm.ngram_join import drop_near_duplicates
    words = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(3)]
    rows = [(i, t, "a", "b", "c") for i, t in zip(ids, [words[0], words[0], words[1], words[2]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, `c``d` string, of string")
    items = spark.createDataFrame([("i", words[2])], "item_id string, text string")
    for drop, left in ((drop_copies, words), (drop_near_duplicates, words), (lambda d: drop_contaminated(d, items), [words[0], words[0], words[1]])):
        out = drop(docs)
        assert out.columns == docs.columns and sorted(r.text for r in out.collect()) == sorted(left)


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_groups(docs_of, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    rows += [(30, "a b c"), (31, "abc"), (32, "a\x0b\x0cb\r\nc "), (33, "abd"), (34, "a  b c"), (35, "a b  c"), (36, " abc"),
             (40, "long " * 29999 + "long! "), (41, "wor d"), (50, "p" * 300 + "1"), (51, "p" * 300 + "2"), (52, "p" * 300 + " 1")]
    got = {r.doc_id: r for r in exact_groups(docs_of(rows), with_digest=True).collect()}
    groups = {}
    for d, t in rows:
        groups.setdefault(bare(t), []).append((-len(t or ""), d))
    assert len(got) == len(rows)
    for d, t in rows:
        own = groups[bare(t)]
        r = got[d]
        assert (r.keep_id, r.group_size, r.kept) == (min(own)[1], len(own), min(own)[1] == d)
        assert r.text_sha256 == hashlib.sha256(bare(t).encode()).hexdigest()
    kept = drop_copies(docs_of(rows))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(min(g)[1] for g in groups.values())
    assert kept.columns == docs_of([]).columns


def test_copies_with_repeated_and_null_ids(docs_of):
    def kept(rows):
        return sorted(((r.doc_id, r.text) for r in drop_copies(docs_of(rows)).collect()), key=str)
    assert kept([(1, "a"), (None, "a"), (None, "b")]) == [(1, "a"), (None, "b")]
    assert kept([(1, "a"), (1, "a"), (2, "c"), (2, "d"), (3, "c ")]) == [(1, "a"), (2, "d"), (3, "c ")]
    assert kept([(None, "a"), (None, "a"), (None, None), (5, "")]) == [(5, ""), (None, "a")]
    assert kept([]) == []


def test_exact_groups_of_repeated_and_null_ids(docs_of):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (2, "c"), (2, "d")]
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(docs_of(rows)).collect()), key=str)
    assert got == sorted([(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True),
                          (2, 2, 1, True), (2, 2, 1, True)], key=str)
    assert exact_groups(docs_of([])).collect() == []


def test_byte_aligned_values():
    rng = np.random.default_rng(1)
    edges = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    for v in (edges, rng.integers(0, 2**32, 1001, np.uint32) >> rng.integers(0, 32, 1001, np.uint32), edges[:0], edges[:3]):
        control, data = pack_values(v)
        assert len(control) == -(-len(v) // 4)
        assert len(data) == sum(max(1, -(-int(x).bit_length() // 8)) for x in v)
        assert np.array_equal(unpack_values(control, data, len(v)), v)


def test_token_store_round_trip(spark, docs_of, sentence, odd_texts):
    rng = random.Random(5)
    rows = [(i * 3 - 7, t) for i, t in enumerate(odd_texts)] + [(i, sentence(rng, rng.randint(0, 300))) for i in range(100, 160)]
    rng.shuffle(rows)
    path = folder(spark, "test-tokens")
    store_tokens(docs_of(rows).repartition(5), path, BYTE_BPE, 2, block_tokens=500)
    got = sorted(read_tokens(spark, path).collect(), key=lambda r: r.doc_id)
    t = Tokenizer.from_file(BYTE_BPE)
    start = 0
    for (d, text), r in zip(sorted(rows), got, strict=True):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (d, start, len(ids) // 4, zlib.crc32(ids), ids)
        start += len(ids) // 4
    # as frequency ranks, most ids take one byte
    blocks = spark.read.parquet(path).collect()
    assert len(blocks) > 5 and sum(len(b.data) for b in blocks) < 1.5 * sum(b.n_tokens for b in blocks)


def test_token_store_of_repeated_null_and_no_rows(docs_of):
    got = round_trip(docs_of([(1, "a"), (1, "a"), (None, "b"), (None, None)]), BYTE_BPE, 2).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, None, 1, 1]
    assert round_trip(docs_of([]), BYTE_BPE, 2).collect() == []
