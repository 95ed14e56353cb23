"""Densified near duplicates (op11), source audit (op12) and vector codes (op13) against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from revtrail.llm import oph_dedup, source_audit, vector_codes

LOW = {i: i + 32 for i in range(65, 91)}


# ------------------------------------------------------------ near duplicates

def shingles(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1 if w else 0)))


def components_of(rows, share=(85, 100)):
    """(doc_id, n_shingles, component_id, kept) of every row, sorted."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and share[1] * len(x & y) >= share[0] * len(x | y):
            top[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    out = [(d, len(sets[i]), least.get(root(i)), d == least.get(root(i))) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=str)


def found_rows(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect()), key=str)


def near_copies(rng, sentence, families=10):
    """Families around the similarity: some members only hang together through others."""
    rows, i = [], 0
    for _ in range(families):
        words = sentence(rng, rng.randint(40, 200)).split(" ")
        for _ in range(rng.choice([1, 2, 6, 24])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(99)}"
            rows.append((i, " ".join(copy)))
            i += 1
            if rng.random() < 0.3:
                words = copy  # the family drifts
    return rows


@pytest.mark.parametrize("rounds, block", [(3, 256), (1, 3), (0, 5)])
def test_components_equal_brute_force(spark, docs_of, sentence, rounds, block):
    rows = near_copies(random.Random(11), sentence)
    found = oph_dedup.near_copies(docs_of(rows), rounds=rounds, block=block)
    assert found_rows(found) == components_of(rows)


def test_near_copies_of_odd_repeated_and_null_rows(spark, docs_of, odd_texts, sentence):
    rng = random.Random(3)
    base = sentence(rng, 60)
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(20, base), (20, base), (None, base), (21, base + " end"), (None, "alone now"), (None, None),
                                                       (30, "two words"), (31, "Two  WORDS"), (32, "two word"), (33, ""), (34, None)]
    assert found_rows(oph_dedup.near_copies(docs_of(rows))) == components_of(rows)


def test_near_copies_of_an_empty_table(spark, docs_of):
    out = oph_dedup.near_copies(docs_of([]))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0
    assert oph_dedup.near_copies(docs_of([(1, None), (2, "")])).count() == 2


def test_bands_reach_the_recall():
    bands = oph_dedup.bands_for(0.85, 0.99999)
    assert 1 - (1 - 0.85 ** oph_dedup.ROWS) ** bands >= 0.99999 > 1 - (1 - 0.85 ** oph_dedup.ROWS) ** (bands - 1)


def test_sketch_takes_the_least_of_a_bin_and_fills_empty_ones():
    rng, bins = np.random.default_rng(5), 12
    sets = [np.unique(rng.integers(0, 1 << 64, n, np.uint64)) for n in (1, 2, 5, 40, 400)]
    got, order = oph_dedup.sketches(sets, bins), oph_dedup.detours(bins)
    for s, row in zip(sets, got):
        least = {}
        for x in s.tolist():
            b = (x >> 32) * bins >> 32
            least[b] = min(x, least.get(b, x))
        for b in range(bins):
            assert int(row[b]) == least[next(int(j) for j in order[b] if int(j) in least)]


@pytest.mark.parametrize("size", [8, 40, 2000])
def test_equal_bins_estimate_the_similarity(size):
    rng, bins, same = np.random.default_rng(size), 150, []
    for _ in range(60):
        pool = rng.integers(0, 1 << 64, size + size // 4, np.uint64)
        a, b = np.unique(pool[:size]), np.unique(pool[size // 4:])
        x, y = oph_dedup.sketches([a, b], bins)
        same.append((x == y).mean())
    assert abs(np.mean(same) - (size - size // 4) / (size + size // 4)) < 0.06


def test_size_classes_never_part_a_possible_pair(spark):
    rows = [(a, b) for a in range(1, 400) for b in range(a, a * 100 // 85 + 1)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "a long, b long")
    far = df.filter(F.abs(oph_dedup.size_class(F.col("a"), (85, 100)) - oph_dedup.size_class(F.col("b"), (85, 100))) > 1)
    assert far.count() == 0


# --------------------------------------------------------------- source audit

def plain_audit(rows, least_docs, top, scale=1_000_000_000):
    """rows: (text, lang, source)."""
    docs = [(Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW))), lang or "", s or "") for t, lang, s in rows]
    out = []
    for lang in {x[1] for x in docs}:
        own = [(c, s) for c, x, s in docs if x == lang]
        seen = Counter(t for c, _ in own for t in c)
        kept = {t for t, n in seen.items() if n >= least_docs}
        groups = defaultdict(Counter)
        for c, s in own:
            groups[s].update({t: n for t, n in c.items() if t in kept})
        whole = sum(groups.values(), Counter())
        share = lambda c: {t: 1 + scale * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


AUDIT_SCHEMA = "doc_id long, text string, lang string, source string, term string, count string, p string, item string, part string"


def audit_frame(spark, rows):
    return spark.createDataFrame([(i, *r, *["x"] * 5) for i, r in enumerate(rows)], AUDIT_SCHEMA)


def audit_rows(frame):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in frame.collect())


def audited_texts(sentence):
    rng, rows = random.Random(12), []
    for i in range(60):
        text = sentence(rng, rng.randint(0, 60)) + rng.choice(["", " É́ Ωμέγα日本", " a1b-c_d'E", "\x00nul\x01"])
        rows.append((text, rng.choice(["en", "de", None]), rng.choice(["src1", "src1", "src1", "src2", "Ω", "z", None])))
    return rows + [(None, "en", "src9"), ("", "xx", "one"), ("", "xx", "two"), ("rare words only", "yy", None), ("", None, None)]


@pytest.mark.parametrize("held", [source_audit.MOST_HELD, 7])
def test_audit_equals_brute_force(spark, sentence, monkeypatch, held):
    monkeypatch.setattr(source_audit, "MOST_HELD", held)
    rows = audited_texts(sentence)
    found = source_audit.audit(audit_frame(spark, rows), least_docs=3, top=4)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert audit_rows(found) == plain_audit(rows, 3, 4)


def test_audit_of_repeated_rows_and_many_pairs(spark, sentence, monkeypatch):
    monkeypatch.setattr(source_audit, "MOST_PAIRS", 5)
    rows = audited_texts(sentence) * 2 + [("common word " * 3, "en", f"s{i}") for i in range(40)]
    assert audit_rows(source_audit.audit(audit_frame(spark, rows), least_docs=10)) == plain_audit(rows, 10, 10)


def test_audit_of_an_empty_table(spark):
    assert source_audit.audit(audit_frame(spark, [])).count() == 0


def test_audit_of_one_very_long_text(spark):
    rows = [("Long " * 200_000 + "w" * 100_000, "en", "a"), ("long", "en", "b"), (None, None, None)]
    assert audit_rows(source_audit.audit(audit_frame(spark, rows), least_docs=1)) == plain_audit(rows, 1, 10)


def test_translate_table_equals_the_pattern():
    text = "".join(map(chr, range(1, 700))) + "Ab1C é \u0085x"
    words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOW))
    assert source_audit.document_counts(text.encode()) == Counter(w.encode() for w in words)


# --------------------------------------------------------------- vector codes

def plain_nearest(v, book):
    return min((sum((x - y) ** 2 for x, y in zip(v, e)), i) for i, e in enumerate(book))


def plain_codes(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label) -> sorted (vec_id, code, error, label_error, sha)."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(r[1], p) for r in start] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for r in kept:
                of[plain_nearest(cut(r[1], p), books[p])[1]].append(cut(r[1], p))
            books[p] = [[sum(c) // len(of[i]) for c in zip(*of[i])] if of[i] else e for i, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    best = [[plain_nearest(cut(r[1], p), books[p]) for p in range(parts)] for r in kept]
    by_label = Counter()
    for r, b in zip(kept, best):
        by_label[r[2]] += sum(d for d, _ in b)
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in b), sum(d for d, _ in b), by_label[r[2]], sha) for r, b in zip(kept, best)), key=str)


def vector_frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, vector string, code string, error string, n string, part string"
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], schema)


def code_rows(frame):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in frame.collect()), key=str)


def vectors(rng, n, width, scale=1.0):
    """Vectors of single-precision numbers, some of them repeated."""
    made = [[float(np.float32(rng.gauss(0, scale))) for _ in range(width)] for _ in range(n)]
    return [rng.choice(made) if rng.random() < 0.2 else v for v in made]


@pytest.mark.parametrize("width, entries", [(16, 256), (12, 8), (4, 5), (28, 16)])
def test_codes_equal_brute_force(spark, width, entries):
    rng = random.Random(width)
    rows = [(i * 3 % 97, v, rng.choice([0, 1, None])) for i, v in enumerate(vectors(rng, 80, width))]
    found = vector_codes.compress(vector_frame(spark, rows), entries=entries)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert code_rows(found) == plain_codes(rows, 4, entries, 4)


def test_codes_drop_unusable_vectors(spark):
    rng = random.Random(1)
    rows = [(i, v, 0) for i, v in enumerate(vectors(rng, 12, 8))]
    bad = [(100, None, 1), (101, [float("nan")] * 8, 1), (102, [1.0] * 7 + [float("inf")], None), (103, [None] + [0.5] * 7, 1)]
    more = [(None, [0.25] * 8, None), (None, [-0.25] * 8, None), (3, [0.0] * 8, 2), (3, [0.0] * 8, 2)]
    rows = bad + rows + more
    assert code_rows(vector_codes.compress(vector_frame(spark, rows), entries=6)) == plain_codes(rows, 4, 6, 4)
    assert vector_codes.compress(vector_frame(spark, bad)).count() == 0
    assert vector_codes.compress(vector_frame(spark, [])).count() == 0


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, v, 0) for i, v in enumerate(vectors(rng, 30, 4, scale=1e5))]
    assert code_rows(vector_codes.compress(vector_frame(spark, rows), entries=4)) == plain_codes(rows, 4, 4, 4)


def test_vectors_that_fit_no_parts_are_refused(spark):
    with pytest.raises(ValueError):
        vector_codes.compress(vector_frame(spark, [(1, [0.5] * 6, 0)]))


def test_transform_is_in_sequency_order_and_keeps_distances():
    for width in (1, 3, 4, 11, 16):
        size, t = vector_codes.hadamard(width)
        full = vector_codes.hadamard(size)[1]
        assert size >= width > size // 2 or width == 1
        assert (np.abs(np.diff(full, axis=0)) // 2).sum(axis=0).tolist() == list(range(size))
        assert (t @ t.T == size * np.eye(width, dtype=int)).all()


@pytest.mark.parametrize("spread", [3, 1000, 1 << 40])
def test_nearest_entry_with_ties(spread):
    rng = random.Random(spread)
    v = np.array([[rng.randrange(-spread, spread) for _ in range(7)] for _ in range(300)], np.int64)
    e = np.concatenate([v[:40], v[:40], v[5:9] + 1])
    index, distance = vector_codes.nearest(v, e)
    for x, i, d in zip(v.tolist(), index.tolist(), distance.tolist()):
        assert (d, i) == plain_nearest(x, e.tolist())
