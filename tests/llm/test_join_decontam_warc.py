"""N-gram join (op2), decontamination (op6) and WARC (op9) against brute force."""

import base64
import hashlib
import itertools
import random
import re

import pytest

from revtrail.llm import decontam, ngram_join, warc
from revtrail.llm.components import components
from revtrail.llm.scratch import folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return WORD.findall((text or "").translate(LOW))


def grams(text, n=5):
    w = tokens(text)
    return frozenset(tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1 if w else 0)))


def brute_force(rows, similarity=0.8):
    sets = {d: grams(t) for d, t in rows}
    links, root = {d: 0 for d in sets}, {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= similarity * len(x | y) - 1e-9:
            links[a] += 1
            links[b] += 1
            p, q = sorted((top(a), top(b)))
            root[q] = p
    return {d: (top(d), links[d]) for d in sets}


def near_copies(rng, sentence):
    rows, i = [], 0
    for _ in range(14):
        base = sentence(rng, rng.randint(30, 160)).split(" ")
        for _ in range(rng.choice([1, 2, 5, 30])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(99)}"
            rows.append((i, " ".join(copy)))
            i += 1
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_every_link_between_texts_is_found(docs_of, sentence, odd_texts, block):
    rows = near_copies(random.Random(6), sentence)
    rows += [(1000 + i, t) for i, t in enumerate(odd_texts * 2)] + [(2000, "one two"), (2001, "ONE, two!"), (2002, "one two three")]
    got = {r.doc_id: r for r in ngram_join.near_duplicates(docs_of(rows), block=block).collect()}
    want = brute_force(rows)
    assert {d: (r.class_id, r.n_links) for d, r in got.items()} == want
    assert sum(n > 0 for _, n in want.values()) > 50
    assert got[2001].text_class == 2000


def test_join_of_repeated_null_and_no_rows(docs_of):
    got = ngram_join.near_duplicates(docs_of([(1, "a b"), (1, "a b"), (None, "a b"), (None, None)])).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == [
        ("1", "1", 2), ("1", "1", 2), ("None", "1", 2), ("None", "None", 0)]
    assert ngram_join.near_duplicates(docs_of([])).collect() == []


def test_one_document_of_each_group_stays(docs_of, sentence):
    rows = near_copies(random.Random(7), sentence)
    docs = docs_of(rows)
    kept = ngram_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in brute_force(rows).values()})


def test_near_duplicates_with_repeated_and_null_ids(docs_of, sentence):
    rng = random.Random(8)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    near = a + " more"
    rows = [(7, a), (None, near), (None, b), (7, c), (7, c), (None, None), (None, None)]
    kept = ngram_join.drop_near_duplicates(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(7, a), (None, b), (7, c), (None, None), (None, None)], key=str)
    assert ngram_join.drop_near_duplicates(docs_of([])).collect() == []


def test_contaminated_rows_with_repeated_and_null_ids(spark, docs_of):
    items = spark.createDataFrame([("i", "alpha beta gamma")], "item_id string, text string")
    rows = [(None, "x alpha beta gamma"), (None, "clean"), (1, "alpha beta gamma"), (1, "alpha"), (1, "alpha"), (2, None)]
    kept = decontam.drop_contaminated(docs_of(rows), items).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(None, "clean"), (1, "alpha"), (1, "alpha"), (2, None)], key=str)


def test_bands_reach_the_recall():
    for similarity, recall in ((0.8, 0.9995), (0.5, 0.9), (0.95, 0.99)):
        bands, rows = ngram_join.choose_bands(similarity, recall)
        assert 1 - (1 - similarity ** rows) ** bands >= recall and bands * rows <= ngram_join.MOST_HASHES


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((top(a), top(b)))
            root[q] = p
    assert got == {x: top(x) for x in root}


def contamination(rows, items, window):
    out = {}
    for d, text in rows:
        w, hit, found = tokens(text), set(), set()
        for item, t in items:
            if item is None:
                continue
            x = tokens(t)
            n = min(window, len(x))
            for k in range(len(x) - n + 1 if x else 0):
                for a in range(len(w) - n + 1):
                    if w[a:a + n] == x[k:k + n]:
                        hit.update(range(a, a + n))
                        found.add(str(item))
        out[d] = (len(w), len(hit), sorted(found))
    return out


@pytest.fixture()
def leaks(sentence, odd_texts):
    rng = random.Random(9)
    items = [(i, sentence(rng, rng.choice([4, 10, 25]))) for i in range(20)]
    items += [(20, None), (21, ""), (22, "river"), (None, "the the"), (5, "silver copper letter"), (6, items[7][1])]
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    for i in range(20, 90):
        text = sentence(rng, rng.randint(0, 120))
        for _ in range(rng.choice([0, 0, 1, 2])):
            x = rng.choice(items)[1] or ""
            w = x.split(" ")
            a = rng.randrange(len(w))
            text += " " + " ".join(w[a:a + rng.choice([3, 9, 10, 12, 30])]).upper() + "! " + sentence(rng, rng.randint(0, 9))
        rows.append((i, text))
    return rows, items


@pytest.mark.parametrize("window, chunk", [(10, 1 << 20), (3, 200)])
def test_exact_phrases(spark, docs_of, leaks, window, chunk):
    rows, items = leaks
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.matches(docs_of(rows).repartition(3), benchmark, window, chunk_chars=chunk)
    got = {r.doc_id: (r.n_words, r.n, sorted({s.item_id for s in r.spans})) for r in
           found.withColumn("n", decontam.covered(found["spans"])).collect()}
    assert got == contamination(rows, items, window)
    if window == 10:
        kept = decontam.drop_contaminated(docs_of(rows), benchmark)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, x in got.items() if not x[1])
        assert kept.columns == docs_of([]).columns


def test_proximity(spark, docs_of):
    items = spark.createDataFrame([("i", "alpha beta gamma delta")], "item_id string, text string")
    far = "x " * 20
    rows = [(1, "alpha beta gamma delta"), (2, "gamma y alpha delta beta"), (3, f"alpha {far} beta gamma delta"), (4, "alpha beta gamma")]
    got = {r.doc_id: r.near for r in decontam.matches(docs_of(rows), items, 10, slack=2).collect()}
    assert got == {1: ["i"], 2: ["i"], 3: [], 4: []}
    # the reach follows the slack, and still ends with the document
    apart = [(1, "alpha " + "x " * 150 + "beta gamma delta"), (2, "alpha"), (3, "beta gamma delta"), (4, "alpha " + "x " * 400 + "beta gamma delta")]
    got = {r.doc_id: r.near for r in decontam.matches(docs_of(apart), items, 10, slack=200).collect()}
    assert got == {1: ["i"], 2: [], 3: [], 4: []}


def test_chunks_of_items_are_searched_one_by_one(spark, docs_of, sentence):
    rng = random.Random(6)
    texts = [sentence(rng, 30) for _ in range(12)]
    items = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(texts)], "item_id string, text string")
    docs = docs_of([(k, sentence(rng, 20) + " " + texts[k % 12][:90] + " " + texts[(k * 5) % 12]) for k in range(30)])
    key = lambda r: (r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.n_near_items)
    found = [sorted(key(r) for r in decontam.contamination(docs, items, 10, slack=2).collect())]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    whole = decontam.matches(docs, items, 10, slack=2, chunk_chars=200)
    spans = {r.doc_id: sorted((s.item_id, s.start, s.length) for s in r.spans) for r in whole.collect()}
    one = {r.doc_id: sorted((s.item_id, s.start, s.length) for s in r.spans) for r in decontam.matches(docs, items, 10, slack=2).collect()}
    assert spans == one and any(spans.values()) and len(found[0]) == 30


def test_decontamination_of_nothing(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(docs_of([]), none).collect() == []
    got = decontam.contamination(docs_of([(1, "a b"), (1, "a b"), (None, None)]), none).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.contaminated) for r in got) == [
        ("1", 2, 0, False), ("1", 2, 0, False), ("None", 0, 0, False)]


PAGES = "page_id long, url string, html string, digest string, bytes string, revisit string, stands string, n string"


def page_rows(pages):
    return [(p, u, h, *["x"] * 5) for p, u, h in pages]


def test_warc_round_trip(spark):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    pages = [(i, f"http://a/{i}", f"<p>{i % 7}</p>" + "é" * (i % 3)) for i in range(60)]
    pages += [(100, None, None), (101, "u\r\nWARC-Type: x", ""), (102, "u", fake), (103, "u", "x" + fake * 3), (104, "u", fake),
              (105, "u", "y" * 300000), (106, "u", "\r\n\r\n"), (107, "u", "tail\r\n\r\nWARC/1.0\r\n")]
    path = folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(page_rows(pages), PAGES).repartition(2), path, records_per_file=20)
    found = warc.candidates(spark, path)
    assert found.count() > len(pages)
    stands = {}
    for p, _, h in pages:
        stands[h or ""] = max(stands.get(h or "", p), p)
    want = {}
    for p, _, h in pages:
        raw = (h or "").encode()
        own = stands[h or ""] == p
        want[p] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", None if own else stands[h or ""])
    rows = warc.read_archives(spark, path).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows} == want
    assert len(rows) == len(pages) and all(r.intact for r in rows)


def test_warc_least_bytes_repeated_null_and_no_rows(spark):
    pages = spark.createDataFrame(page_rows([(1, "u", "ab"), (2, "u", "ab"), (2, "u", "ab"), (None, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), PAGES)
    def got(least):
        rows = warc.round_trip(pages, least_bytes=least).collect()
        return sorted((str(r.page_id), r.record_type, r.refers_to) for r in rows)
    assert got(0) == [("1", "revisit", 2), ("2", "response", None), ("2", "response", None), ("3", "revisit", 4), ("4", "response", None), ("None", "revisit", 2)]
    assert got(3) == [("1", "response", None), ("2", "response", None), ("2", "response", None), ("3", "revisit", 4), ("4", "response", None), ("None", "response", None)]
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_base32(spark):
    texts = ["", "a", "é" * 99]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(warc.base32_sha1(rows["t"].cast("binary"))).collect()]
    assert got == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts]
