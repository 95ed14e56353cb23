"""How far the word use of each source of a language is from the others'.

Words are counted by a translate table: ``bytes.translate`` lowers A-Z and
turns every separator into a blank in one pass, ``bytes.split`` cuts, and a
Counter per document gives frequencies.  A task adds its documents' counters
up per (lang, source) and sends one row per distinct (lang, source, term),
flushed whenever it holds ``MOST_HELD`` of them, so a hot source meets as
counters and memory is bounded by the longest text.

A language keeps the V terms that occur in at least ``least_docs`` of its
documents.  In every (lang, source) group, and in the language as a whole, a
kept term has the share p = 1 + floor(scale * (count + 2) / (N + 2 V)), N the
sum of the kept terms' counts there.  Two shares differ by
f = floor((p - q)^2 / (p + q)).

* ``pair``: for every other source of the language, f summed over all kept
  terms.  Most terms are absent from most sources, so the sum is taken
  sparsely: what it would be if no term occurred in either, corrections by
  the counts of each group alone (a histogram of shares per group, which is
  short), and corrections for terms that occur in both, added up per pair
  in tasks over blocks of terms.
* ``term``: the terms that a source uses more than its language, with f
  against the language's share, the ``top`` largest.

Everything is integer arithmetic: shares by decimal division without
fraction, f and its sums in 64 bits.  Null text, lang and source count as ''.
Empty texts make their group exist; a language without kept terms has pairs
of value 0 and no terms.  Rows that repeat an id are documents of their own
(ids aren't read), further columns are ignored, an empty table gives an empty
result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import small_batches, written

SCALE = 1_000_000_000
#: Distinct (lang, source, term) of a task held before they are sent.
MOST_HELD = 1_000_000
#: A task keeps occurrences and documents of a term in one number.
ONE_DOC_BITS = 40
ONE_DOC = 1 << ONE_DOC_BITS
#: Pairs of rows of a term that are computed at once.
MOST_PAIRS = 1 << 20

#: Letters and bytes of non-ASCII characters are kept, A-Z lowered, all others blank.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def document_counts(text: bytes) -> Counter:
    """Occurrences of each term of one text."""
    return Counter(text.translate(TABLE).split())


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs) of all documents; a row with an empty
    term and no occurrences says that a group exists."""
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))

    def out(counts: dict) -> pa.RecordBatch:
        cols = [[], [], [], [], []]
        for (lang, source), own in counts.items():
            cols[0] += [lang] * (len(own) + 1)
            cols[1] += [source] * (len(own) + 1)
            cols[2] += [b"", *own]
            cols[3] += [0, *(n & (ONE_DOC - 1) for n in own.values())]
            cols[4] += [0, *(n >> ONE_DOC_BITS for n in own.values())]
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["lang", "source", "term", "count", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = {}, 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2)):
                own = document_counts(text.as_py())
                total = counts.get((lang, source))
                if total is None:
                    total = counts[lang, source] = {}
                    held += 1
                held -= len(total)
                get = total.get
                for term, n in own.items():
                    total[term] = get(term, 0) + n + ONE_DOC
                held += len(total)
                if held >= MOST_HELD:
                    yield out(counts)
                    counts, held = {}, 0
        if counts:
            yield out(counts)

    parts = rows.mapInArrow(count, "lang string, source string, term binary, count long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, n: Column, v: Column, scale: int) -> Column:
    """1 + floor(scale * (count + 2) / (n + 2 v)), exact."""
    wide = lambda c: c.cast("decimal(28,0)")
    return F.call_function("div", wide(count + 2) * F.lit(scale).cast("decimal(10,0)"), wide(n + 2 * v)) + 1


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def both(kept: DataFrame, sources: DataFrame) -> DataFrame:
    """(lang, a, b, extra) with a < b: the corrections of the terms that occur
    in both, f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), added up per pair by
    blocks of terms; tasks never hold more than the rows of one term beyond
    what they have added up."""
    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        held: list = []

        def flush(rows):  # whole terms of one language
            lang = rows[0][0]
            term = np.cumsum([True] + [x[:2] != y[:2] for x, y in zip(rows, rows[1:])])
            names = sorted({r[2] for r in rows})
            number = {s: i for i, s in enumerate(names)}
            source = np.array([number[r[2]] for r in rows])
            p, zero = np.array([r[3] for r in rows], np.int64), np.array([r[4] for r in rows], np.int64)
            first = np.searchsorted(term, term)
            size = np.bincount(term)[term]
            # each row meets the later rows of its term
            later = first + size - 1 - np.arange(len(rows))
            ends = np.cumsum(later)
            lo = 0
            while lo < len(rows):
                hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + MOST_PAIRS, "right")), lo + 1)
                one = np.repeat(np.arange(lo, hi), later[lo:hi])
                if len(one):
                    start = np.repeat(ends[lo:hi] - later[lo:hi], later[lo:hi])
                    two = one + 1 + np.arange(len(one)) + (ends[lo - 1] if lo else 0) - start
                    extra = f(p[one], p[two]) - f(p[one], zero[two]) - f(zero[one], p[two]) + f(zero[one], zero[two])
                    key = source[one] * len(names) + source[two]
                    for k, own in zip(*_sums(key, extra)):
                        pair = (lang, names[k // len(names)], names[k % len(names)])
                        total[pair] = total.get(pair, 0) + own
                lo = hi

        def batch_out():
            cols = list(zip(*((*k, v) for k, v in total.items())))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:3]), pa.array(cols[3], pa.int64())],
                                              names=["lang", "a", "b", "extra"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:2] != held[-1][:2] and (len(held) >= 50_000 or row[0] != held[-1][0]):
                    flush(held)
                    held = []
                    if len(total) >= MOST_HELD:
                        yield batch_out()
                        total.clear()
                held.append(row)
        if held:
            flush(held)
        if total:
            yield batch_out()

    placed = kept.join(sources.select("lang", "source", "zero"), ["lang", "source"]).select("lang", "term", "source", "p", "zero")
    placed = placed.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    parts = placed.mapInArrow(add, "lang string, a string, b string, extra long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("extra").alias("extra"))


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[list[int], list[int]]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first].tolist(), np.add.reduceat(value[order], first).tolist()


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10, scale: int = SCALE) -> DataFrame:
    """lang, source, part, item, value, rank: see above.  Ranks count from 1
    per group and part, by value descending, then item in byte order."""
    counts = written(term_counts(docs), "term-counts")
    terms = counts.filter(F.octet_length("term") > 0)
    of_lang = written(terms.groupBy("lang", "term").agg(F.sum("count").alias("in_lang"), F.sum("docs").alias("in_docs"))
                      .filter(F.col("in_docs") >= least_docs).drop("in_docs"), "kept-terms")
    langs = of_lang.groupBy("lang").agg(F.sum("in_lang").alias("n_lang"), F.count(F.lit(1)).alias("v"))
    kept = written(terms.join(of_lang, ["lang", "term"]).select("lang", "source", "term", "count", "in_lang"), "kept-counts")
    sums = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    sources = counts.filter(F.octet_length("term") == 0).select("lang", "source").join(langs, "lang", "left") \
        .join(sums, ["lang", "source"], "left").na.fill(0, ["n", "n_lang", "v"])
    # without kept terms there is nothing to share; the group's pairs have value 0
    zero = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("n"), F.greatest("v", F.lit(1)), scale))
    sources = written(sources.withColumn("zero", zero), "sources")

    kept = kept.join(sources, ["lang", "source"])
    kept = written(kept.select("lang", "source", "term", share(F.col("count"), F.col("n"), F.col("v"), scale).alias("p"),
                               share(F.col("in_lang"), F.col("n_lang"), F.col("v"), scale).alias("q")), "shares")
    return pairs(kept, sources).unionByName(top_terms(kept, top))


def pairs(kept: DataFrame, sources: DataFrame) -> DataFrame:
    of = lambda c, *names: sources.select("lang", *[F.col(x).alias(y) for x, y in names])
    every = of("a", ("source", "a"), ("zero", "zero_a"), ("v", "v")).join(of("b", ("source", "b"), ("zero", "zero_b")), "lang") \
        .filter("a <> b").withColumn("none", difference(F.col("zero_a"), F.col("zero_b")))
    # what the terms of a change if they don't occur in b
    shares = kept.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count(F.lit(1)).alias("times"))
    alone = shares.join(every.select("lang", "a", "b", "zero_b", "none"), ["lang", "a"]).groupBy("lang", "a", "b").agg(
        F.sum(F.col("times") * (difference(F.col("p"), F.col("zero_b")) - F.col("none"))).alias("alone"))
    alone = written(alone, "one-sided")
    other = alone.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), F.col("alone").alias("other"))
    extra = written(both(kept, sources), "two-sided")
    extra = extra.unionByName(extra.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "extra"))
    key = ["lang", "a", "b"]
    value = sum((F.coalesce(c, F.lit(0).cast("long")) for c in (F.col("v") * F.col("none"), F.col("alone"), F.col("other"), F.col("extra"))),
                F.lit(0).cast("long"))
    found = every.join(alone, key, "left").join(other, key, "left").join(extra, key, "left")
    found = found.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return found.withColumn("rank", rank)


def top_terms(kept: DataFrame, top: int) -> DataFrame:
    more = kept.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
                                       difference(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return more.withColumn("rank", rank).filter(F.col("rank") <= top)
