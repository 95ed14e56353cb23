"""Language identification by error-correcting output codes.

Each language has a codeword of bits; each bit splits the languages in two,
and a binary n-gram classifier tells the two sides apart.  Up to five
languages get all splits there are (2**(k-1) - 1); more get random dense
codewords, the set of several tries whose nearest pair is furthest apart.

The classifiers are naive Bayes on hashed three-byte grams of lower-cased
text (all but letters counts as a blank), with every language's gram
distribution weighing the same.  Their counts are sums over all training
rows, gathered by Spark: one small vector per language, whatever the corpus.

Decoding is loss-weighted: a language's loss is the sum over bits of the
logistic loss of the bit's margin on the side that the codeword names,
weighted by how well the bit's classifier separates (its Jeffreys
divergence).  The least loss wins (ties: first in alphabetical order); the
score is its softmax share, and a text is ambiguous if the runner-up's loss
is within ``ambiguous_gap``.

Null text, or text without a letter, is ``und`` with score 0.  If no
language was learned, every text is ``und``.  Rows that repeat are scored
each on its own; further columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches
from .text import LOWER, parts, string_bytes

BITS = 14
#: Letters: ASCII ones and all bytes of other characters.
LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[128:] = True
#: A margin counts as the mean of its grams times about this many of them at most.
ENOUGH_GRAMS = 50
AMBIGUOUS_GAP = 0.05
UNKNOWN = "und"


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the gram around each letter, and n + 1 offsets by value."""
    data, offsets = string_bytes(column)
    if len(data) == 0:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    low = LOWER[data]
    low[~LETTER[low]] = 32
    left = np.empty_like(low)
    left[0], left[1:] = 32, low[:-1]
    right = np.empty_like(low)
    right[-1], right[:-1] = 32, low[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    left[edges] = 32
    right[edges[1:] - 1] = 32
    at = np.flatnonzero(low != 32)
    code = (left[at].astype(np.uint32) << np.uint32(16)) | (low[at].astype(np.uint32) << np.uint32(8)) | right[at]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS), np.searchsorted(at, offsets)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k codewords (rows) of +1 and -1; no bit is constant."""
    if k <= 1:
        return np.ones((k, 0), np.int8)
    if k <= 5:
        masks = range(1, 2 ** (k - 1))  # the last language is on the minus side of each split
        return np.array([[1 if m >> i & 1 else -1 for m in masks] for i in range(k)], np.int8)
    rng = np.random.default_rng(seed)
    best, best_gap = None, -1
    for _ in range(20):
        code = rng.choice(np.array([-1, 1], np.int8), (k, int(np.ceil(10 * np.log2(k)))))
        code = code[:, np.abs(code.sum(0)) < k]
        apart = (code.shape[1] - code.astype(int) @ code.T) // 2
        gap = int((apart + np.eye(k, dtype=int) * code.shape[1]).min())
        if gap > best_gap:
            best, best_gap = code, gap
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray      # languages x bits
    weights: np.ndarray   # bits x buckets, log ratio of the plus side to the minus side
    trust: np.ndarray     # bits, mean 1


def fit(labelled: DataFrame) -> Model:
    """Learn from text, lang (rows with a null in either are left out)."""
    small_batches(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in parts(batch, "text", 1 << 20):
                buckets, offsets = grams(part.column(0))
                langs = part.column(1).to_pylist()
                for lang in set(langs):
                    rows = np.array([x == lang for x in langs])
                    own = buckets[np.repeat(rows, np.diff(offsets))]
                    sums[lang] = sums.get(lang, 0) + np.bincount(own, minlength=1 << BITS)
        for lang, n in sums.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(n[used])],
                                             names=["lang", "bucket", "n"])

    rows = (labelled.select("text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
            .mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    p = np.full((len(languages), 1 << BITS), 0.5)
    for i, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        p[i, own["bucket"]] += own["n"]
    p /= p.sum(1, keepdims=True)
    code = codewords(len(languages))
    weights, trust = np.zeros((code.shape[1], 1 << BITS), np.float32), np.ones(code.shape[1])
    for b in range(code.shape[1]):
        plus, minus = p[code[:, b] > 0].mean(0), p[code[:, b] < 0].mean(0)
        weights[b] = np.log(plus / minus)
        trust[b] = ((plus - minus) * np.log(plus / minus)).sum()
    if len(trust):
        trust /= max(trust.mean(), 1e-12)
    return Model(languages, code, weights, trust)


def decode(model: Model, buckets: np.ndarray, offsets: np.ndarray, ambiguous_gap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the best language, its share, and whether the runner-up is as near, for each value."""
    n = np.diff(offsets)
    margin = np.zeros((len(n), model.code.shape[1]))
    some = n > 0
    for b in range(model.code.shape[1]):
        if some.any():
            margin[some, b] = np.add.reduceat(model.weights[b][buckets], offsets[:-1][some], dtype=np.float64)
    margin *= (1 / (1 + n / ENOUGH_GRAMS))[:, None]
    # loss of a language: sum over bits of trust * log(1 + exp(-code * margin))
    loss = np.stack([(np.logaddexp(0, -word * margin) * model.trust).sum(1) for word in model.code], 1)
    low = loss.min(1)
    share = 1 / np.exp(low[:, None] - loss).sum(1)
    second = np.partition(loss, 1, axis=1)[:, 1] if loss.shape[1] > 1 else np.full(len(n), np.inf)
    return loss.argmin(1), share, second - low < ambiguous_gap


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model, ambiguous_gap: float = AMBIGUOUS_GAP) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every document."""
    small_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text", 1 << 20):
                best, share, unsure = decode(model, *grams(part.column(1)), ambiguous_gap)
                letter = part.column(2).to_numpy(False)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([model.languages[i] if a else UNKNOWN for i, a in zip(best, letter)]),
                    pa.array(np.where(letter, share, 0.0)), pa.array(unsure | ~letter)],
                    names=["doc_id", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", has_letter().alias("letter"))
    if not model.languages:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Is the row's remainder 0?  (A null doc_id is held out.)"""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that aren't held out, predict all: doc_id, held_out, lang_pred, score, ambiguous."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


def drop_unknown(docs: DataFrame, ambiguous_gap: float = AMBIGUOUS_GAP) -> DataFrame:
    """The rows of ``docs``, whole, whose language can be told: they have a
    letter, and no second language is as near.  Nothing is shuffled."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.limit(0)
    small_batches(docs.sparkSession)
    flag = "_" + "_".join(docs.columns)  # a name that no column has
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text", 1 << 20):
                _, _, unsure = decode(model, *grams(part.column(at)), ambiguous_gap)
                sure = pa.array(part.column(part.num_columns - 1).to_numpy(False) & ~unsure)
                yield part.select(range(part.num_columns - 1)).filter(sure)

    return docs.withColumn(flag, has_letter()).mapInArrow(keep, docs.schema)
