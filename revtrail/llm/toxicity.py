"""Toxicity by compression distance between two zstandard dictionaries.

A window (``WINDOW_WORDS`` consecutive words, lower-cased) is compressed
twice, with a dictionary of ordinary text and with one of toxic text.  What
the toxic one saves says how far the window is from ordinary writing and how
near to toxic.  Three things make so small a difference count:

* both dictionaries end in the same ordinary words, so windows without
  toxic matter come out the same;
* the toxic part holds the words that stand out among toxic training texts:
  in ``LEAST_CONTEXTS`` different contexts at least (so that copies of one
  text count once) and with log odds of ``LEAST_ODDS``;
* a window stands between two pieces of ordinary text, as zstandard stores
  tiny inputs raw and leaves an input's last bytes unmatched.

A document is described by how many of its windows save 1, 2, 3, 4 and 6
bytes or more, the largest saving, and its number of windows.  A ridge
logistic regression, fitted on training texts that the dictionaries haven't
seen, turns that into a probability; thresholds are set on it.

Training takes at most ``TOXIC_SAMPLE`` + ``ORDINARY_SAMPLE`` labelled texts
of at most ``SAMPLE_BYTES`` bytes, chosen by a hash of their id: a bounded,
documented sample.  The labels of both kinds are counted over all such texts,
and the regression's bias is set to their ratio, so that a score doesn't
depend on whether a cap binds.  All windows of all whole texts are scored.

Null and empty texts have no windows and get the score of none.  Without
labels of both kinds every score is 0.  Rows that repeat are scored each on
its own; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches, written
from .text import parts, string_bytes, word_spans
from .tokens import distinct, worker_state

WINDOW_WORDS = 1
LEVEL = 9
BASE_BYTES = 1 << 16
TOXIC_SAMPLE, ORDINARY_SAMPLE, SAMPLE_BYTES = 4000, 8000, 8000
LEAST_CONTEXTS, LEAST_ODDS = 6, 3.5
SAVINGS = np.array([1, 2, 3, 4, 6])
#: Windows whose saving a Python worker remembers.
MOST_WINDOWS = 1_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass
class Model:
    base: bytes = b""          # ordinary words, most frequent last
    toxic: bytes = b""         # words of the toxic part, most telling last
    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(SAVINGS) + 2))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(SAVINGS) + 2))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(SAVINGS) + 2))
    bias: float = -np.inf      # no model: score 0
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class Compressors:
    """The two compressors of a model, with the savings of windows seen."""

    def __init__(self, model: Model):
        import zstandard

        def compressor(content: bytes):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                                            write_dict_id=False)
        self.ordinary, self.toxic = compressor(model.base), compressor(model.toxic + model.base)
        middle = len(model.base) // 2
        self.before, self.after = model.base[middle:middle + 64] + b" ", b" " + model.base[middle + 96:middle + 136]
        self.seen: dict[bytes, int] = {}

    def saving(self, window: bytes) -> int:
        text = self.before + window + self.after
        return len(self.ordinary.compress(text)) - len(self.toxic.compress(text))

    def savings(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the toxic dictionary saves on each window, and n + 1 offsets by value."""
        data, offsets = string_bytes(column)
        if len(data) == 0:
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        low, starts, sizes = word_spans(data, offsets)
        of = np.searchsorted(starts, offsets)
        n = np.diff(of)
        heads = np.arange(len(starts)) - np.repeat(of[:-1], n)
        heads = np.flatnonzero(heads % WINDOW_WORDS == 0)
        last = np.minimum(heads + WINDOW_WORDS, np.repeat(of[1:], n)[heads]) - 1
        begin, size = starts[heads], starts[last] + sizes[last] - starts[heads]
        upto = np.searchsorted(heads, of)
        if not len(heads):
            return np.zeros(0, np.int64), upto
        first, which = distinct(low, begin, size)
        if len(self.seen) > MOST_WINDOWS:
            self.seen.clear()
        raw = low.tobytes()
        found = []
        for a, s in zip(begin[first].tolist(), size[first].tolist()):
            window = raw[a:a + s]
            d = self.seen.get(window)
            if d is None:
                d = self.saving(window)
                if s <= 64:
                    self.seen[window] = d
            found.append(d)
        return np.array(found, np.int64)[which], upto


def describe(saved: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of each value from the savings of its windows."""
    n = np.diff(offsets)
    some = n > 0
    out = np.zeros((len(n), len(SAVINGS) + 2))
    if some.any():
        for i, least in enumerate(SAVINGS):
            out[some, i] = np.log1p(np.add.reduceat((saved >= least).astype(np.int64), offsets[:-1][some]))
        out[some, -2] = np.maximum(0, np.maximum.reduceat(saved, offsets[:-1][some]))
    out[:, -1] = np.log1p(n)
    return out


def compressors(model: Model) -> Compressors:
    """This worker's compressors for the model (those of the last model only)."""
    state = worker_state()
    if state.get("toxicity_model") != model.name:
        state["toxicity_model"], state["toxicity"] = model.name, Compressors(model)
    return state["toxicity"]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """(base, toxic part) from training texts."""
    def counted(texts):
        docs, contexts = Counter(), defaultdict(set)
        for t in texts:
            w = WORD.findall(t.lower())
            docs.update(set(w))
            for a, b, c in zip(["", *w], w, [*w[1:], ""]):
                if len(contexts[b]) < 1000:
                    contexts[b].add((a, c))
        return docs, contexts
    bad, contexts = counted(toxic)
    good, _ = counted(ordinary)
    odds = {w: np.log((n + 0.1) / (len(toxic) + 0.2) / ((good[w] + 0.1) / (len(ordinary) + 0.2)))
            for w, n in bad.items() if min(n, len(contexts[w])) >= LEAST_CONTEXTS}
    telling = sorted((o, w) for w, o in odds.items() if o >= LEAST_ODDS)
    frequent = sorted(good.items(), key=lambda x: (-x[1], x[0]))
    base = b"".join(b" " + w.encode() for w, _ in reversed(frequent[:BASE_BYTES // 2]) if len(w) < 64)[-BASE_BYTES:]
    return base, b"".join(b" " + w.encode() for _, w in telling)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression, by Newton's method."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from doc_id, text and the labels doc_id, toxic (1 or 0)."""
    spark = docs.sparkSession
    # at most TOXIC_SAMPLE + ORDINARY_SAMPLE ids: a proven bound for the broadcast and for the driver
    known = labels.select(F.col("doc_id").alias("of"), F.col("toxic").cast("int").alias("toxic")).filter("of is not null")
    docs = docs.select("doc_id", "text")
    sizes = docs.filter(F.octet_length("text").between(1, SAMPLE_BYTES)).select(F.col("doc_id").alias("of")).distinct()
    known = written(known.join(sizes, "of", "left_semi").dropDuplicates(["of"]), "labelled")
    many = {r["toxic"]: r["n"] for r in known.filter("toxic in (0, 1)").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = []
    for toxic, most in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE)):
        ids = [r["of"] for r in known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("of"), "of").limit(most).collect()]
        few = spark.createDataFrame([(i,) for i in ids], "of long")
        rows = docs.join(F.broadcast(few), F.col("doc_id") == F.col("of"), "left_semi").toPandas()
        rows = rows.drop_duplicates("doc_id").sort_values("doc_id")
        sample.append(rows["text"].tolist())
    bad, good = sample
    if min(len(bad), len(good)) < 2:
        return Model()
    # every other text makes the dictionaries, the rest calibrates
    base, toxic = dictionaries(bad[::2], good[::2])
    model = Model(base, toxic)
    texts = bad[1::2] + good[1::2]
    x = describe(*Compressors(model).savings(pa.array(texts)))
    y = np.array([1.0] * len(bad[1::2]) + [0.0] * len(good[1::2]))
    model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    model.weights, model.bias = logistic((x - model.mean) / model.scale, y)
    # the caps bind apart: back from the sample's share of toxic texts to that of all
    model.bias -= float(np.log(len(bad) / len(good)) - np.log(many[1] / many[0]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) of every whole text."""
    small_batches(docs.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                x = describe(*compressors(model).savings(part.column(1)))
                p = 1 / (1 + np.exp(-np.clip((x - model.mean) / model.scale @ model.weights + model.bias, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model.bias == -np.inf:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    return rows.mapInArrow(scored, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """Is the row's remainder 2?  (A null doc_id is held out.)"""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Learn from the labels of rows that aren't held out, score all: doc_id, held_out, score, predicted."""
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= threshold).cast("int").alias("predicted"))
