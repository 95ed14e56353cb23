"""Masked pseudo-likelihood of documents by a bidirectional window network.

Every word is predicted from the ``SIDE`` words on either side of it, itself
left out; the summed conditional log-probabilities score a document.

*Vocabulary.*  Every distinct word (by its 64-bit hash) is counted over the
whole corpus, in a Spark table that grows with it.  The most frequent get
ids of their own, by rank; each of the others belongs to one of ``TAIL``
cells, by its hash.  The network predicts a frequent word or a cell, and the
word's own share of its cell's occurrences makes that the probability of the
word: over all words of the corpus they sum to 1, less what a corpus of few
words leaves to ids that have none.  The shares of the
``KNOWN`` most frequent words go to every task; those of all others are
joined from the table of counts, once per document and distinct word, so no
hot word is shuffled.

*Network.*  Each of the window's places has its own embedding of the word
that stands there; their sum goes through tanh, and a two-level softmax
(class, then word within the class) gives the probability.  It is plain
numpy, with hand-written gradients and Adagrad.

*Training.*  Each round, every task trains on all words of its share of the
corpus, from the same start; the tasks' parameters are averaged by Spark in
two steps, weighted by words, and are the next round's start.  So every
word of the corpus takes part in every round, no task holds more than a
share and one model, and only the averaged model (a fixed size) reaches the
driver.

Null text, or text without words, has no words, log-likelihood 0 and a null
mean.  Rows that repeat are scored each on its own; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches, written
from .text import U64, parts, string_bytes, words

SIDE = 2
CLASSES, PER_CLASS = 32, 32
VOCABULARY = CLASSES * PER_CLASS
TAIL = 128
#: Words whose counts every task holds (a megabyte); the others' are joined.
KNOWN = 1 << 16
#: Distinct words that a task counts before it hands them on.
MOST_COUNTED = 1 << 20
WIDTH = 16
BATCH = 8192
ROUNDS = 2
RATE = 0.1
PAD = VOCABULARY
PLACES = [o for o in range(-SIDE, SIDE + 1) if o]
#: Parameter groups that are averaged apart.
CHUNKS = 16


@dataclass
class Network:
    """Parameters: place embeddings, class layer, word layer."""
    embed: np.ndarray   # places x (VOCABULARY + 1) x WIDTH
    klass: np.ndarray   # WIDTH x CLASSES
    klass_bias: np.ndarray
    word: np.ndarray    # CLASSES x WIDTH x PER_CLASS
    word_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.klass, self.klass_bias, self.word, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def with_flat(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at:at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Network(*out)


def fresh(counts: np.ndarray, seed: int = 11) -> Network:
    """Small random weights; the biases start at the corpus' word frequencies."""
    rng = np.random.default_rng(seed)
    n = (counts + 1.0).reshape(CLASSES, PER_CLASS)
    embed = rng.normal(0, 0.1, (len(PLACES), VOCABULARY + 1, WIDTH)).astype(np.float32)
    return Network(embed, rng.normal(0, 0.1, (WIDTH, CLASSES)).astype(np.float32),
                   np.log(n.sum(1) / n.sum()).astype(np.float32),
                   rng.normal(0, 0.1, (CLASSES, WIDTH, PER_CLASS)).astype(np.float32),
                   np.log(n / n.sum(1, keepdims=True)).astype(np.float32))


def windows(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words x places: the words around each word, PAD beyond its text."""
    n = len(ids)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    around = np.full((n, len(PLACES)), PAD, np.int32)
    for k, o in enumerate(PLACES):
        at = slice(max(0, -o), n - max(0, o))
        to = slice(max(0, o), n - max(0, -o))
        same = doc[at] == doc[to]
        around[at, k][same] = ids[to][same]
    return around


def softmax(x: np.ndarray) -> np.ndarray:
    """Of each row, in place.  One number is taken off all rows (they are close
    enough for single precision), and rows are added up as a matrix product."""
    x -= x.max(initial=-np.inf)
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    x /= np.maximum(total, 1e-37)[:, None]
    return x


def forward(net: Network, around: np.ndarray, target: np.ndarray, learn: list[np.ndarray] | None = None) -> np.ndarray:
    """Log-probability of each target; with ``learn``, also adds its gradients to those arrays."""
    n = len(target)
    # words by class: each class is then one stretch of rows
    order = np.argsort((target // PER_CLASS).astype(np.uint8), kind="stable")
    target, near = target[order], around.T[:, order]
    klass, word = target // PER_CLASS, target % PER_CLASS
    upto = np.searchsorted(klass, np.arange(CLASSES + 1))
    h = net.embed[0].take(near[0], axis=0)
    for k in range(1, len(PLACES)):
        h += net.embed[k].take(near[k], axis=0)
    np.tanh(h, out=h)
    rows = np.arange(n)
    p = softmax(h @ net.klass + net.klass_bias)
    out = p[rows, klass]
    if learn is not None:
        p[rows, klass] -= 1
        learn[1] += h.T @ p
        learn[2] += p.sum(0)
        back = p @ net.klass.T
    for c in range(CLASSES):
        a, b = upto[c], upto[c + 1]
        if a == b:
            continue
        q = softmax(h[a:b] @ net.word[c] + net.word_bias[c])
        own = rows[:b - a]
        out[a:b] *= q[own, word[a:b]]
        if learn is not None:
            q[own, word[a:b]] -= 1
            learn[3][c] += h[a:b].T @ q
            learn[4][c] += q.sum(0)
            back[a:b] += q @ net.word[c].T
    if learn is not None:
        h *= h
        np.subtract(1, h, out=h)
        back *= h
        for k in range(len(PLACES)):
            # sums by word: sort the words, add up each one's stretch
            by = np.argsort(near[k].astype(np.uint16), kind="stable")
            own = near[k].take(by)
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            learn[0][k][own[first]] += np.add.reduceat(back.take(by, axis=0), first, axis=0)
    result = np.empty(n, np.float64)
    result[order] = np.log(np.maximum(out, 1e-37))
    return result


class Trainer:
    """Adagrad on batches of shuffled words."""

    def __init__(self, net: Network):
        self.net = net
        self.power = [np.full_like(a, 1e-6) for a in net.arrays()]
        self.grads, self.room = ([np.empty_like(a) for a in net.arrays()] for _ in range(2))
        self.rng = np.random.default_rng(5)
        self.words = 0

    def train(self, ids: np.ndarray, offsets: np.ndarray) -> None:
        around = windows(ids, offsets)
        order = self.rng.permutation(len(ids))
        for at in range(0, len(ids), BATCH):
            pick = order[at:at + BATCH]
            for g in self.grads:
                g.fill(0)
            forward(self.net, around[pick], ids[pick], self.grads)
            for a, g, s, room in zip(self.net.arrays(), self.grads, self.power, self.room):
                g /= len(pick)
                np.multiply(g, g, out=room)
                s += room
                np.sqrt(s, out=room)
                np.divide(g, room, out=room)
                room *= RATE
                a -= room
        self.words += len(ids)


def cell_of(word: np.ndarray) -> np.ndarray:
    """The cell of a word hash (``TAIL`` is a power of two)."""
    return (word >> U64(64 - (TAIL - 1).bit_length())).astype(np.int32)


@dataclass
class Vocabulary:
    """Ids of words; ``words`` are the ``KNOWN`` most frequent, sorted by hash."""
    words: np.ndarray   # word hashes
    ids: np.ndarray     # their network ids
    shares: np.ndarray  # log of their share of their cell, 0 for words with an own id
    cells: np.ndarray   # occurrences in each cell

    def look_up(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word hash its id, its log share, and is it known."""
        if not len(self.words):
            return VOCABULARY - TAIL + cell_of(word), np.zeros(len(word)), np.zeros(len(word), bool)
        at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        known = self.words[at] == word
        return (np.where(known, self.ids[at], VOCABULARY - TAIL + cell_of(word)).astype(np.int32),
                np.where(known, self.shares[at], 0.0), known)


def hashed_words(docs: DataFrame) -> DataFrame:
    """row (a number), doc_id, words (their 64-bit hashes) of every document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                h, offsets = words(*string_bytes(part.column(2)))
                raw = [h[x:y].tobytes() for x, y in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(raw, pa.binary())],
                                                 names=["row", "doc_id", "words"])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       "text").mapInArrow(run, "row long, doc_id long, words binary")


def bucket_counts(hashed: DataFrame) -> DataFrame:
    """Written word, n: how often each distinct word occurs in the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(n)], names=["word", "n"])

        for batch in batches:
            new, times = np.unique(np.frombuffer(b"".join(x.as_py() for x in batch.column(0)), "<u8"), return_counts=True)
            held, of = np.unique(np.concatenate([held, new]), return_inverse=True)
            n = np.bincount(of, np.concatenate([n, times]), len(held)).astype(np.int64)
            if len(held) > MOST_COUNTED:
                yield out()
                held, n = held[:0], n[:0]
        if len(held):
            yield out()

    rows = hashed.select("words").mapInArrow(run, "word long, n long")
    return written(rows.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def cell_column(word: Column) -> Column:
    return F.shiftrightunsigned(word, 64 - (TAIL - 1).bit_length()).cast("int")


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The ids of all words (the frequent by rank, the rest by cell), and the ids' counts."""
    top = counts.orderBy(F.desc("n"), "word").limit(KNOWN).toPandas()  # KNOWN rows at most
    word, n = top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    head = min(VOCABULARY - TAIL, len(word))
    cells = np.zeros(TAIL, np.int64)
    for r in counts.groupBy(cell_column(F.col("word")).alias("cell")).agg(F.sum("n").alias("n")).collect():  # TAIL rows
        cells[r["cell"]] = r["n"]
    np.subtract.at(cells, cell_of(word[:head]), n[:head])
    ids = VOCABULARY - TAIL + cell_of(word)
    shares = np.log(n / np.maximum(cells[cell_of(word)], 1))
    ids[:head], shares[:head] = np.arange(head), 0
    order = np.argsort(word)
    own = np.zeros(VOCABULARY - TAIL, np.int64)
    own[:head] = n[:head]
    return Vocabulary(word[order], ids[order], shares[order], cells), np.concatenate([own, cells])


def encode(hashed: DataFrame, id_of: Vocabulary) -> DataFrame:
    """row, doc_id, ids (network ids, unsigned 16-bit), share (sum of the known
    words' log shares), rare and times (the distinct words that aren't known)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, share, rare, times = [], [], [], []
            for x in batch.column(2):
                word = np.frombuffer(x.as_py(), "<u8")
                own, log_share, known = id_of.look_up(word)
                ids.append(own.astype("<u2").tobytes())
                share.append(log_share.sum())
                few, n = np.unique(word[~known], return_counts=True)
                rare.append(few.view(np.int64))
                times.append(n)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(share, pa.float64()),
                                              pa.array(rare, longs), pa.array(times, longs)],
                                             names=["row", "doc_id", "ids", "share", "rare", "times"])

    return hashed.mapInArrow(run, "row long, doc_id long, ids binary, share double, rare array<long>, times array<long>")


def rare_shares(coded: DataFrame, counts: DataFrame, id_of: Vocabulary) -> DataFrame:
    """row, rare_share: the sum of the log shares of its words that aren't known."""
    cells = F.array(*(F.lit(int(n)) for n in id_of.cells))
    each = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    log_share = F.log(F.col("n") / F.element_at(cells, cell_column(F.col("word")) + 1))
    return each.join(counts, "word").groupBy("row").agg(F.sum(F.col("times") * log_share).alias("rare_share"))


def shares(batches: Iterator[pa.RecordBatch], column: int, most_words: int = 1 << 18):
    """(rows, word ids, offsets) of about ``most_words`` words each."""
    for batch in batches:
        raw = [x.as_py() for x in batch.column(column)]
        at = 0
        while at < len(raw):
            end, held = at, 0
            while end < len(raw) and (end == at or held + len(raw[end]) // 2 <= most_words):
                held += len(raw[end]) // 2
                end += 1
            ids = np.frombuffer(b"".join(raw[at:end]), "<u2").astype(np.int32)
            yield batch.slice(at, end - at), ids, np.concatenate([[0], np.cumsum([len(r) // 2 for r in raw[at:end]])])
            at = end


def train_round(hashed: DataFrame, id_of: Vocabulary, start: Network) -> Network:
    """One pass of every task over its share (encoded already or not), and the
    average of what they learned."""
    coded = (hashed if "ids" in hashed.columns else encode(hashed, id_of)).select("doc_id", "ids")
    tasks = coded.rdd.getNumPartitions()
    groups = max(1, math.isqrt(tasks))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, name = Trainer(start.with_flat(start.flat())), 0
        for rows, ids, offsets in shares(batches, 1):
            if len(ids):
                if not trainer.words:
                    name = rows.column(0)[0].as_py() or 0
                trainer.train(ids, offsets)
        if trainer.words:
            flat = np.array_split(trainer.net.flat(), CHUNKS)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(CHUNKS), pa.int32()), pa.array([name % groups] * CHUNKS, pa.int32()),
                pa.array([float(trainer.words)] * CHUNKS), pa.array([c.tobytes() for c in flat], pa.binary())],
                names=["chunk", "part", "weight", "params"])

    def average(key, rows):  # an Arrow table: the parameters of some tasks, of one chunk
        weight = rows["weight"].to_numpy()
        total = sum(np.frombuffer(x, np.float32) * w for x, w in zip(rows["params"].to_pylist(), weight))
        row = [key[0].as_py(), 0, weight.sum(), (total / weight.sum()).astype(np.float32).tobytes()]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.binary()]
        return pa.table([pa.array([x], t) for x, t in zip(row, kinds)], names=["chunk", "part", "weight", "params"])

    schema = "chunk int, part int, weight double, params binary"
    learned = coded.mapInArrow(train, schema).groupBy("chunk", "part").applyInArrow(average, schema)
    rows = learned.groupBy("chunk").applyInArrow(average, schema).collect()  # one model: CHUNKS rows of a fixed size
    if not rows:
        return start
    return start.with_flat(np.concatenate([np.frombuffer(r["params"], np.float32) for r in sorted(rows, key=lambda r: r["chunk"])]))


def pseudo_likelihood(coded: DataFrame, counts: DataFrame, id_of: Vocabulary, net: Network) -> DataFrame:
    """doc_id, n_words, log_likelihood, mean_log_prob of every document."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, offsets in shares(batches, 2):
            around = windows(ids, offsets)
            logp = np.zeros(len(ids))
            for at in range(0, len(ids), 4 * BATCH):
                logp[at:at + 4 * BATCH] = forward(net, around[at:at + 4 * BATCH], ids[at:at + 4 * BATCH])
            n = np.diff(offsets)
            total = rows.column(3).to_numpy().copy()
            if (n > 0).any():
                total[n > 0] += np.add.reduceat(logp, offsets[:-1][n > 0])
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(n.astype(np.int64)), pa.array(total)],
                                             names=["row", "doc_id", "n_words", "log_likelihood"])

    out = coded.select("row", "doc_id", "ids", "share").mapInArrow(score, "row long, doc_id long, n_words long, log_likelihood double")
    out = out.join(rare_shares(coded, counts, id_of), "row", "left").select(
        "doc_id", "n_words", (F.col("log_likelihood") + F.coalesce("rare_share", F.lit(0.0))).alias("log_likelihood"))
    return out.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Learn from all documents and score each."""
    hashed = hashed_words(docs)
    counts = bucket_counts(hashed)
    id_of, of_ids = vocabulary(counts)
    coded = written(encode(hashed, id_of), "word-ids")
    net = fresh(of_ids)
    for _ in range(rounds):
        net = train_round(coded, id_of, net)
    return pseudo_likelihood(coded, counts, id_of, net)
