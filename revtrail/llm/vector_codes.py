"""Product-quantiser codes of integer vectors, exact and without floating point.

Every component x becomes the integer floor(1024 * x); a vector is cut into
equal consecutive parts, and each part position has a codebook.  Codebooks
start as the parts of the vectors with the smallest ids and are refined in
rounds: Spark tasks assign their vectors' parts to the nearest entries and
send one sum and count per entry, Spark adds them up, and an entry becomes
floor(sum / count).  What reaches the driver is the codebooks alone, parts x
entries rows, whatever the table's size.

The nearest entry is found on the integer Walsh-Hadamard transforms of the
parts and entries, zero-padded to K components, a power of two.  The
transform keeps distances up to the factor K, so squared differences of
coefficients, added in sequency order, are a growing lower bound of K times
the squared distance.  Entries whose bound exceeds the whole distance of the
best one so far go early.  All of it is integer arithmetic; at the end the
factor divides out without rest.  Ties go to the lower index.

Rows whose vector is null or holds null or non-finite components are
dropped, and rows with a repeated or null id are vectors of their own; among
equal ids the lesser vector counts as the smaller, and null ids as the
largest.  Vectors must be of one length, a multiple of the number of parts
(else an error).  Components whose integers are beyond 2**24 are computed with
Python's integers; one of 2**50 or more, or an error sum beyond a long, ends
the job.  Equal labels, nulls
together, share a sum of errors.  Further columns are ignored; an empty
table, or one without usable vectors, gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches, written

SCALE = 1024
#: Components up to this size keep every sum of squares within 64 bits.
SAFE = 1 << 24
#: Components beyond this are refused, so that the sums of a batch fit 64 bits.
LARGEST = 1 << 50
#: Vectors whose distances to all entries are held at once.
ROWS = 256
#: Coefficients added between two eliminations.
STEP = 4


@functools.lru_cache
def hadamard(width: int) -> tuple[int, np.ndarray]:
    """(K, transform): the Walsh-Hadamard matrix of the least power of two
    K >= width in sequency order, cut to the rows of the first ``width``
    components, since the padding is zero."""
    size = 1
    h = np.ones((1, 1), np.int64)
    while size < width:
        h = np.block([[h, h], [h, -h]])
        size *= 2
    changes = (h[:, 1:] != h[:, :-1]).sum(axis=1)
    return size, h[np.argsort(changes, kind="stable")].T[:width]


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each vector's nearest entry and the squared distance to it."""
    size, transform = hadamard(vectors.shape[1])
    most = max(np.abs(vectors).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.int64 if most <= SAFE else object
    book = entries.astype(kind) @ transform.astype(kind)
    index, distance = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), kind)
    for at in range(0, len(vectors), ROWS):
        own = vectors[at:at + ROWS].astype(kind) @ transform.astype(kind)
        index[at:at + ROWS], distance[at:at + ROWS] = _nearest(own, book, kind)
    return index, distance // size


def _nearest(own: np.ndarray, book: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The same on transforms; distances are scaled by their size."""
    size, each = own.shape[1], np.arange(len(own))
    sums = np.zeros((len(own), len(book)), kind)
    most, row, entry = None, None, None
    for lo in range(0, size, STEP):
        hi = min(lo + STEP, size)
        if row is None:  # most entries still count
            for k in range(lo, hi):
                d = own[:, k, None] - book[None, :, k]
                sums += d * d
            if hi == size:
                break
            best = sums.argmin(axis=1)
            whole = ((own - book[best]) ** 2).sum(axis=1)
            most = whole if most is None else np.minimum(most, whole)
            alive = sums <= most[:, None]
            if 4 * np.count_nonzero(alive) <= alive.size:
                row, entry = np.nonzero(alive)
                left = sums[row, entry]
        else:
            left = left + ((own[row, lo:hi] - book[entry, lo:hi]) ** 2).sum(axis=1)
            keep = left <= most[row]
            row, entry, left = row[keep], entry[keep], left[keep]
    if row is None:
        best = sums.argmin(axis=1)  # the first of equals
        return best, sums[each, best]
    # rows and, within a row, entries ascend; the entry that set ``most`` is always left
    first = np.searchsorted(row, each)
    least = np.minimum.reduceat(left, first)
    hit = np.flatnonzero(left == least[row])
    hit = hit[np.unique(row[hit], return_index=True)[1]]
    return entry[hit], least


def whole_numbers(vector: Column) -> Column:
    """floor(1024 * x) of all components as an array of longs."""
    def whole(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        return F.when(F.abs(scaled) < float(LARGEST), F.floor(scaled).cast("long")).otherwise(
            F.raise_error(F.lit("a vector component is too large for exact sums")).cast("long"))

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of longs, of ``width`` components each."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(values) != len(column) * width or len(column) and (np.diff(column.offsets.to_numpy()) != width).any():
        raise ValueError(f"vectors of other lengths than {width}")
    return values.reshape(-1, width)


@dataclass
class Codebooks:
    entries: list[np.ndarray]  # one per part: entries x components

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()

    def refined(self, sums: list) -> Codebooks:
        """Entries replaced by floor(sum / count) of rows (part, entry, count, sums)."""
        out = [e.copy() for e in self.entries]
        for part, entry, count, total in sums:
            out[part][entry] = [x // count for x in total]
        return Codebooks(out)


def first_codebooks(whole: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids, or None without vectors."""
    least = whole.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not least:
        return None
    start = np.array([r.vector for r in least], np.int64)
    if start.shape[1] == 0 or start.shape[1] % parts:
        raise ValueError(f"vectors of {start.shape[1]} components can't be cut into {parts} equal parts")
    return Codebooks(np.split(start, parts, axis=1))


def entry_sums(whole: DataFrame, books: Codebooks) -> list:
    """(part, entry, count, sums) of the vectors assigned to each entry that
    has any: a task sends a row per entry, Spark adds them up."""
    width = sum(e.shape[1] for e in books.entries)
    depth = books.entries[0].shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(e), np.int64) for e in books.entries]
        total = [np.zeros(e.shape, object) for e in books.entries]
        for batch in batches:
            for p, own in enumerate(np.split(matrix(batch.column(0), width), len(count), axis=1)):
                index, _ = nearest(own, books.entries[p])
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                count[p][used] += np.diff(np.append(first, len(index)))
                total[p][used] += np.add.reduceat(own[order], first, axis=0)  # a batch's sums fit 64 bits
        rows = [(p, e, int(count[p][e]), [str(x) for x in total[p][e]]) for p in range(len(count)) for e in np.flatnonzero(count[p])]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                              pa.array(cols[3], pa.list_(pa.string()))], names=["part", "entry", "n", "sums"])

    partial = whole.select("vector").mapInArrow(add, "part int, entry int, n long, sums array<string>")
    exact = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(depth)]
    added = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact).collect()
    return [(r.part, r.entry, r.n, [int(r[f"s{k}"]) for k in range(depth)]) for r in added]


def train(whole: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks | None:
    """Codebooks of whole-number vectors (vec_id, vector), or None without vectors."""
    books = first_codebooks(whole, parts, entries)
    for _ in range(rounds if books else 0):
        books = books.refined(entry_sums(whole, books))
    return books


def coded(whole: DataFrame, books: Codebooks) -> DataFrame:
    """The rows with ``code`` (two hex digits a part, or as many as the
    largest codebook needs) and ``error`` instead of the vector."""
    width = sum(e.shape[1] for e in books.entries)
    digits = max(2, len(f"{len(books.entries[0]) - 1:x}"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("vector")
            found = [nearest(own, books.entries[p]) for p, own in
                     enumerate(np.split(matrix(batch.column(at), width), len(books.entries), axis=1))]
            names = np.array([f"{i:0{digits}x}" for i in range(len(books.entries[0]))])
            codes = ["".join(x) for x in zip(*(names[i].tolist() for i, _ in found))]
            errors = [sum(int(x) for x in e) for e in zip(*(d for _, d in found))]
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             names=[*[n for n in batch.schema.names if n != "vector"], "code", "error"])

    schema = whole.drop("vector").withColumns({"code": F.lit(""), "error": F.lit(0).cast("long")}).schema
    return whole.mapInArrow(code, schema)


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    small_batches(vectors.sparkSession, 4000)
    rows = vectors.select("vec_id", "label", F.col(f"`{vector}`").alias("vector")).filter(usable(F.col("vector")))
    whole = written(rows.withColumn("vector", whole_numbers(F.col("vector"))), "whole-vectors")
    books = train(whole, parts, entries, rounds)
    if books is None:
        return whole.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    codes = written(coded(whole, books), "vector-codes")
    shared = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    out = codes.join(shared, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
