"""Best-two-fit packing of token sequences.

Documents become pieces of at most ``capacity`` tokens.  How pieces share
sequences depends on their lengths alone, and there are at most ``capacity``
lengths.  So the packing is decided on the *histogram* of lengths, which is
that small however many documents there are:

1. A pattern starts with the longest length left and takes, again and
   again, the longest one that still fits.
2. While there is a gap, its smallest piece may be replaced by two pieces
   left over whose sum fits the expanded gap more tightly.
3. The pattern is used as often as its lengths last, so each one uses up a
   length (or all but a few of its pieces) and there are at most a few
   patterns per length.

The pieces then find their places in parallel: pieces of a length are
numbered (counts per block of hashed ids give each block its offset), and
the number's place in the pattern runs is its sequence and offset.

Null text counts as empty.  Rows that share a doc_id are packed each on its
own.  Further columns are ignored.  An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .scratch import small_batches, written
from .text import parts
from .tokens import encoder

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces in a block of the numbering, about.
BLOCK_PIECES = 20_000


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids and its end id; ids as little-endian
    unsigned 32-bit numbers if asked for."""
    small_batches(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, True)
        for batch in batches:
            for part in parts(batch, "text"):
                ids, offsets = enc.encode(part.column(1))
                rows: list[tuple] = []
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    doc = np.append(ids[offsets[i]:offsets[i + 1]], enc.dtype(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(doc), capacity)):
                        raw = doc[at:at + capacity].tobytes()
                        rows.append((doc_id, k, at, len(raw) // 4, zlib.crc32(raw), raw))
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:5 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[
                    "doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(pieces, PIECE_SCHEMA + ", ids binary" * with_ids))


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces}) of the patterns that use up all counts."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    lengths = np.arange(capacity + 1)
    while True:
        longest = np.maximum.accumulate(np.where(left > 0, lengths, 0))  # the longest length left, up to each length
        if not longest[capacity]:
            return plan
        taken: dict[int, int] = {}
        gap = capacity

        def fit(most: int) -> int:
            x = int(longest[most])
            while x and left[x] <= taken.get(x, 0):
                x = int(longest[x - 1])
            return x

        while gap and (x := fit(gap)):
            k = min(gap // x, int(left[x]) - taken.get(x, 0))
            taken[x] = taken.get(x, 0) + k
            gap -= k * x
        while gap and len(taken) + max(taken.values()) > 2:
            small = min(taken)
            room = gap + small
            taken[small] -= 1
            free = left.copy()
            for x, k in taken.items():
                free[x] -= k
            top = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            a = np.flatnonzero(free[:room // 2 + 1] > 0)
            a = a[a > 0]
            b = top[room - a]
            # a pair of one length needs two pieces; a shorter partner of that a stands as another a's pair
            b = np.where((b == a) & (free[b] < 2), 0, b)
            total = np.where(b > 0, a + b, 0)
            best = int(total.argmax()) if len(a) else -1
            if best < 0 or total[best] <= small:
                taken[small] += 1
                break
            if not taken[small]:
                del taken[small]
            for x in (int(a[best]), int(b[best])):
                taken[x] = taken.get(x, 0) + 1
            gap = room - int(total[best])
        taken = {x: k for x, k in taken.items() if k}
        times = min(int(left[x]) // k for x, k in taken.items())
        for x, k in taken.items():
            left[x] -= times * k
        plan.append((times, taken))


def pattern_runs(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first number, pieces a sequence, first sequence, offset),
    sorted: a run covers the numbers up to the next row of its length."""
    rows, numbered, sequence = [], {}, 0
    for times, taken in plan:
        offset = 0
        for length in sorted(taken, reverse=True):
            k = taken[length]
            rows.append((length, numbered.get(length, 0), k, sequence, offset))
            numbered[length] = numbered.get(length, 0) + times * k
            offset += k * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (doc_id, piece, length <= capacity, ...; read twice, so
    best a written table) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 0 < x <= capacity for x in counts):
        raise ValueError("a piece's length must be from 1 to the capacity")
    runs = pattern_runs(best_two_fit(counts, capacity))
    blocks = max(8, sum(counts.values()) // BLOCK_PIECES + 1)
    placed = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)).cast("int"))
    starts = placed.groupBy(F.col("length").alias("_length"), F.col("_block").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.withColumn("_first", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_length").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    number = F.row_number().over(Window.partitionBy("length", "_block").orderBy("doc_id", "piece")) - 1
    numbered = placed.withColumn("_number", number).join(
        starts, (F.col("length") == F.col("_length")) & (F.col("_block") == F.col("_of")))
    cols = pieces.columns
    numbered = numbered.select(*cols, (F.col("_number") + F.col("_first")).alias("_number"))
    schema = StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")
    stride = 1 << 40  # numbers of a length stay below this

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = runs[:, 0] * stride + runs[:, 1]
        for batch in batches:
            length = batch.column(cols.index("length")).to_numpy()
            rank = batch.column(len(cols)).to_numpy()
            run = runs[np.searchsorted(keys, length * stride + rank, "right") - 1]
            past = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(cols)], pa.array(run[:, 3] + past // run[:, 2]),
                 pa.array(run[:, 4] + length * (past % run[:, 2]))], names=[*cols, "sequence_id", "offset"])

    return numbered.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves from packed pieces with their ids (at most
    ``capacity`` tokens each): sequence_id, length, ids."""
    parts_ = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform(parts_, lambda x: x["ids"]), F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Tokenize and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(written(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
