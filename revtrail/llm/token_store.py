"""Token ids on disk: frequency-ranked, byte-aligned, control bytes apart.

A *block* holds whole documents in ascending doc_id order (null first).
Within it the ids are replaced by their rank by frequency (ties: smaller
id), so frequent ids are small numbers, and every rank is stored in one to
four bytes, least byte first.  The byte counts stand apart, as two bits each,
four to a control byte.  The rank table travels in the block, so a block
can be decoded alone.  Decoding looks the four sizes of a control byte up in
a table of 256 rows and gathers all values at once; there is no loop over
tokens.

Blocks are rows of Parquet files, one file per range of doc_id, so any store
that Spark reaches can hold them and a lost task is simply written again.

Null text counts as empty; every document ends with ``end_id``.  Rows that
share a doc_id are stored as documents of their own.  Columns beyond
doc_id and text are ignored.  An empty table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import folder, small_batches
from .text import parts
from .tokens import encoder

#: Tokens after which a block ends (a longer document is a block alone).
BLOCK_TOKENS = 1 << 21
STORE_SCHEMA = ("shard_first long, block int, start_in_shard long, n_tokens long, doc_ids binary, doc_nulls binary, "
                "doc_tokens binary, ids_by_rank binary, control binary, data binary")
DOC_SCHEMA = "doc_id long, shard_first long, start_in_shard long, n_tokens long, ids_crc32 long, ids binary"
#: For each control byte its four value sizes.
SIZES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned numbers below 2**32."""
    v = values.astype(np.uint32)
    size = 1 + (v >= 1 << 8).astype(np.int64) + (v >= 1 << 16) + (v >= 1 << 24)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[:len(v)] = size - 1
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    ends = np.cumsum(size)
    data = np.zeros(int(ends[-1]) if len(v) else 0, np.uint8)
    start = ends - size
    for k in range(4):
        has = size > k
        data[start[has] + k] = (v[has] >> np.uint32(8 * k)) & np.uint32(255)
    return control.tobytes(), data.tobytes()


def unpack_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n numbers of ``pack_values``."""
    size = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    v = raw[start].astype(np.uint32)
    for k in range(1, 4):
        has = np.flatnonzero(size > k)
        v[has] |= raw[start[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return v


def encode_block(doc_ids: list[int | None], tokens: list[np.ndarray]) -> dict:
    """A block's columns, without its place."""
    ids = np.concatenate(tokens) if tokens else np.zeros(0, np.uint32)
    counts = np.bincount(ids)
    used = np.flatnonzero(counts)
    by_rank = used[np.argsort(-counts[used], kind="stable")]
    rank = np.zeros(len(counts), np.uint32)
    rank[by_rank] = np.arange(len(by_rank))
    control, data = pack_values(rank[ids])
    return {"n_tokens": len(ids), "doc_ids": np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            "doc_nulls": np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            "doc_tokens": np.array([len(t) for t in tokens], "<i8").tobytes(),
            "ids_by_rank": by_rank.astype("<u4").tobytes(), "control": control, "data": data}


def decode_block(row: dict) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, tokens of each, and all ids of a block."""
    doc_ids = np.frombuffer(row["doc_ids"], "<i8")
    nulls = np.frombuffer(row["doc_nulls"], np.uint8)
    ranks = unpack_values(row["control"], row["data"], row["n_tokens"])
    ids = np.frombuffer(row["ids_by_rank"], "<u4")[ranks]
    return [None if z else int(d) for d, z in zip(doc_ids, nulls)], np.frombuffer(row["doc_tokens"], "<i8"), ids


def store_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_tokens: int = BLOCK_TOKENS) -> None:
    """Tokenize doc_id, text and write the blocks below ``path``."""
    small_batches(docs.sparkSession)
    fields = pa.schema([("shard_first", pa.int64()), ("block", pa.int32()), ("start_in_shard", pa.int64()),
                        ("n_tokens", pa.int64()), *((x, pa.binary()) for x in (
                            "doc_ids", "doc_nulls", "doc_tokens", "ids_by_rank", "control", "data"))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, False)
        first, block, start, held = None, 0, 0, 0
        doc_ids: list = []
        tokens: list = []

        def flush():
            nonlocal block, start, held
            row = {"shard_first": first, "block": block, "start_in_shard": start} | encode_block(doc_ids, tokens)
            block, start, held = block + 1, start + row["n_tokens"], 0
            doc_ids.clear()
            tokens.clear()
            return pa.RecordBatch.from_pylist([row], fields)

        begun = False
        for batch in batches:
            for part in parts(batch, "text"):
                ids, offsets = enc.encode(part.column(1))
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    if not begun:
                        first, begun = doc_id, True
                    doc = np.append(ids[offsets[i]:offsets[i + 1]], enc.dtype(end_id))
                    if held and held + len(doc) > block_tokens:
                        yield flush()
                    doc_ids.append(doc_id)
                    tokens.append(doc)
                    held += len(doc)
        if doc_ids:
            yield flush()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(blocks, STORE_SCHEMA).write.option("compression", "uncompressed").parquet(path))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Decode a store: doc_id, start (ids of all documents before), n_tokens,
    ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    fields = pa.schema([("doc_id", pa.int64()), ("shard_first", pa.int64()), ("start_in_shard", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                doc_ids, sizes, ids = decode_block(row)
                ends = np.cumsum(sizes)
                raw = [ids[e - s:e].astype("<u4").tobytes() for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64()), pa.array([row["shard_first"]] * len(raw), pa.int64()),
                    pa.array(row["start_in_shard"] + ends - sizes), pa.array(sizes),
                    pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                    pa.array(raw if with_ids else [None] * len(raw), pa.binary())], schema=fields)

    stored = spark.read.schema(STORE_SCHEMA).parquet(path)
    # one row for each written file: few rows, however many documents there are
    shards = stored.groupBy("shard_first").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy(F.col("shard_first").asc_nulls_first())
                             .rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select(F.col("shard_first").alias("first"), F.coalesce(before, F.lit(0)).alias("before"))
    docs = stored.mapInArrow(documents, DOC_SCHEMA)
    out = docs.join(shards, F.col("shard_first").eqNullSafe(F.col("first")))
    cols = ["doc_id", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32"]
    return out.select(*cols, "ids") if with_ids else out.select(*cols)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Store the documents' tokens and read them back, without the ids."""
    path = folder(docs.sparkSession, "tokens")
    store_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path, with_ids=False)
