"""Near-duplicate join on the Jaccard similarity of word n-gram sets.

1. One scan makes each text's n-gram set (words as in ``text.py``, five to a
   gram), a 128-bit fingerprint of the set, and MinHash bands.  Band and row
   counts are the cheapest ones that reach the target recall for a pair just
   at the similarity: 1 - (1 - s**rows)**bands.
2. Texts with one fingerprint are a class; only classes go on, so copies
   never meet.
3. Classes shuffle on their band hashes.  Buckets with the same members
   count once.
4. The n-gram sets of classes in buckets are made again from the texts and
   meet bucket by bucket.  A bucket of more than ``BLOCK`` classes is split
   into blocks and every two blocks meet in a group of their own, so that no
   group is large.  A pair is verified on the full sets, and only in its
   first common bucket.  A group reports each class's links, counted in
   documents, and one edge per linked class; pairs are never emitted.
5. Edges are joined to components.

No cap drops a candidate.  Null text, or text without words, has no n-grams
and no links.  A text of fewer than n words, but not none, has one gram, all
its words.  Rows that repeat a doc_id count as documents of their own.
Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import as_ids, but_first, numbered, small_batches, without, written
from .text import U64, ngrams, parts, string_bytes, words

#: Classes of a bucket that meet in one block.
BLOCK = 256
#: MinHash functions at most.
MOST_HASHES = 64


def choose_bands(similarity: float, recall: float, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach the recall within the hash budget."""
    best = None
    for rows in range(1, 17):
        hit = similarity ** rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= most_hashes or best is None:
            best = (bands, rows)
    return best


def gram_sets(column: pa.Array, n: int) -> tuple[list[np.ndarray], list[bytes]]:
    """Sorted distinct n-gram hashes of each text, and their fingerprints."""
    h, offsets = ngrams(*words(*string_bytes(column)), n)
    sets = [np.unique(h[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return sets, [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands) of non-empty sets."""
    rng = np.random.default_rng(20)
    factor = rng.integers(1, 1 << 63, bands * rows, np.uint64) * U64(2) + U64(1)
    shift = rng.integers(0, 1 << 63, bands * rows, np.uint64)
    out = np.zeros((len(sets), bands), U64)
    at = 0
    while at < len(sets):  # so many texts at a time as stay in the processor's cache
        end, held = at, 0
        while end < len(sets) and (end == at or held + len(sets[end]) <= 1 << 15):
            held += len(sets[end])
            end += 1
        x = np.concatenate(sets[at:end])
        first = np.cumsum([0] + [len(s) for s in sets[at:end - 1]])
        for b in range(bands):
            key = np.full(end - at, b + 1, U64)
            for j in range(b * rows, b * rows + rows):
                key = (key ^ (np.minimum.reduceat(x * factor[j] + shift[j], first) >> U64(16))) * U64(0x9E3779B97F4A7C15)
            out[at:end, b] = key ^ (key >> U64(29))
        at = end
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, fp, grams, bands of every document."""
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                sets, fps = gram_sets(part.column(1), n)
                some = [i for i, s in enumerate(sets) if len(s)]
                keys = band_hashes([sets[i] for i in some], bands, rows).view(np.int64)
                own = [None] * len(sets)
                for i, k in zip(some, keys):
                    own[i] = k
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(fps, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(own, pa.list_(pa.int64()))], names=["doc_id", "fp", "grams", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, fp binary, grams long, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(fp, grams, gram_set) of the classes ``wanted`` (of, fp), from the texts."""
    small_batches(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                sets, fps = gram_sets(part.column(0), n)
                ok = [i for i, fp in enumerate(part.column(1).to_pylist()) if fp == fps[i]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([fps[i] for i in ok], pa.binary()), pa.array([len(sets[i]) for i in ok], pa.int64()),
                    pa.array([sets[i].tobytes() for i in ok], pa.binary())], names=["fp", "grams", "gram_set"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("of"))).select("text", "fp")
    return rows.mapInArrow(make, "fp binary, grams long, gram_set binary").dropDuplicates(["fp"])


def common(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (rows of two indices)."""
    if len(pairs) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs], np.int64)
    _, kind, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[kind] > 1
    column = np.cumsum(times > 1) - 1
    kind, owner = column[kind[shared]], owner[shared]
    order = np.argsort(kind, kind="stable")
    kind, owner = kind[order], owner[order]
    met = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for lo in range(0, int(kind[-1]) + 1 if len(kind) else 0, width):
        a, b = np.searchsorted(kind, [lo, lo + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[a:b], kind[a:b] - lo] = 1
        met += has @ has.T
    return met[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def verify(rows: list[dict], similarity: float) -> list[tuple[bytes, int, bytes]]:
    """(fp, linked documents, least linked class of the group) of the linked classes of one group."""
    m = len(rows)
    a, b = np.triu_indices(m, 1)
    size = np.array([r["grams"] for r in rows], np.int64)
    block = np.array([r["own_block"] for r in rows])
    if rows[0]["i"] != rows[0]["j"]:
        keep = block[a] != block[b]
        a, b = a[keep], b[keep]
    keep = np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b])
    a, b = a[keep], b[keep]
    # in an earlier common bucket the pair has been met already
    band = rows[0]["band"]
    seen = np.zeros(len(a), bool)
    keys = [{x["band"]: x["h"] for x in r["kept"]} for r in rows]
    for k in sorted({x for own in keys for x in own if x < band}):
        h = np.array([own.get(k, 0) for own in keys], np.int64)
        has = np.array([k in own for own in keys])
        seen |= has[a] & has[b] & (h[a] == h[b])
    pairs = np.column_stack([a[~seen], b[~seen]])
    if not len(pairs):
        return []
    sets = [np.frombuffer(r["gram_set"], "<u8") for r in rows]
    met = common(sets, pairs)
    # met / union >= similarity, in whole numbers of a millionth
    share = round(similarity * 1_000_000)
    linked = pairs[met * 1_000_000 >= share * (size[pairs[:, 0]] + size[pairs[:, 1]] - met)]
    links, root = np.zeros(m, np.int64), list(range(m))
    copies = np.array([r["copies"] for r in rows], np.int64)
    np.add.at(links, linked[:, 0], copies[linked[:, 1]])
    np.add.at(links, linked[:, 1], copies[linked[:, 0]])

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for x, y in linked.tolist():
        x, y = top(x), top(y)
        if x != y:
            x, y = sorted((x, y), key=lambda i: rows[i]["fp"])
            root[y] = x
    return [(rows[i]["fp"], int(links[i]), rows[top(i)]["fp"]) for i in range(m) if links[i]]


def verified(grouped: DataFrame, similarity: float) -> DataFrame:
    """``verify`` on every group (band, h, i, j) of the rows."""
    key = ["band", "h", "i", "j"]
    kinds = pa.schema([("fp", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), kinds)], schema=kinds)

        for batch in batches:
            found = []
            for row in batch.to_pylist():
                now = tuple(row[k] for k in key)
                if now != at:
                    if len(held) > 1:
                        found += verify(held, similarity)
                    held, at = [], now
                held.append(row)
            if found:
                yield out(found)
        if len(held) > 1 and (found := verify(held, similarity)):
            yield out(found)

    grouped.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return grouped.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "fp binary, links long, root binary")


def near_duplicates(docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.9995,
                    block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its component),
    text_class (least doc_id with the same n-grams), n_links (documents it is
    as similar as asked for to)."""
    bands, rows = choose_bands(similarity, recall)
    signed = written(signatures(docs, n, bands, rows), "signatures")
    classes = written(signed.filter("grams > 0").groupBy("fp").agg(
        F.min("doc_id").alias("text_class"), F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands")), "classes")

    keyed = classes.select("fp", F.posexplode("bands").alias("band", "h"))
    member = F.xxhash64("fp")
    buckets = keyed.groupBy("band", "h").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(member).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), member)).alias("y"),
    ).filter("members > 1")
    buckets = buckets.groupBy("members", "x", "y").agg(F.min(F.struct("band", "h")).alias("first")).select(
        "first.band", "first.h", "members")
    held = written(keyed.join(buckets, ["band", "h"]), "bucket-members")

    kept = held.groupBy("fp").agg(F.sort_array(F.collect_list(F.struct("band", "h"))).alias("kept"))  # as many as bands at most
    candidates = classes.select("fp", "text_class", "copies").join(kept, "fp")
    sets = full_sets(docs, candidates.select(F.col("text_class").alias("of"), "fp"), n)
    blocks = F.ceil(F.col("members") / block).cast("int")
    met = held.join(sets, "fp").join(candidates.select("fp", "copies", "kept"), "fp")
    met = met.withColumn("own_block", F.pmod(F.xxhash64("fp"), blocks).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select("band", "h", F.least("own_block", "other").alias("i"), F.greatest("own_block", "other").alias("j"),
                     "own_block", "fp", "grams", "copies", "kept", "gram_set")
    found = written(verified(met, similarity), "links")

    links = found.groupBy("fp").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    known = classes.select("fp", "text_class", "copies").join(links, "fp", "left").join(
        roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = known.groupBy("root").agg(F.min("text_class").alias("class_id"))
    known = written(known.join(least, "root").select(
        "fp", "text_class", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    none = F.col("grams") == 0
    return signed.select("doc_id", "grams", "fp").join(known, "fp", "left").select(
        "doc_id", F.when(none, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(none, F.col("doc_id")).otherwise(F.col("text_class")).alias("text_class"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, whole: of each component the row with
    the least doc_id, one also where rows share a doc_id or have none."""
    rows, number = numbered(docs)
    groups = near_duplicates(as_ids(rows, number), **options).filter("n_links > 0").select(
        F.col("doc_id").alias("row"), F.col("class_id").alias("together"))
    return without(rows, number, but_first(rows, number, groups))
