"""Near duplicates by one-permutation hashing, banded buckets and star edges.

1. One scan makes each text's set of distinct shingles (hashed to 64 bits), a
   128-bit fingerprint of the set and its one-permutation sketch: the hash
   range is cut into bins, a bin's value is the least hash in it, so one hash
   per shingle serves all bins.  Empty bins are filled by optimal
   densification: each bin has a fixed random order of the others and takes
   the first filled one in it.  Bands of bins are hashed; their count and rows
   follow from the wanted recall at the similarity asked for.
2. Texts with one fingerprint are a class and only classes go on, so copies
   never meet.  Classes with an equal band share a bucket; buckets with the
   same members count once.
3. In every bucket one class is the hub and each other class of it is one
   candidate edge, so pairs are as many as members.  Edges are confirmed on
   the full sets; a class takes over the root of the hub it is linked to.  A
   hub that has met all others is done, and so are buckets whose classes all
   have one root.  The rest goes through another round with other hubs.
4. What then still shares a bucket without sharing a root is confirmed
   exactly: the classes of a bucket are cut by size, so that only neighbouring
   sizes can reach the similarity, and further into blocks; every two blocks
   that can hold a link meet in a group of their own, except those within the
   bucket's most frequent root.  A group reports a spanning forest of its links.
5. All links are joined to components.

No cap drops a candidate: only equal bands of a linked pair can be missed,
with probability 1 - ``recall`` for a pair just at the similarity.  A text of
fewer than ``n`` words, but not none, has one shingle, all its words.  Null
text, or text without words, has none and is linked with nothing.  Rows that
repeat a doc_id count as documents of their own; a null doc_id is never the
least of a component that has another.  Further columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .ngram_join import common
from .scratch import small_batches, written
from .text import NOT_BLANK, U64, ngrams, parts, string_bytes, words

#: Bins of a band.
ROWS = 6
#: Rounds of star edges before the rest is met block by block.
ROUNDS = 2
#: Classes of a block.
BLOCK = 256


def bands_for(similarity: float, recall: float, rows: int = ROWS) -> int:
    """Bands of ``rows`` bins each that a pair at the similarity needs for the recall."""
    hit = similarity ** rows
    return 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))


@functools.lru_cache
def detours(bins: int) -> np.ndarray:
    """For each bin a fixed random order of all bins, itself first."""
    rng = np.random.default_rng(bins)
    return np.array([[b, *rng.permutation(np.delete(np.arange(bins), b))] for b in range(bins)], np.int32)


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, offsets = ngrams(*words(*string_bytes(column), NOT_BLANK), n)
    return [np.unique(h[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]


def fingerprint(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One-permutation sketches (sets x bins) of non-empty sorted sets, empty bins filled."""
    out, filled = np.zeros((len(sets), bins), U64), np.zeros((len(sets), bins), bool)
    if not sets:
        return out
    hashes = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    # the bin is the leading part of the hash: in a sorted set the first of a bin is its least
    place = owner * bins + ((hashes >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    out.ravel()[place[first]] = hashes[first]
    filled.ravel()[place[first]] = True
    row, bin_ = np.nonzero(~filled)
    order = detours(bins)
    for step in range(1, bins):
        if not len(row):
            break
        source = order[bin_, step]
        hit = filled[row, source]
        out[row[hit], bin_[hit]] = out[row[hit], source[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return out


def band_hashes(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit hash of each band, its number included."""
    bands = sketch.shape[1] // rows
    key = np.tile(np.arange(1, bands + 1, dtype=U64), (len(sketch), 1))
    for j in range(rows):
        key = (key ^ sketch[:, j::rows][:, :bands]) * U64(0x9E3779B97F4A7C15)
        key ^= key >> U64(29)
    return key


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, fp, size, buckets (band hashes) of every document."""
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                sets = shingle_sets(part.column(1), n)
                some = [i for i, s in enumerate(sets) if len(s)]
                keys = band_hashes(sketches([sets[i] for i in some], bands * rows), rows).view(np.int64)
                own = [None] * len(sets)
                for i, k in zip(some, keys):
                    own[i] = k
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([fingerprint(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(own, pa.list_(pa.int64()))], names=["doc_id", "fp", "size", "buckets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        sign, "doc_id long, fp binary, size long, buckets array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(fp, hashes) of the classes ``wanted`` (of: a doc_id of the class, fp), from the texts."""
    small_batches(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                sets = shingle_sets(part.column(0), n)
                ok = [i for i, fp in enumerate(part.column(1).to_pylist()) if fp == fingerprint(sets[i])]
                yield pa.RecordBatch.from_arrays([pa.array([fingerprint(sets[i]) for i in ok], pa.binary()),
                                                  pa.array([sets[i].tobytes() for i in ok], pa.binary())], names=["fp", "hashes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("of"))).select("text", "fp")
    return rows.mapInArrow(make, "fp binary, hashes binary").dropDuplicates(["fp"])


def reaches(met, a, b, share: tuple[int, int]):
    """Is the overlap ``met`` of sets of a and b elements large enough?"""
    return share[1] * met >= share[0] * (a + b - met)


def may_reach(a: Column, b: Column, share: tuple[int, int]) -> Column:
    """Can sets of these sizes reach the similarity at all?"""
    return F.least(a, b) * share[1] >= F.greatest(a, b) * share[0]


def confirmed(edges: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The edges (a, b) whose full sets reach the similarity."""
    edges.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    held = edges.join(sets.select(F.col("fp").alias("b"), F.col("hashes").alias("hashes_b")), "b") \
        .join(sets.select(F.col("fp").alias("a"), F.col("hashes").alias("hashes_a")), "a").select("a", "b", "hashes_a", "hashes_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                keep.append(bool(reaches(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), share)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return held.mapInArrow(check, "a binary, b binary")


def with_labels(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``members`` (.., fp, ..) with ``root``: equal roots are known to hang together."""
    if labels is None:
        return members.withColumn("root", F.col("fp"))
    return members.join(labels, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def open_buckets(rooted: DataFrame) -> DataFrame:
    """bucket, hub, hub_size, hub_root of the buckets whose members have
    several roots; the hub is the class that comes first in one fixed random order."""
    hub = F.struct(F.col("fp").alias("hub"), F.col("size").alias("hub_size"), F.col("root").alias("hub_root"))
    found = rooted.groupBy("bucket").agg((F.min("root") != F.max("root")).alias("mixed"), F.min_by(hub, place("fp")).alias("h"))
    return found.filter("mixed").select("bucket", "h.*")


def place(fp: str) -> Column:
    return F.struct(F.xxhash64(fp), F.col(fp))


def labels_of(links: DataFrame, jumps: int = 2) -> DataFrame:
    """(fp, root) of the classes that were linked to hubs: of its hubs the
    first, then that one's, and so on a few times.  Hubs come before the classes they met,
    so this never runs in a circle.  What hangs together may keep
    several roots, which costs comparisons, not links."""
    up = written(links.groupBy(F.col("b").alias("fp")).agg(F.min_by("a", place("a")).alias("root")), "labels")
    out = up
    for _ in range(jumps):
        out = out.join(up.select(F.col("fp").alias("root"), F.col("root").alias("next")), "root", "left").select(
            "fp", F.coalesce("next", "root").alias("root"))
    return written(out, "labels")


def size_class(size: Column, share: tuple[int, int]) -> Column:
    """Sets whose sizes are more than one class apart can't reach the similarity
    (classes are a little wider than it takes, so that rounding is no matter)."""
    return F.floor(F.log(size.cast("double")) / max(-1.001 * math.log(share[0] / share[1]), 0.001)).cast("int")


def met_in_blocks(members: DataFrame, sets: DataFrame, share: tuple[int, int], block: int) -> DataFrame:
    """Links (a, b) between classes of different roots that share a
    bucket: a spanning forest of each group of two blocks."""
    tally = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("times"))
    main = tally.groupBy("bucket").agg(F.max_by("root", F.struct("times", "root")).alias("main"))
    rows = members.join(main, "bucket").select(
        "bucket", "fp", "root", (F.col("root") == F.col("main")).alias("is_main"), size_class(F.col("size"), share).alias("c"))
    cells = rows.groupBy("bucket", "is_main", "c").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    rows = rows.join(cells, ["bucket", "is_main", "c"]).withColumn("k", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # a block meets all blocks of its own and the neighbouring classes, one of the main root those of other roots only
    near = cells.select("bucket", F.col("is_main").alias("other_main"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other_k"),
                        F.col("c").alias("other_c"))
    near = near.withColumn("c", F.explode(F.array(F.col("other_c") - 1, F.col("other_c"), F.col("other_c") + 1)))
    met = rows.join(near, ["bucket", "c"]).filter(~(F.col("is_main") & F.col("other_main")))
    own, other = F.struct("c", "is_main", "k"), F.struct(F.col("other_c").alias("c"), F.col("other_main").alias("is_main"), F.col("other_k").alias("k"))
    met = met.select("bucket", F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), (own <= other).alias("lower"), "fp", "root")
    met = met.withColumn("group", F.xxhash64("bucket", "i", "j")).select("bucket", "group", "lower", (F.col("i") == F.col("j")).alias("same"), "fp", "root")
    met = met.join(sets, "fp")
    met.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, found = [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["bucket"], row["group"]) != at:
                    found += forest(held, share)
                    held, at = [], (row["bucket"], row["group"])
                held.append(row)
            if found:
                yield links(found)
                found = []
        if found := forest(held, share):
            yield links(found)

    def links(found):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])

    met = met.select("bucket", "group", "lower", "same", "fp", "root", "hashes")
    return met.repartition("bucket", "group").sortWithinPartitions("bucket", "group").mapInArrow(run, "a binary, b binary")


def forest(rows: list[dict], share: tuple[int, int]) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between roots in one group."""
    if len(rows) < 2:
        return []
    sets = [np.frombuffer(r["hashes"], "<u8") for r in rows]
    a, b = np.triu_indices(len(rows), 1)
    keep = np.array([r["root"] for r in rows], object)
    keep = keep[a] != keep[b]
    if not rows[0]["same"]:
        side = np.array([r["lower"] for r in rows])
        keep &= side[a] != side[b]
    size = np.array([len(s) for s in sets], np.int64)
    keep &= share[1] * np.minimum(size[a], size[b]) >= share[0] * np.maximum(size[a], size[b])
    pairs = np.column_stack([a[keep], b[keep]])
    if not len(pairs):
        return []
    met = common(sets, pairs)
    linked = pairs[reaches(met, size[pairs[:, 0]], size[pairs[:, 1]], share)]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    out = []
    for x, y in linked.tolist():
        p, q = root(x), root(y)
        if p != q:
            top[q] = p
            out.append((rows[x]["fp"], rows[y]["fp"]))
    return out


def near_copies(docs: DataFrame, n: int = 3, share: tuple[int, int] = (85, 100), recall: float = 0.99999,
                rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id of
    its component), kept (is it that one).  Documents are linked when
    share[1] * intersection >= share[0] * union of their shingle sets."""
    bands = bands_for(share[0] / share[1], recall)
    signed = written(signatures(docs, n, bands, ROWS), "signatures")
    classes = signed.filter("size > 0").groupBy("fp").agg(
        F.min("doc_id").alias("least"), F.any_value("size").alias("size"), F.any_value("buckets").alias("buckets"))
    classes = written(classes, "classes")
    members = candidates(classes)
    wanted = members.select("fp").distinct()
    sets = written(full_sets(docs, classes.select(F.col("least").alias("of"), "fp").join(wanted, "fp", "left_semi"), n), "full-sets")

    links, labels = None, None
    for _ in range(rounds):
        rooted = with_labels(members, labels)
        met = written(rooted.join(open_buckets(rooted), "bucket"), "met")
        if met.isEmpty():
            break
        near = (F.col("root") != F.col("hub_root")) & may_reach(F.col("size"), F.col("hub_size"), share)
        edges = met.filter(near).select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()
        found = written(confirmed(edges, sets, share), "star-links")
        members = met.filter("fp <> hub").select("bucket", "fp", "size")
        links = found if links is None else links.unionByName(found)
        labels = labels_of(links)
    else:
        rooted = with_labels(members, labels)
        left = written(rooted.join(open_buckets(rooted).select("bucket"), "bucket", "left_semi"), "left")
        if not left.isEmpty():
            found = written(met_in_blocks(left, sets, share, block), "block-links")
            links = found if links is None else links.unionByName(found)
    roots = None if links is None else components(links).withColumnRenamed("node", "fp")

    known = written(with_labels(classes.select("fp", "least"), roots), "roots")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("fp", "component_id")
    out = signed.select("doc_id", "fp", F.col("size").alias("n_shingles")).join(known, "fp", "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def candidates(classes: DataFrame) -> DataFrame:
    """(bucket, fp, size) of buckets of two members or more, those of the same members once."""
    keyed = classes.select("fp", "size", F.explode("buckets").alias("bucket"))
    member = F.xxhash64("fp")
    buckets = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(member).alias("x"),
                                          F.bit_xor(F.xxhash64(F.lit(1), member)).alias("y")).filter("members > 1")
    buckets = buckets.groupBy("members", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    return written(keyed.join(buckets, "bucket", "left_semi"), "bucket-members")
