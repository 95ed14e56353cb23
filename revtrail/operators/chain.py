"""Revision identifiers: a hash chain, folded per origin.

Every revision body embeds its parent's id, so the ids of one origin are
a strict sequential fold -- no Spark expression can evaluate it in
parallel.  Everything that *can* be parallel is done first in the JVM
(tree ids, the text of each body without its parent line); the fold then
only concatenates and hashes ~200 bytes per revision.  The rows are
clustered by origin and sorted by revision inside each partition, and an
Arrow-batched Python function streams through them with constant memory
(state: the previous id), so no origin is ever collected into one array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.hashing import revision_manifest_parts

CHAIN_SCHEMA = "origin string, rev long, tree_id string, times long, revision_id string"


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cur_origin = None
    prev = None
    for pdf in batches:
        out = []
        origins = pdf["origin"].tolist()
        prefixes = pdf["prefix"].tolist()
        suffixes = pdf["suffix"].tolist()
        seeds = pdf["seed_parent"].tolist()
        for o, pre, suf, seed in zip(origins, prefixes, suffixes, seeds):
            if o != cur_origin:
                cur_origin = o
                prev = seed if isinstance(seed, str) and seed else None
            body = pre + (f"parent {prev}\n" if prev else "") + suf
            raw = body.encode("utf-8")
            h = hashlib.sha1(b"commit %d\x00" % len(raw))
            h.update(raw)
            prev = h.hexdigest()
            out.append(prev)
        yield pd.DataFrame({"origin": origins, "rev": pdf["rev"], "tree_id": pdf["tree_id"], "times": pdf["times"], "revision_id": out})


def with_uuids(commits: DataFrame, origins: DataFrame) -> DataFrame:
    """The commits of known repositories with the uuid of each."""
    return commits.join(origins.select("origin", "uuid"), "origin")


def revision_bodies(commits: DataFrame, tree_at_rev: DataFrame, origins: DataFrame) -> DataFrame:
    """commits (origin, rev, date, author, message) + tree id per revision
    + origin uuid."""
    return with_uuids(commits.join(tree_at_rev, ["origin", "rev"]), origins)


def revision_chain(bodies: DataFrame, seeds: DataFrame | None = None,
                   num_partitions: int | None = None, paired: bool = False) -> DataFrame:
    """bodies: origin, rev, and as of ``revision_bodies`` what a body is made
    of, or its parts already (prefix, suffix); seeds: origin, seed_parent
    (hex id of the archived revision the first new one hangs from).  The
    text of a body is written where it is hashed, so it isn't shuffled.
    ``paired``: a revision given k times counts as joined with itself on
    (origin, rev) before and after the fold, as a log with such rows always did."""
    made = "prefix" in bodies.columns
    names = ["prefix", "suffix"] if made else ["tree_id", "author", "date", "uuid", "message"]
    df = bodies.select("origin", "rev", *names)
    if "tree_id" not in names:
        df = df.withColumn("tree_id", F.lit(None).cast("string"))
    if seeds is not None:
        df = df.join(seeds.select("origin", "seed_parent"), "origin", "left")
    else:
        df = df.withColumn("seed_parent", F.lit(None).cast("string"))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartition(n, "origin")
    if paired:
        df = df.where(F.col("rev").isNotNull()).withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("origin", "rev")))
        df = df.withColumn("times", F.explode(F.array_repeat("times", F.col("times").cast("int"))))
    else:
        df = df.withColumn("times", F.lit(1).cast("long"))
    df = df.sortWithinPartitions("origin", "rev")
    if not made:
        prefix, suffix = revision_manifest_parts(F.col("tree_id"), F.col("author"), F.col("date"),
                                                 F.col("uuid"), F.col("rev"), F.col("message"))
        df = df.withColumns({"prefix": prefix, "suffix": suffix})
    out = df.select("origin", "rev", "tree_id", "times", "prefix", "suffix", "seed_parent").mapInPandas(_fold, CHAIN_SCHEMA)
    if paired:
        out = out.withColumn("times", F.explode(F.array_repeat("times", F.col("times").cast("int"))))
    return out.drop("times")
