"""Subtree copies as a temporal range join turned into an equi join.

Every node alive under the copy source at the source revision is born
under the destination at the copy revision.  "Under the source" is an
equi join of the node's exploded ancestors (itself included) with the
source path; "alive at the source revision" is the interval predicate
applied after the equi join, so no nested loop is planned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.functions import paths as P
from revtrail.operators.intervals import Intervals, build_intervals
from revtrail.session import cut_lineage, let_go
from revtrail.sources.adapters import SEQ_COPY


def copy_rows(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("copyfrom_rev") != -1).select(
        "origin", "rev", F.col("path").alias("dst"), F.col("copyfrom_path").alias("src"),
        F.col("copyfrom_rev").alias("src_rev"))


def expand_once(copies: DataFrame, iv: Intervals) -> DataFrame:
    """Put rows (seq = copy) for every node alive under a copy source, with
    the node each was copied from (src_path, src_rev)."""
    nodes = (iv.files.select("origin", "path", F.lit("file").alias("kind"), "blob_id", "length",
                             "from_rev", "to_rev")
             .unionByName(iv.dirs.select("origin", "path", F.lit("dir").alias("kind"),
                                         F.lit(None).cast("string").alias("blob_id"),
                                         F.lit(None).cast("long").alias("length"),
                                         "from_rev", "to_rev")))
    srcs = copies.select("origin", F.col("src").alias("anc")).distinct()
    # the root ("") is above every path; only ancestors as deep as some source can be one
    depth = lambda c: F.when(c == "", 0).otherwise(F.size(F.split(c, "/")))
    deep = [r["d"] for r in srcs.select(depth(F.col("anc")).alias("d")).distinct().collect()]
    above = F.concat(F.array(F.lit("")), P.ancestors(F.col("path"), include_self=True))
    under = nodes.select("*", F.explode(above).alias("anc")).where(depth(F.col("anc")).isin(deep)).join(srcs, ["origin", "anc"], "left_semi")
    hit = under.join(copies.withColumnRenamed("src", "anc"), ["origin", "anc"]) \
        .where((F.col("from_rev") <= F.col("src_rev")) & (F.col("src_rev") < F.col("to_rev")))
    rel = F.when(F.col("anc") == "", F.concat(F.lit("/"), F.col("path"))).otherwise(
        F.substring(F.col("path"), F.length("anc") + 1, 1 << 30))
    return hit.select(
        "origin", "rev", F.lit(SEQ_COPY).alias("seq"), F.concat(F.col("dst"), rel).alias("path"),
        "kind", F.lit("put").alias("action"), F.lit(None).cast("string").alias("copyfrom_path"),
        F.lit(-1).cast("long").alias("copyfrom_rev"), "blob_id", "length",
        F.col("path").alias("src_path"), "src_rev")


def as_changes(expanded: DataFrame) -> DataFrame:
    return expanded.drop("src_path", "src_rev")


def cleared(copies: DataFrame) -> DataFrame:
    """What a copy does besides its nodes: its destination is cleared first (a
    no-op when it does not exist); the root has no node of its own, so a
    copy of it makes the destination."""
    none = [F.lit(None).cast("string").alias("copyfrom_path"), F.lit(-1).cast("long").alias("copyfrom_rev"),
            F.lit(None).cast("string").alias("blob_id"), F.lit(None).cast("long").alias("length")]
    row = lambda seq, action, path: ["origin", "rev", F.lit(seq).alias("seq"), path.alias("path"),
                                     F.lit("dir").alias("kind"), F.lit(action).alias("action"), *none]
    return (copies.select(*row(0, "delete", F.col("dst")))
            .unionByName(copies.where(F.col("src") == "").select(*row(SEQ_COPY, "put", F.col("dst")))))


def _touching(copies: DataFrame) -> DataFrame:
    """The copies that read at, below or above any copy's destination."""
    def up(c, name):
        paths = F.concat(F.array(F.lit("")), P.ancestors(F.col(c), include_self=True))
        return copies.select("*", F.explode(paths).alias(name))
    dsts = copies.select("origin", F.col("dst").alias("p")).distinct()
    below = up("src", "p").join(dsts, ["origin", "p"], "left_semi").drop("p")
    above = copies.select("origin", F.explode(F.concat(F.array(F.lit("")), P.ancestors(F.col("dst")))).alias("src")).distinct()
    return below.unionByName(copies.join(above, ["origin", "src"], "left_semi")).distinct()


def _top(path):
    """The first component of a path."""
    return F.substring_index(path, "/", 1)


def _ready(pending: DataFrame) -> DataFrame:
    """The copies that read nothing, at, below or above their source and at or
    before the revision they read, that another of them has still to make."""
    root = F.array(F.lit(""))
    first = lambda rows: rows.groupBy("origin", "p").agg(F.min("rev").alias("first"))
    at = first(pending.select("origin", F.col("dst").alias("p"), "rev"))
    below = first(pending.select("origin", F.explode(F.concat(root, P.ancestors(F.col("dst")))).alias("p"), "rev"))
    up = pending.select("*", F.explode(F.concat(root, P.ancestors(F.col("src"), include_self=True))).alias("p")).join(at, ["origin", "p"])
    down = pending.withColumn("p", F.col("src")).join(below, ["origin", "p"])
    waiting = up.unionByName(down).where(F.col("first") <= F.col("src_rev")).select(*pending.columns).distinct()
    return pending.subtract(waiting)  # also told apart where a column is null


@dataclass
class Expanded:
    changes: DataFrame      # with every copy as put rows
    intervals: Intervals
    lineage: DataFrame      # origin, path, rev, src_path, src_rev of every copied node


def expand_copies(changes: DataFrame, last_rev: int | None = None) -> Expanded:
    """Changes with every copy expanded into put rows, their intervals, and
    where every copied node came from.

    A copy that reads clear of all copy destinations is expanded once, from
    the intervals without copies.  The others are expanded in rounds, each
    once: a copy reads an earlier revision than its own, so in every round
    some read only what earlier rounds have made, and a chain of copies takes
    one round per link.  Expanded rows land at or below destinations and imply what
    is above, all with the first component of a destination.  Changes are
    dealt once by that: the paths outside get their intervals once, and only
    the others are built again, and read alone where no source is outside.
    ``last_rev``: no change is later, if known.
    """
    copies = cut_lineage(copy_rows(changes))
    plain = changes.where(F.col("copyfrom_rev") == -1)
    if copies.isEmpty():
        none = copies.select("origin", F.col("dst").alias("path"), "rev", F.col("src").alias("src_path"), "src_rev")
        return Expanded(plain, build_intervals(plain, last_rev), none)
    if not copies.where(F.col("src_rev") >= F.col("rev")).isEmpty():
        raise ValueError("a copy reads a revision that isn't before its own")
    plain = plain.unionByName(cleared(copies))
    tops = copies.select("origin", _top(F.col("dst")).alias("top")).distinct().withColumn("inside", F.lit(True))
    dealt = cut_lineage(plain.withColumn("top", _top(F.col("path"))).join(tops, ["origin", "top"], "left")
                        .select(*plain.columns, F.col("inside").isNotNull().alias("inside")))
    inside, plain = dealt.where("inside").drop("inside"), dealt.drop("inside")
    known = () if last_rev is None else (last_rev,)
    outside = build_intervals(dealt.where("not inside").drop("inside"), *known)

    def with_outside(own: Intervals) -> Intervals:
        return Intervals(outside.files.unionByName(own.files), outside.dirs.unionByName(own.dirs))

    pending = cut_lineage(_touching(copies))
    clear = copies.join(pending, copies.columns, "left_anti")
    if clear.join(tops, (tops["origin"] == clear["origin"]) & (tops["top"] == _top(clear["src"])), "left_semi").isEmpty():
        expanded = cut_lineage(expand_once(clear, outside))
    else:
        own = build_intervals(inside, *known)
        expanded = cut_lineage(expand_once(clear, with_outside(own)))
        let_go(*own.held)
    while True:
        own = build_intervals(inside.unionByName(as_changes(expanded)), *known)
        if pending.isEmpty():
            break
        ready = cut_lineage(_ready(pending))
        # a source touches a destination, so only the root reaches outside
        read = own if ready.where("src = ''").isEmpty() else with_outside(own)
        expanded = expanded.unionByName(cut_lineage(expand_once(ready, read)))
        pending = cut_lineage(pending.subtract(ready))
        let_go(*own.held)
    return Expanded(plain.unionByName(as_changes(expanded)), with_outside(own), lineage_of(expanded, copies, plain))


def lineage_of(expanded: DataFrame, copies: DataFrame, plain: DataFrame) -> DataFrame:
    """(origin, path, rev, src_path, src_rev) of the copied nodes, copies of
    the root included, that their own revision doesn't delete again,
    themselves or an ancestor."""
    undone = plain.where((F.col("action") == "delete") & (F.col("seq") > SEQ_COPY)).select("origin", "rev", F.col("path").alias("anc"))
    roots = copies.where(F.col("src") == "").select("origin", F.col("dst").alias("path"), "rev", F.col("src").alias("src_path"), "src_rev")
    rows = expanded.select("origin", "path", "rev", "src_path", "src_rev").unionByName(roots)
    gone = rows.select("origin", "path", "rev", F.explode(P.ancestors(F.col("path"), include_self=True)).alias("anc")) \
        .join(undone, ["origin", "rev", "anc"], "left_semi").select("origin", "path", "rev").distinct()
    return rows.join(gone, ["origin", "path", "rev"], "left_anti")
