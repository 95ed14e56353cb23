"""Validity intervals of every node: the replay of a change log as windows.

Rather than mutating a tree revision after revision, each path gets
*versions* ``[from_rev, to_rev)``.  A version starts at a put of the path
(explicit, or implied by a put below it) and ends at the next event on
the path itself or at the first later delete of any ancestor, whichever
comes first.  A delete of an ancestor is always effective for a live
path, because a live path implies live ancestors; deletes of dead paths
start no version and therefore vanish.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions import paths as P
from revtrail.functions.hashing import INF_REV
from revtrail.operators.ordinals import next_matching
from revtrail.session import cut_lineage, dealt, let_go

SEQ_PUT = 2
REV_BUCKET = 4096  # revisions per block of the skew-split windows


def _rev_bucket(c):
    return F.floor(c / REV_BUCKET)


@dataclass
class Intervals:
    files: DataFrame       # origin, path, parent, name, depth, blob_id, length, from_rev, to_rev
    dirs: DataFrame        # origin, path, parent, name, depth, from_rev, to_rev (lifetimes)
    held: list[DataFrame] = field(default_factory=list)  # the tables they are read from

    def below(self, path: str) -> Intervals:
        """Of what is at and below ``path``."""
        inside = (F.col("path") == path) | F.col("path").startswith(f"{path}/")
        return Intervals(self.files.where(inside), self.dirs.where(inside))


def with_path_parts(df: DataFrame) -> DataFrame:
    return (df.withColumn("parent", P.parent(F.col("path")))
            .withColumn("name", P.basename(F.col("path")))
            .withColumn("depth", P.depth(F.col("path"))))


def node_events(changes: DataFrame) -> DataFrame:
    """Puts (explicit and implied parents) and deletes, one row per event."""
    puts = changes.where(F.col("action") == "put").select(
        "origin", "rev", "seq", "path", "kind", "blob_id", "length")
    implied = puts.select(
        "origin", "rev", "seq", F.explode(P.ancestors(F.col("path"))).alias("path"),
        F.lit("dir").alias("kind"), F.lit(None).cast("string").alias("blob_id"),
        F.lit(None).cast("long").alias("length")).distinct()
    dels = changes.where(F.col("action") == "delete").select(
        "origin", "rev", "seq", "path", "kind", F.lit(None).cast("string").alias("blob_id"),
        F.lit(None).cast("long").alias("length"))
    return (puts.unionByName(implied).withColumn("is_put", F.lit(True))
            .unionByName(dels.withColumn("is_put", F.lit(False))))


def ancestor_deaths(versions: DataFrame, deletes: DataFrame, split: bool = False) -> DataFrame:
    """First delete of any ancestor strictly after each version start.

    Returns (origin, path, from_rev, anc_death).  Only versions below a
    path that is ever deleted are probed (semi join on the deleted paths).
    """
    del_paths = deletes.select("origin", F.col("path").alias("anc")).distinct()
    probes = (versions.select("origin", "path", "from_rev",
                              F.explode(P.ancestors(F.col("path"))).alias("anc"))
              .join(del_paths, ["origin", "anc"], "left_semi"))
    u = (probes.select("origin", "anc", F.col("from_rev").alias("t"), F.lit(SEQ_PUT).alias("s"),
                       "path", F.lit(None).cast("long").alias("del_rev"))
         .unionByName(deletes.select("origin", F.col("path").alias("anc"), F.col("rev").alias("t"),
                                     F.col("seq").alias("s"), F.lit(None).cast("string").alias("path"),
                                     F.col("rev").alias("del_rev"))))
    held = None
    if split:
        u, held = next_matching(u, ["origin", "anc"], "t", "s", _rev_bucket,
                                F.col("path").isNull(), ["del_rev"], out="nd")
        nd = F.col("nd.del_rev")
    else:
        # descending order: the rows before a probe are the events after it
        w = (Window.partitionBy("origin", "anc").orderBy(F.col("t").desc(), F.col("s").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
        nd = F.last("del_rev", ignorenulls=True).over(w)
    deaths = (u.withColumn("_nd", nd).where(F.col("path").isNotNull())
              .groupBy("origin", "path", F.col("t").alias("from_rev"))
              .agg(F.min("_nd").alias("anc_death")))
    deaths = cut_lineage(deaths)
    if held is not None:
        held.unpersist()
    return deaths


def build_intervals(changes: DataFrame, last_rev: int | None = None) -> Intervals:
    # one row per (path, revision, order): implied parent puts repeat
    # implied parent puts repeat within a revision; duplicates that remain
    # (an explicit and an implied put of one directory) give zero-length
    # versions, dropped below
    ev = node_events(changes)
    # Histories longer than one block of revisions get the block-split
    # windows (a hot path or ancestor is spread over its blocks); shorter
    # ones fit in one block, where the split cannot help.
    if last_rev is None:
        last_rev = changes.agg(F.max("rev")).first()[0] or 0
    split = last_rev >= REV_BUCKET
    if split:
        nx, held = next_matching(ev, ["origin", "path"], "rev", "seq", _rev_bucket, F.lit(True),
                                 ["rev", "is_put"], out="nx")
        nx = nx.withColumn("next_rev", F.col("nx.rev")) \
            .withColumn("next_is_put", F.col("nx.is_put")).drop("nx")
        ev = cut_lineage(nx)
        held.unpersist()
    else:
        w = Window.partitionBy("origin", "path").orderBy("rev", "seq")
        ev = cut_lineage(dealt(ev, "origin", "path").withColumn("next_rev", F.lead("rev").over(w))
                         .withColumn("next_is_put", F.lead("is_put").over(w)))
    versions = ev.where("is_put").select(
        "origin", "path", "kind", "blob_id", "length", F.col("rev").alias("from_rev"),
        "next_rev", "next_is_put")
    deletes = ev.where(~F.col("is_put")).select("origin", "path", "rev", "seq")
    inf = F.lit(INF_REV).cast("long")
    dying = not deletes.isEmpty()
    if dying:
        deaths = ancestor_deaths(versions, deletes, split)
        versions = versions.join(deaths, ["origin", "path", "from_rev"], "left")
    else:
        versions = versions.withColumn("anc_death", F.lit(None).cast("long"))
    versions = (versions.withColumn("anc_death", F.coalesce("anc_death", inf))
                .withColumn("to_rev", F.least(F.coalesce("next_rev", inf), F.col("anc_death")))
                .withColumn("continues", F.coalesce(F.col("next_is_put"), F.lit(False))
                            & (F.col("next_rev") < F.col("anc_death")))
                .where(F.col("from_rev") < F.col("to_rev")))
    if dying:  # else a projection of what has been cut
        versions = cut_lineage(versions)
        let_go(ev, deaths)
        ev = versions
    files = with_path_parts(
        versions.where(F.col("kind") == "file")
        .select("origin", "path", "blob_id", "length", "from_rev", "to_rev", "continues"))
    dv = versions.where(F.col("kind") == "dir").select("origin", "path", "from_rev", "to_rev",
                                                        "continues")
    lw = Window.partitionBy("origin", "path").orderBy("from_rev")
    dv = (dv.withColumn("born", ~F.coalesce(F.lag("continues").over(lw), F.lit(False)))
          .withColumn("life", F.sum(F.col("born").cast("int")).over(
              lw.rowsBetween(Window.unboundedPreceding, 0))))
    dirs = with_path_parts(dv.groupBy("origin", "path", "life").agg(
        F.min("from_rev").alias("from_rev"), F.max("to_rev").alias("to_rev")).drop("life"))
    dirs = cut_lineage(dirs)
    return Intervals(files, dirs, [ev, dirs])


def lifetimes(versions: DataFrame) -> DataFrame:
    """Merge consecutive versions of a path that follow each other without
    a delete in between: (origin, path, life_from, life_to)."""
    lw = Window.partitionBy("origin", "path").orderBy("from_rev")
    v = (versions.withColumn("born", ~F.coalesce(F.lag("continues").over(lw), F.lit(False)))
         .withColumn("life", F.sum(F.col("born").cast("int")).over(
             lw.rowsBetween(Window.unboundedPreceding, 0))))
    return v.groupBy("origin", "path", "life").agg(
        F.min("from_rev").alias("life_from"), F.max("to_rev").alias("life_to")).drop("life")
