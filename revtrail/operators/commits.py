"""Reads of the commit log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.functions import paths as P
from revtrail.operators.intervals import node_events
from revtrail.operators.ordinals import dense_ordinal


def scan_log(commits: DataFrame, changes: DataFrame, start: int = 1, end: int | None = None, paths: DataFrame | None = None,
             limit: int = 0, with_paths: bool = True) -> DataFrame:
    """Commits with ``start <= rev <= end``, the first ``limit`` per origin (0:
    all), those only that change something at or below one of ``paths``
    (origin, path).  A row per changed path: its action, and copy source if
    any; without paths a row per commit with nulls and has_changes false."""
    c = commits.where((F.col("rev") >= start) & (F.col("rev") <= (F.lit(end) if end is not None else F.col("rev"))))
    own = changes.select("origin", "rev", "path", "action", "copyfrom_path", "copyfrom_rev")
    if paths is not None:
        top = F.concat(F.array(F.lit("")), P.ancestors(F.col("path"), include_self=True))
        hit = own.select("origin", "rev", F.explode(top).alias("path")).join(paths, ["origin", "path"], "left_semi")
        c = c.join(hit.select("origin", "rev"), ["origin", "rev"], "left_semi")
    if limit:
        c = dense_ordinal(c, ["origin"], [F.col("rev")], F.floor(F.col("rev") / 4096), out="_n").where(F.col("_n") <= limit).drop("_n")
    if not with_paths:
        none = F.lit(None).cast("string")
        return c.select("*", none.alias("path"), none.alias("action"), none.alias("copyfrom_path"),
                        F.lit(None).cast("long").alias("copyfrom_rev"), F.lit(False).alias("has_changes"))
    return c.join(own, ["origin", "rev"], "left").withColumn("has_changes", F.col("path").isNotNull())


def commit_info(commits: DataFrame, wanted: DataFrame) -> DataFrame:
    """The commits of ``wanted`` (origin, rev); those that don't exist have no row."""
    return commits.join(wanted.select("origin", "rev").distinct(), ["origin", "rev"], "left_semi")


def normalized(changes: DataFrame, props: DataFrame) -> DataFrame:
    """Every event as one kind of row in the order in which events count:
    (origin, rev, seq, path, kind, event, detail) with events delete, copy
    (detail: source@revision), put and the put of parents it implies, and
    property changes (detail: name=value, name alone if unset).  What is put
    where the same revision deletes is a replace."""
    copies = changes.where(F.col("copyfrom_rev") != -1).select(
        "origin", "rev", "seq", "path", "kind", F.lit("copy").alias("event"),
        F.concat("copyfrom_path", F.lit("@"), F.col("copyfrom_rev").cast("string")).alias("detail"))
    gone = changes.where(F.col("action") == "delete").select("origin", "rev", "path").distinct().withColumn("gone", F.lit(True))
    nodes = node_events(changes.where(F.col("copyfrom_rev") == -1)).join(gone, ["origin", "rev", "path"], "left")
    event = F.when(~F.col("is_put"), "delete").when(F.col("gone"), "replace").otherwise("put")
    nodes = nodes.select("origin", "rev", "seq", "path", "kind", event.alias("event"), F.lit(None).cast("string").alias("detail"))
    changed = props.select("origin", "rev", F.lit(3).alias("seq"), "path", F.lit(None).cast("string").alias("kind"), F.lit("property").alias("event"),
                           F.when(F.col("value").isNull(), F.col("name")).otherwise(F.concat("name", F.lit("="), "value")).alias("detail"))
    return nodes.unionByName(copies).unionByName(changed)
