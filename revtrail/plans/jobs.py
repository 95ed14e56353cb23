"""Shared, materialised pipeline results per (session, input folder).

Several registered queries read the same load (the intervals, trees and
revisions of one change log).  The load checkpoints its intermediate
levels, so one session computes it once and every query reads the
checkpointed tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from revtrail.plans.load import LoadResult, load
from revtrail.session import cut_lineage, fingerprint
from revtrail.sources import adapters
from revtrail.sources.adapters import ChangeLog

_CACHE: dict[tuple, object] = {}
_SEEN: dict[tuple, str] = {}


def memo(spark: SparkSession, sf_dir: str, name: str, build):
    """What ``build`` makes, once per application and state of the input
    folder: changed files are seen, and what was made of the old ones is let go."""
    where = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    now = fingerprint(spark, sf_dir)
    if _SEEN.get(where) != now:
        for key in [k for k in _CACHE if k[:2] == where or k[0] != where[0]]:
            del _CACHE[key]
        _SEEN[where] = now
    key = (*where, name)
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def events_load(spark: SparkSession, sf_dir: str) -> LoadResult:
    return memo(spark, sf_dir, "events_load",
                lambda: load(adapters.events_changelog(spark, sf_dir)))


def export_load(spark: SparkSession, sf_dir: str) -> LoadResult:
    """Load of the log whose files properties change."""
    def build():
        log, props, variants = adapters.events_export_log(spark, sf_dir)
        return load(log, props=props, variants=variants)
    return memo(spark, sf_dir, "export_load", build)


def conversations_load(spark: SparkSession, sf_dir: str) -> LoadResult:
    return memo(spark, sf_dir, "conversations_load",
                lambda: load(adapters.conversations_changelog(spark, sf_dir)))


def nations_load(spark: SparkSession, sf_dir: str) -> LoadResult:
    return memo(spark, sf_dir, "nations_load",
                lambda: load(adapters.nations_changelog(spark, sf_dir)))


def events_visits(spark: SparkSession, sf_dir: str):
    from revtrail.plans.visits import synthetic_visits
    return memo(spark, sf_dir, "events_visits",
                lambda: cut_lineage(synthetic_visits(events_load(spark, sf_dir).revisions)))


def last_loaded(spark: SparkSession, sf_dir: str):
    """(origin, last_loaded_rev) of the event log's origins, -1 for none."""
    from revtrail.plans.visits import last_loaded_rev

    def build():
        res = events_load(spark, sf_dir)
        return cut_lineage(last_loaded_rev(res.log.origins, events_visits(spark, sf_dir), res.revisions))
    return memo(spark, sf_dir, "last_loaded", build)


def history_check(spark: SparkSession, sf_dir: str):
    """Recompute the id of each origin's last archived revision from the
    current log and its archived parent; compare with the archived id.

    The archive is the event load, where origins with ``user_id % 7 = 0``
    had the last archived revision written from a different message
    (history rewritten since) -- a failure-injection table like the
    reference's altered-history tests.
    """
    from revtrail.operators.chain import revision_bodies, revision_chain

    def build():
        res = events_load(spark, sf_dir)
        llr = last_loaded(spark, sf_dir).where(F.col("last_loaded_rev") >= 1)
        uid = F.regexp_extract("origin", r"(\d+)$", 1).cast("long")
        # of a history the last archived revision and its parent count
        archived = (res.revisions.join(llr, "origin").where(F.col("rev").between(F.col("last_loaded_rev") - 1, F.col("last_loaded_rev")))
                    .withColumn("revision_id", F.when(
                        (uid % 7 == 0) & (F.col("rev") == F.col("last_loaded_rev")),
                        F.sha1(F.concat(F.lit("tampered "), F.col("revision_id"))))
                        .otherwise(F.col("revision_id")))
                    .select("origin", "rev", "revision_id"))
        archived = cut_lineage(archived)
        at_p = res.log.commits.join(llr, "origin").where(F.col("rev") == F.col("last_loaded_rev"))
        bodies = revision_bodies(at_p.drop("last_loaded_rev"), res.tree_at_rev, res.log.origins)
        parents = (archived.join(llr, "origin").where(F.col("rev") == F.col("last_loaded_rev") - 1)
                   .select("origin", F.col("revision_id").alias("seed_parent")))
        recomputed = revision_chain(bodies, parents)
        return (recomputed.join(archived.withColumnRenamed("revision_id", "archived_id"),
                                ["origin", "rev"])
                .select("origin", "rev", (F.col("revision_id") == F.col("archived_id"))
                        .alias("unaltered")).cache())
    return memo(spark, sf_dir, "history_check", build)


def orders_load(spark: SparkSession, sf_dir: str) -> LoadResult:
    return memo(spark, sf_dir, "orders_load",
                lambda: load(adapters.orders_changelog(spark, sf_dir)))


def orders_export_load(spark: SparkSession, sf_dir: str) -> LoadResult:
    """Load of the orders log with chains of copies and properties."""
    def build():
        log, props, variants = adapters.orders_export_log(spark, sf_dir)
        return load(log, props=props, variants=variants)
    return memo(spark, sf_dir, "orders_export_load", build)


def halves(log: ChangeLog):
    """(the log up to each origin's midpoint, the midpoints: origin, at_rev)"""
    mid = log.commits.groupBy("origin").agg(F.floor(F.max("rev") / 2).cast("long").alias("at_rev"))
    upto = lambda df: df.join(mid, "origin").where(F.col("rev") <= F.col("at_rev")).drop("at_rev")
    return ChangeLog(log.origins, upto(log.commits), upto(log.changes)), mid


def events_until_mid(spark: SparkSession, sf_dir: str) -> LoadResult:
    return memo(spark, sf_dir, "events_until_mid", lambda: load(halves(adapters.events_changelog(spark, sf_dir))[0]))


def second_half(log: ChangeLog, props=None, variants=None, previous: LoadResult | None = None):
    """Revisions after the midpoints, loaded from what a load up to them has archived."""
    from revtrail.plans.load import latest_rev, load_incremental
    latest = latest_rev(log, props)
    before, mid = halves(log)
    if previous is None:
        early = None if props is None else props.join(mid, "origin").where(F.col("rev") <= F.col("at_rev")).drop("at_rev")
        previous = load(before, props=early, variants=variants, last_rev=latest)
    return load_incremental(log, previous, mid, props=props, variants=variants, latest=latest).revisions


def externals(spark: SparkSession, sf_dir: str) -> dict:
    """Externals of the event log: definitions, the exports they use, grafts
    and the nodes at every revision with externals applied."""
    from revtrail.operators.externals import applied

    def build():
        res = events_load(spark, sf_dir)
        return applied(adapters.events_externals(spark, sf_dir), res.log.origins, res.log.commits, res.intervals, res.lineage)
    return memo(spark, sf_dir, "externals", build)


def externals_trees(spark: SparkSession, sf_dir: str):
    """Tree versions of the event log with externals applied."""
    from revtrail.operators.externals import as_intervals
    from revtrail.operators.trees import build_trees
    return memo(spark, sf_dir, "externals_trees", lambda: build_trees(
        as_intervals(externals(spark, sf_dir)["nodes"]), events_load(spark, sf_dir).log.origins))
