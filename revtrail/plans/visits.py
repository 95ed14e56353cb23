"""Visit bookkeeping: which revisions to verify, where to resume, how a
visit ended.  All per-origin logic is expressed as projections, windows
and joins over small per-origin tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.urls import root_url_candidates
from revtrail.operators.ordinals import dense_ordinal


def emit_ordinal(commits: DataFrame, start: int = 1) -> DataFrame:
    """1-based ordinal of the revisions emitted in a run starting at ``start``."""
    emitted = commits.where(F.col("rev") >= start)
    return dense_ordinal(emitted, ["origin"], [F.col("rev")], F.floor(F.col("rev") / 4096),
                         out="ordinal")


def check_sample(commits: DataFrame, check_revision: int, check_from: int = 1,
                 start: int = 1) -> DataFrame:
    """Flag revisions whose replayed tree must be compared with an export:
    every ``check_revision``-th emitted revision at or after ``check_from``,
    and always the last revision of the run."""
    ords = emit_ordinal(commits, start)
    last = ords.groupBy("origin").agg(F.max("rev").alias("_last"))
    sampled = F.lit(False) if not check_revision else (
        (F.col("rev") >= check_from) & (F.col("ordinal") % check_revision == 0))
    return (ords.join(last, "origin")
            .withColumn("verify", sampled | (F.col("rev") == F.col("_last"))).drop("_last"))


# Visit statuses cycled through by the synthetic visit table.
VISIT_STATUSES = ["full", "partial", "failed", "not_found"]
VISIT_EVERY = 10


def synthetic_visits(revisions: DataFrame) -> DataFrame:
    """Adapter V: a visit after every ``VISIT_EVERY`` revisions of each
    origin, statuses cycling through ``VISIT_STATUSES``; successful visits
    (full, partial) carry a HEAD snapshot of the revision reached."""
    head = revisions.groupBy("origin").agg(F.max("rev").alias("head"))
    v = head.where(F.col("head") >= VISIT_EVERY).select(
        "origin", F.explode(F.sequence(F.lit(1), F.floor(F.col("head") / VISIT_EVERY).cast("int")))
        .alias("visit_no"))
    uid = F.regexp_extract("origin", r"(\d+)$", 1).cast("long")
    statuses = F.array(*[F.lit(s) for s in VISIT_STATUSES])
    v = v.withColumn("visit_rev", (F.col("visit_no") * VISIT_EVERY).cast("long")) \
        .withColumn("status", F.element_at(statuses, ((F.col("visit_no") + uid) % 4 + 1).cast("int")))
    at = revisions.where(F.col("rev") % VISIT_EVERY == 0).select("origin", F.col("rev").alias("visit_rev"), "tree_id", "revision_id")
    v = v.join(at, ["origin", "visit_rev"])
    from revtrail.functions.hashing import snapshot_branch_hex, snapshot_id
    branch = F.struct(F.lit("HEAD").cast("binary").alias("name"),
                      snapshot_branch_hex(F.lit("HEAD"), F.lit("revision"), F.col("revision_id"))
                      .alias("branch_hex"))
    ok = F.col("status").isin("full", "partial")
    return v.select("origin", "visit_no", "visit_rev", "status",
                    F.when(ok, snapshot_id(F.array(branch))).alias("snapshot_id"),
                    F.when(ok, F.col("revision_id")).alias("head_revision_id"))


def latest_visit(visits: DataFrame) -> DataFrame:
    w = Window.partitionBy("origin").orderBy(F.col("visit_no").desc())
    return visits.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_snapshot_revision(visits: DataFrame, revisions: DataFrame) -> DataFrame:
    """Newest visit with a snapshot -> its HEAD target -> that revision."""
    last = visits.where(F.col("snapshot_id").isNotNull()).groupBy("origin").agg(
        F.max_by("head_revision_id", "visit_no").alias("revision_id"))
    return last.join(revisions.select("origin", "revision_id", "rev"), ["origin", "revision_id"])


def last_loaded_rev(origins: DataFrame, visits: DataFrame, revisions: DataFrame) -> DataFrame:
    lsr = latest_snapshot_revision(visits, revisions)
    return origins.select("origin").join(lsr.select("origin", "rev"), "origin", "left").select(
        "origin", F.coalesce(F.col("rev"), F.lit(-1)).cast("long").alias("last_loaded_rev"))


def plan_range(heads: DataFrame, last_loaded: DataFrame, unaltered: DataFrame) -> DataFrame:
    """heads (origin, head), last_loaded (origin, last_loaded_rev),
    unaltered (origin, unaltered) -> (origin, start_rev, end_rev, uneventful)."""
    j = heads.join(last_loaded, "origin", "left").join(unaltered, "origin", "left")
    p = F.coalesce(F.col("last_loaded_rev"), F.lit(-1))
    start = (F.when(F.col("head") == 0, F.lit(0))
             .when(p < 0, F.lit(1))
             .when(F.coalesce(F.col("unaltered"), F.lit(True)), p + 1)
             .otherwise(F.lit(1)))
    end = F.when(F.col("head") == 0, F.lit(0)).otherwise(F.col("head"))
    return j.select("origin", start.cast("long").alias("start_rev"), end.cast("long").alias("end_rev"),
                    (start > end).alias("uneventful"))


def latest_snapshot(visits: DataFrame) -> DataFrame:
    """(origin, snapshot_id) of each origin's newest visit that has a snapshot."""
    return visits.where(F.col("snapshot_id").isNotNull()).groupBy("origin").agg(F.max_by("snapshot_id", "visit_no").alias("snapshot_id"))


def url_roots(urls: DataFrame, origins: DataFrame) -> DataFrame:
    """(url, origin, root_url, sub_path): the known repository whose url is the
    longest ``/``-prefix of each url; nulls if there is none."""
    cands = urls.select("url").distinct().select("url", F.posexplode(root_url_candidates(F.regexp_replace("url", "/+$", ""))).alias("pos", "cand"))
    hit = cands.join(origins.select(F.col("url").alias("cand"), "origin"), "cand")
    best = hit.groupBy("url").agg(F.min_by(F.struct("origin", F.col("cand").alias("root_url")), "pos").alias("b"))
    sub = F.regexp_replace(F.substring(F.col("url"), F.length("b.root_url") + 1, 1 << 30), "^/+|/+$", "")
    return urls.select("url").distinct().join(best, "url", "left").select(
        "url", F.col("b.origin").alias("origin"), F.col("b.root_url").alias("root_url"), sub.alias("sub_path"))


def last_seen(roots: DataFrame, commits: DataFrame, dirs: DataFrame) -> DataFrame:
    """``roots`` (origin, sub_path, ..) with latest, the origin's last
    revision, and head_rev, the last at which the sub path exists (null: never)."""
    latest = commits.groupBy("origin").agg(F.max("rev").alias("latest"))
    seen = dirs.groupBy("origin", F.col("path").alias("sub_path")).agg(F.max("to_rev").alias("until"))
    j = roots.join(latest, "origin", "left").join(seen, ["origin", "sub_path"], "left")
    head = F.when(F.col("sub_path") == "", F.coalesce("latest", F.lit(0))).when(
        F.col("until").isNotNull(), F.least(F.col("until") - 1, F.col("latest")))
    return j.withColumn("head_rev", head).drop("until")


def origin_info(urls: DataFrame, origins: DataFrame, commits: DataFrame, dirs: DataFrame) -> DataFrame:
    """(url, origin, root_url, sub_path, latest, head_rev, initial_rev) of
    urls of repositories and of directories in them."""
    found = last_seen(url_roots(urls, origins), commits, dirs)
    return found.withColumn("initial_rev", F.when(F.coalesce("latest", F.lit(0)) == 0, 0).otherwise(1))


def dump_plan(urls: DataFrame, origins: DataFrame, commits: DataFrame, dirs: DataFrame) -> DataFrame:
    """(url, dump_url, dump_max_rev, status): whole when the repository is
    known (up to the last revision where the url's path exists), sub_path
    when it is out of reach (the url itself, all of it), missing when the path never existed."""
    found = last_seen(url_roots(urls, origins), commits, dirs)
    status = (F.when(F.col("root_url").isNull(), "sub_path").when(F.col("head_rev").isNull(), "missing").otherwise("whole"))
    return found.withColumn("status", status).select(
        "url", F.when(F.col("status") == "whole", F.col("root_url")).when(F.col("status") == "sub_path", F.col("url")).alias("dump_url"),
        F.when(F.col("status") == "whole", F.col("head_rev")).alias("dump_max_rev"), "status")


def visit_outcome(plan: DataFrame, flags: DataFrame) -> DataFrame:
    """plan (origin, start_rev, end_rev, uneventful, last_loaded_rev) and
    flags (origin, not_found, fail_at, diverged, error) -> load status, visit
    status and the revision the new snapshot points to (NULL: none).
    ``fail_at`` is the first revision that can't be loaded (an exception, or
    the end of a truncated dump); ``error`` is any other failure."""
    j = plan.join(flags, "origin", "left")
    nf = F.coalesce("not_found", F.lit(False))
    error = F.coalesce("error", F.lit(False))
    failed_mid = F.col("fail_at").isNotNull() & (F.col("fail_at") <= F.col("end_rev"))
    diverged = F.coalesce("diverged", F.lit(False))
    prev = F.when(F.col("last_loaded_rev") >= 0, F.col("last_loaded_rev"))
    last_good = F.when(failed_mid, F.when(F.col("fail_at") - 1 >= F.col("start_rev"),
                                           F.col("fail_at") - 1).otherwise(prev))
    load_status = (F.when(nf, "uneventful").when(F.col("uneventful"), "uneventful")
                   .when(error | diverged, "failed")
                   .when(failed_mid & (last_good.isNull() | (last_good == prev)), "uneventful")
                   .otherwise("eventful"))
    visit_status = (F.when(nf, "not_found").when(F.col("uneventful"), "full")
                    .when(error, "failed").when(failed_mid | diverged, "partial").otherwise("full"))
    snap_rev = (F.when(nf, F.lit(None)).when(F.col("uneventful"), prev).when(error, F.lit(None))
                .when(failed_mid, last_good).otherwise(F.col("end_rev")))
    return j.select("origin", load_status.alias("load_status"), visit_status.alias("visit_status"),
                    snap_rev.cast("long").alias("snapshot_rev"))
