"""Jobs for ``spark-submit``: ``python -m revtrail.main JOB SOURCE TARGET [option=value ...]``.

A source is a folder of change-log tables in Parquet (origins, commits,
changes and, if there are any, props and contents) or, for ``load_dump``, of
dump files; a target is an archive, or for ``export`` a folder.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrail.plans import visits as V
from revtrail.plans.archive import Archive, objects
from revtrail.plans.export import content_variants, export_tree
from revtrail.plans.load import LoadResult, load
from revtrail.plans.options import LoadOptions
from revtrail.session import configure, cut_lineage, path_exists
from revtrail.sources.adapters import ChangeLog

JOBS: dict[str, Callable] = {}


def job(fn):
    JOBS[fn.__name__] = fn
    return fn


def read_log(spark: SparkSession, source: str, options: LoadOptions) -> tuple[ChangeLog, DataFrame | None, DataFrame | None]:
    """(change log, property events, contents) of a source folder."""
    def table(name, needed=True):
        path = f"{source.rstrip('/')}/{name}"
        path = path if path_exists(spark, path) else f"{path}.parquet"
        if not needed and not path_exists(spark, path):
            return None
        df = spark.read.parquet(path)
        return df.where(F.col("origin").isin(options.origins.split(","))) if options.origins and "origin" in df.columns else df
    return ChangeLog(table("origins"), table("commits"), table("changes")), table("props", False), table("contents", False)


def run_load(log: ChangeLog, props: DataFrame | None, contents: DataFrame | None, options: LoadOptions) -> LoadResult:
    if props is None or contents is None or not options.properties:
        return load(log)
    variants = contents.select(*content_variants(F.col("data"))).dropDuplicates(["blob_id"])
    return load(log, props=props, variants=variants)


def altered(log: ChangeLog, archived: DataFrame, options: LoadOptions, res: LoadResult) -> DataFrame:
    """Origins of which a verified revision isn't the archived one any more."""
    checked = V.check_sample(log.commits.join(archived.groupBy("origin").agg(F.max("rev").alias("upto")), "origin").where(F.col("rev") <= F.col("upto")).drop("upto"),
                             options.check_revision, options.check_revision_from).where("verify").select("origin", "rev")
    now = res.revisions.join(checked, ["origin", "rev"]).select("origin", "rev", F.col("revision_id").alias("now"))
    return now.join(archived.select("origin", "rev", "id"), ["origin", "rev"]).groupBy("origin").agg((~F.bool_or(F.col("now") == F.col("id"))).alias("altered")) \
        .where("altered").select("origin")


@job
def load_log(spark: SparkSession, source: str, target: str, options: LoadOptions) -> DataFrame:
    """Load a change log into an archive; returns origin, load_status, visit_status, snapshot."""
    log, props, contents = read_log(spark, source, options)
    archive = Archive(spark, target)
    archived = cut_lineage(archive.read("revision").select("id", "origin", "rev"))
    heads = log.commits.groupBy("origin").agg(F.max("rev").alias("head"))
    known = archived.groupBy("origin").agg(F.max("rev").alias("last_loaded_rev"))
    if options.incremental:
        # the same head with the same message and author: nothing to do
        last = log.commits.join(heads, "origin").where(F.col("rev") == F.col("head")).select("origin", "rev", "author", "message")
        same = archive.read("revision").select("origin", "rev", "author", "message")
        stale = cut_lineage(last.join(known, "origin").where(F.col("rev") == F.col("last_loaded_rev")).join(same, ["origin", "rev", "author", "message"], "left_semi")
                            .select("origin").distinct())
    else:
        stale = log.origins.select("origin").limit(0)
    todo = lambda df: None if df is None else df.join(stale, "origin", "left_anti")
    part = ChangeLog(todo(log.origins), todo(log.commits), todo(log.changes))
    res = run_load(part, todo(props), contents, options)
    gone = cut_lineage(altered(part, archived, options, res)) if not archived.isEmpty() else archived.select("origin").limit(0)
    held = contents if contents is not None else res.intervals.files.select(F.col("blob_id").alias("id"), "length", F.lit(None).cast("binary").alias("data")) \
        .dropDuplicates(["id"])
    before = cut_lineage(archive.read("visit").groupBy("origin").agg(F.max_by("snapshot", "visit_date").alias("snapshot")))
    archive.append(f"visit-{options.visit_date}-{uuid.uuid4().hex[:8]}", objects(res, held, options.visit_date, options.max_content_size))
    out = log.origins.select("origin").join(res.snapshots.select("origin", F.col("snapshot_id").alias("new")), "origin", "left") \
        .join(before, "origin", "left").join(gone.withColumn("altered", F.lit(True)), "origin", "left")
    status = F.when(F.col("new").isNull() | F.col("new").eqNullSafe(F.col("snapshot")), "uneventful").otherwise("eventful")
    return out.select("origin", status.alias("load_status"), F.lit("full").alias("visit_status"), F.coalesce("new", "snapshot").alias("snapshot"),
                      F.coalesce("altered", F.lit(False)).alias("altered"))


@job
def check_dumps(spark: SparkSession, source: str, target: str, options: LoadOptions) -> DataFrame:
    """What the dump files of a folder hold, written to ``target``: file,
    complete records, truncated or not, last complete revision."""
    from revtrail.sources.dumps import dump_summary, read_records
    dump_summary(*read_records(spark, source)).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


@job
def export(spark: SparkSession, source: str, target: str, options: LoadOptions) -> DataFrame:
    """The exported tree of every origin's head, written to ``target`` by origin."""
    log, props, contents = read_log(spark, source, options)
    res = run_load(log, props, contents, options)
    heads = log.commits.groupBy("origin").agg(F.max("rev").alias("at_rev"))
    export_tree(res.exported.files, res.trees.dirs, heads).write.mode("overwrite").partitionBy("origin").parquet(target)
    return spark.read.parquet(target)


def main(words: list[str]) -> None:
    if len(words) < 3 or words[0] not in JOBS:
        raise SystemExit(f"{__doc__}\nJobs: {', '.join(JOBS)}")
    options = LoadOptions.parse(words[3:])
    spark = configure(SparkSession.builder.appName(f"revtrail-{words[0]}").getOrCreate())
    JOBS[words[0]](spark, words[1], words[2], options).show(20, truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
