"""Incremental visits as a Structured Streaming job.

New events arrive as files; each trigger runs ``foreachBatch`` which
continues every touched origin from its persisted state -- last
revision number, last event, last revision id, the tree in force (open
intervals as put rows) and, where files are hashed as exported, the property
values in force and the variants of the contents -- instead of replaying
from revision 1.

*Exactly once.*  State and output are partitioned by the batch that wrote
them.  Batch N reads, for each bucket of origins, the newest state of a
batch before N, and overwrites only partitions of batch N.  So a batch that
is run again after a failure, however far it came, writes the same rows to
the same place.  A batch rewrites only the buckets it touches, so its cost
follows the touched origins, not the whole archive.  Which partitions are
the newest is read from the folder names; older ones than the two a bucket
may need are removed.

*Order.*  Revisions are numbered by (time, event id) per origin.  Events
that sort after the last one continue the origin, also at an equal time.
An event that sorts before it alters the history: its origin is loaded
anew from all its events, and the rows of that batch on count
(``reloaded`` is the batch of the last such load).  Events are kept by
bucket; those of other buckets aren't read for that, and none are while
nothing is late.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrail.operators.ordinals import dense_ordinal
from revtrail.operators.props import lean_variants
from revtrail.plans.load import REV_BUCKET, archived_props, archived_state, load
from revtrail.session import children, cut_lineage, ensure_checkpoint_dir, path_exists
from revtrail.sources.adapters import ChangeLog, events_to_changelog, events_to_export, uuid_of
from revtrail.sources.tables import TABLE_SCHEMAS

HEADS = "origin string, reloaded long, last_rev long, last_ts timestamp_ntz, last_event long, last_id string"
TREE = ("origin string, rev long, seq int, path string, kind string, action string, copyfrom_path string, "
        "copyfrom_rev long, blob_id string, length long")
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, origin string, k int"
PROPS = "origin string, rev long, path string, name string, value string"
VARIANTS = "origin string, blob_id string, link_id string, id_lf string, id_crlf string, id_cr string"


def _events(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("event_id").cast("long").alias("event_id"), "ts", F.col("user_id").cast("long").alias("user_id"), "event_type",
                      F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("origin"),
                      F.get_json_object("props", "$.k").cast("int").alias("k"))


class VisitStream:
    """``buckets``: files of the state tables; fixed for a stream's life, so
    set it to the archive's size when the stream is created.  ``export``:
    files are hashed as exported, with their properties."""

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = 64, export: bool = False):
        self.spark = spark
        self.buckets = buckets
        self.export = export
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = root or f"{base}/revtrail-stream-{uuid.uuid4().hex}"
        self.incoming = f"{self.root}/incoming"
        self.revisions = f"{self.root}/out/revisions"  # by batch; see read_revisions
        self.checkpoint = f"{self.root}/checkpoint"

    # ---------------------------------------------------------------- state
    def _table(self, name: str) -> str:
        return f"{self.root}/state/{name}"

    def _bucket(self, c):
        return F.pmod(F.hash(c), F.lit(self.buckets))

    def _parts(self, path: str, batch_id: int, wanted: list[int]) -> dict[int, list[int]]:
        """Of each wanted bucket the batches before ``batch_id`` that wrote it, in order."""
        found: dict[int, list[int]] = {}
        for bkt in wanted:
            batches = sorted(int(n.removeprefix("batch=")) for n in children(self.spark, f"{path}/bkt={bkt}") if n.startswith("batch="))
            found[bkt] = [b for b in batches if b < batch_id]
        return found

    def _state(self, name: str, schema: str, batch_id: int, wanted: list[int]) -> DataFrame:
        """Of each wanted bucket the rows of the newest batch before ``batch_id``."""
        path = self._table(name)
        parts = self._parts(path, batch_id, wanted)
        for bkt, batches in parts.items():
            for old in batches[:-2]:  # a batch before this one might run again and read the last but one
                p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bkt={bkt}/batch={old}")
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        files = [f"{path}/bkt={bkt}/batch={batches[-1]}" for bkt, batches in parts.items() if batches]
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files)

    def _history(self, batch_id: int, wanted: list[int]) -> DataFrame:
        """All events of the wanted buckets up to this batch."""
        path = self._table("events")
        parts = self._parts(path, batch_id + 1, wanted)
        files = [f"{path}/bkt={bkt}/batch={b}" for bkt, batches in parts.items() for b in batches]
        return self.spark.read.schema(EVENTS).parquet(*files).dropDuplicates(["origin", "event_id"])

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        # written once, where a reload finds them, and read back from there
        self._put(_events(batch).withColumn("bkt", self._bucket(F.col("origin"))), self._table("events"), batch_id, "bkt")
        written = [f"{self._table('events')}/bkt={bkt}/batch={batch_id}" for bkt in range(self.buckets)]
        written = {bkt: path for bkt, path in enumerate(written) if path_exists(self.spark, path)}
        touched = sorted(written)
        if not touched:
            return
        ev = self.spark.read.schema(EVENTS).parquet(*written.values()).drop("user_id")
        heads = self._state("heads", HEADS, batch_id, touched)
        tree = self._state("tree", TREE, batch_id, touched)
        # an origin is late if its first event of the batch is
        arrived = cut_lineage(ev.groupBy("origin").agg(F.min(F.struct("ts", "event_id")).alias("first"), F.count(F.lit(1)).alias("n")))
        is_late = F.col("first") <= F.struct("last_ts", "last_event")
        altered = cut_lineage(arrived.join(heads, "origin").where(F.col("last_ts").isNotNull() & is_late).select("origin"))
        late = sorted(r[0] for r in altered.select(self._bucket(F.col("origin"))).distinct().collect())
        known = heads.select("origin", "last_rev", "reloaded")
        if late:
            again = self._history(batch_id, late).join(altered, "origin", "left_semi")
            ev = ev.join(altered, "origin", "left_anti").unionByName(again.drop("user_id"))
            known = known.join(altered, "origin", "left_anti").unionByName(
                altered.select("origin", F.lit(None).cast("long").alias("last_rev"), F.lit(batch_id).cast("long").alias("reloaded")))
            most = ev.groupBy("origin").count().agg(F.max("count")).first()[0]
        else:
            most = arrived.agg(F.max("n")).first()[0]
        ev = dense_ordinal(ev, ["origin"], ["ts", "event_id"], F.to_date("ts"), out="n", split=most >= REV_BUCKET)
        ev = ev.join(known, "origin", "left").withColumn("reloaded", F.coalesce("reloaded", F.lit(-1).cast("long")))
        ev = cut_lineage(ev.withColumn("rev", F.coalesce("last_rev", F.lit(0)) + F.col("n")).drop("n", "last_rev"))
        last_rev = ev.agg(F.max("rev")).first()[0] or 0
        log, props, variants = events_to_export(ev) if self.export else (events_to_changelog(ev), None, None)
        origins = cut_lineage(ev.select("origin").distinct().select(
            "origin", uuid_of(F.col("origin")).alias("uuid"),
            F.concat(F.lit("file:///repos/"), F.col("origin")).alias("url")))
        goes_on = origins.select("origin").join(altered, "origin", "left_anti") if late else origins.select("origin")
        prior = tree.where(F.col("action") == "put").join(goes_on, "origin", "left_semi")
        if self.export:
            old_props = self._state("props", PROPS, batch_id, touched)
            old_variants = self._state("variants", VARIANTS, batch_id, touched)
            props = cut_lineage(props.unionByName(old_props.join(goes_on, "origin", "left_semi")))
            # what a content becomes follows from it, so equal ids have equal rows
            variants = cut_lineage(lean_variants(variants.unionByName(old_variants.drop("origin"))).distinct())
        seeds = heads.join(altered, "origin", "left_anti").select("origin", F.col("last_id").alias("seed_parent"))
        res = load(ChangeLog(origins, log.commits, prior.unionByName(log.changes)), seeds=seeds, props=props, variants=variants,
                   last_rev=last_rev)
        last = ev.groupBy("origin").agg(
            F.max(F.struct("ts", "event_id", "rev")).alias("m"), F.max("reloaded").alias("reloaded")).select(
            "origin", "reloaded", F.col("m.rev").alias("last_rev"), F.col("m.ts").alias("last_ts"), F.col("m.event_id").alias("last_event"))
        last = cut_lineage(last)
        new_revs = res.revisions.select("origin", "rev", "tree_id", "revision_id") \
            .join(last.select("origin", "reloaded"), "origin")
        self._put(new_revs, self.revisions, batch_id)
        # the state of the touched buckets: of the origins of this batch anew, of the others as it was
        at = last.select("origin", F.col("last_rev").alias("at_rev"))
        new_heads = last.join(res.revisions.select("origin", F.col("rev").alias("last_rev"), F.col("revision_id").alias("last_id")),
                              ["origin", "last_rev"])
        state = archived_state(res, at)
        # one marker row per origin: a bucket whose trees all became empty
        # must still be written, or its older rows would count
        none = F.lit(None).cast("string")
        marker = last.select("origin", F.col("last_rev").alias("rev"), F.lit(2).alias("seq"), F.lit("").alias("path"), F.lit("root").alias("kind"),
                             F.lit("state").alias("action"), none.alias("copyfrom_path"), F.lit(-1).cast("long").alias("copyfrom_rev"),
                             none.alias("blob_id"), F.lit(None).cast("long").alias("length"))
        tables = {"heads": (new_heads, heads), "tree": (state.unionByName(marker), tree)}
        if self.export:
            held = archived_props(res.props, at).unionByName(last.select(
                "origin", F.col("last_rev").alias("rev"), F.lit("").alias("path"), F.lit("").alias("name"), none.alias("value")))
            # dealt once, for the distinct rows and the join
            blobs = state.where(F.col("blob_id").isNotNull()).select("origin", "blob_id").repartition("blob_id").distinct().join(variants, "blob_id")
            blobs = blobs.unionByName(last.select("origin", *[none.alias(c) for c in ("blob_id", "link_id", "id_lf", "id_crlf", "id_cr")]))
            tables |= {"props": (held, old_props), "variants": (blobs, old_variants)}
        for name, (new, old) in tables.items():
            rows = new.unionByName(old.join(last.select("origin"), "origin", "left_anti"))
            self._put(rows.withColumn("bkt", self._bucket(F.col("origin"))), self._table(name), batch_id, "bkt")

    def _put(self, df: DataFrame, path: str, batch_id: int, *by: str) -> None:
        """Write the rows as those of the batch, in place of what an earlier try
        wrote.  Rows of a bucket are brought together first, so that a bucket
        is a file or a few by its size, not one by every task."""
        if by:
            df = df.hint("rebalance", *[F.col(c) for c in by])
        (df.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch").parquet(path))

    def read_revisions(self) -> DataFrame:
        """origin, rev, tree_id, revision_id as of the last batch."""
        schema = "origin string, rev long, tree_id string, revision_id string, reloaded long"
        if not path_exists(self.spark, self.revisions):
            return self.spark.createDataFrame([], schema).drop("reloaded")
        rows = self.spark.read.schema(schema).parquet(self.revisions)
        valid = rows.groupBy("origin").agg(F.max("reloaded").alias("reloaded"))
        return rows.join(valid, ["origin", "reloaded"], "left_semi").drop("reloaded", "batch")

    # ------------------------------------------------------------ streaming
    def run_once(self) -> None:
        schema = TABLE_SCHEMAS["events"]
        stream = self.spark.readStream.schema(schema).parquet(self.incoming)
        q = (stream.writeStream.foreachBatch(self.process_batch)
             .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()

    def run_arrivals(self, events: DataFrame, groups: int = 4) -> DataFrame:
        """Split the events by time into ``groups`` arrivals (quantile cut
        points of the timestamps), then for each: write it as new files and
        run the stream until it has consumed them."""
        secs = F.unix_micros(F.col("ts").cast("timestamp"))
        cuts = events.select(F.percentile_approx(secs, [i / groups for i in range(1, groups)], 10000)
                             .alias("q")).first()["q"]
        bounds = [None, *cuts, None]
        for i in range(groups):
            part = events
            if bounds[i] is not None:
                part = part.where(secs > F.lit(bounds[i]))
            if bounds[i + 1] is not None:
                part = part.where(secs <= F.lit(bounds[i + 1]))
            part.write.mode("append").parquet(f"{self.incoming}/arrival={i:04d}")
            self.run_once()
        return self.read_revisions()

    def run_parts(self, parts: list[DataFrame]) -> DataFrame:
        """Let the parts arrive one after the other, in whatever order their events are."""
        for i, part in enumerate(parts):
            part.write.mode("append").parquet(f"{self.incoming}/arrival={i:04d}")
            self.run_once()
        return self.read_revisions()
