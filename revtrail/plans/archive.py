"""An archive of objects that grows by whole visits.

Objects are Parquet tables, one folder per type, partitioned by the visit that
brought them.  A visit first writes its new objects, children before what
refers to them, into partitions of its own; nobody reads those yet.  Then its
manifest is put in place with one rename, and from then on its partitions
count.  A visit that was stopped leaves nothing visible, and one that is
repeated overwrites what the first try left, or does nothing if that came to
its end.  One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrail.functions.hashing import PERM_DIR, snapshot_branch_hex, snapshot_id
from revtrail.plans.load import LoadResult
from revtrail.plans.sinks import DEFAULT_MAX_CONTENT_SIZE, new_objects
from revtrail.session import cut_lineage, path_exists

#: Tables in the order in which they are written, and the columns that make a row known.
TABLES = {
    "skipped_content": ("id string, length long, reason string", ["id"]),
    "content": ("id string, length long, data binary", ["id"]),
    "directory": ("id string, body binary", ["id"]),
    "revision": ("id string, directory string, parent string, origin string, rev long, author string, date timestamp, message string", ["id"]),
    "snapshot": ("id string, name string, target_type string, target string", ["id", "name"]),
    "extid": ("id string, checksum_layout string, checksum string", ["id", "checksum_layout", "checksum"]),
    "visit": ("origin string, type string, status string, snapshot string, visit_date timestamp", ["origin", "type", "visit_date"]),
}


class Archive:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ manifests
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def committed(self) -> list[str]:
        """The visits that count, in the order of their names."""
        fs, folder = self._fs(f"{self.root}/manifest")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def _commit(self, visit: str, counts: dict[str, int]) -> None:
        fs, draft = self._fs(f"{self.root}/manifest/_{visit}.draft")
        _, final = self._fs(f"{self.root}/manifest/{visit}.json")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(counts).encode()))
        out.close()
        if not fs.rename(draft, final):
            raise RuntimeError(f"visit {visit} can't be put in place")

    # --------------------------------------------------------------- tables
    def read(self, table: str) -> DataFrame:
        """The rows of all visits that count, with their ``visit``."""
        schema, _ = TABLES[table]
        visits = self.committed()
        path = f"{self.root}/{table}"
        if not visits or not path_exists(self.spark, path):
            return self.spark.createDataFrame([], f"{schema}, visit string")
        return self.spark.read.schema(f"{schema}, visit string").parquet(path).where(F.col("visit").isin(visits))

    def stage(self, visit: str, table: str, rows: DataFrame) -> int:
        """Write the unknown ones of ``rows`` for a visit that doesn't count yet."""
        schema, key = TABLES[table]
        names = [c.split(" ")[0] for c in schema.split(", ")]
        known = self.read(table).select(*key)
        if len(key) == 1:
            fresh = new_objects(rows.select(*names), known, key[0])
        else:
            fresh = rows.select(*names).dropDuplicates(key).join(known, key, "left_anti")
        path = f"{self.root}/{table}/visit={visit}"
        fresh.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path).count()

    def append(self, visit: str, tables: dict[str, DataFrame]) -> dict[str, int]:
        """All tables of a visit, then the visit itself; rows written by table.
        A visit that counts already is left as it is."""
        if not visit or not visit.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"{visit!r} is no name for a visit")
        if visit in self.committed():
            return dict.fromkeys(tables, 0)
        counts = {t: self.stage(visit, t, tables[t]) for t in TABLES if t in tables}
        self._commit(visit, counts)
        return counts


def objects(res: LoadResult, contents: DataFrame, visit_date: str, max_size: int = DEFAULT_MAX_CONTENT_SIZE) -> dict[str, DataFrame]:
    """A load as archive tables; contents (id, length, data) holds at least the load's."""
    used = cut_lineage(contents.join(res.exported.files.select(F.col("blob_id").alias("id")), "id", "left_semi"))
    big = F.col("length") > max_size
    trees = res.trees_with_bodies
    chain = res.revisions.select("origin", "rev", "tree_id", F.col("revision_id").alias("id"))
    parents = chain.select("origin", (F.col("rev") + 1).alias("rev"), F.col("id").alias("parent"))
    revisions = chain.join(parents, ["origin", "rev"], "left").join(res.log.commits, ["origin", "rev"]).select(
        "id", F.col("tree_id").alias("directory"), "parent", "origin", "rev", "author", F.col("date").cast("timestamp").alias("date"), "message")
    heads = res.snapshots.select(F.col("snapshot_id").alias("id"), F.lit("HEAD").alias("name"), F.lit("revision").alias("target_type"),
                                 F.col("revision_id").alias("target"))
    visits = res.snapshots.select("origin", F.lit("svn").alias("type"), F.lit("full").alias("status"), F.col("snapshot_id").alias("snapshot"),
                                  F.lit(visit_date).cast("timestamp").alias("visit_date"))
    return {
        "skipped_content": used.where(big).select("id", "length", F.lit("too large").alias("reason")),
        "content": used.where(~big).select("id", "length", "data"),
        "directory": trees.dirs.where(F.col("body").isNotNull()).select(F.col("tree_id").alias("id"), "body"),
        "revision": revisions, "snapshot": heads, "visit": visits,
    }


def export_extids(directories: DataFrame, manifest: DataFrame, layout: str = "sha256-manifest") -> DataFrame:
    """extid rows of exports whose checksum is as expected: directories (id,
    checksum), manifest (checksum, the expected ones)."""
    return directories.join(manifest.select("checksum").distinct(), "checksum", "left_semi") \
        .select("id", F.lit(layout).alias("checksum_layout"), "checksum")


def manifest_checksums(listing: DataFrame) -> DataFrame:
    """(origin, checksum): SHA-256 over the sorted lines "perms id path" of a
    listing (origin, path, perms, id).  The lines of an origin are hashed
    one by one, and their digests in order, by groups of a path's first part."""
    line = F.concat_ws(" ", F.conv(F.col("perms").cast("string"), 10, 8), "id", "path")
    part = listing.select("origin", F.element_at(F.split("path", "/"), 1).alias("top"), "path", F.sha2(line, 256).alias("digest"))
    order = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda e: e["digest"]), "")
    tops = part.groupBy("origin", "top").agg(F.sha2(order(F.struct("path", "digest")), 256).alias("digest"))
    return tops.groupBy("origin").agg(F.sha2(order(F.struct("top", "digest")), 256).alias("checksum"))


def entries_of(directories: DataFrame) -> DataFrame:
    """(id, name, perms, target) of the entries of directory objects (id, body)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for id_, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = 0
                while at < len(body):
                    blank, nul = body.index(b" ", at), body.index(b"\x00", at)
                    for c, v in zip(out, (id_, body[blank + 1:nul].decode(), int(body[at:blank], 8), body[nul + 1:nul + 21].hex())):
                        c.append(v)
                    at = nul + 21
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.int32(), pa.string()))],
                                             names=["id", "name", "perms", "target"])

    return directories.select("id", "body").mapInArrow(run, "id string, name string, perms int, target string")


def restored(archive: Archive) -> DataFrame:
    """(origin, path, perms, id, length) of every node of each origin's last
    visit, from archived objects alone: its snapshot's HEAD, that revision's
    directory, and level by level the directories below.  length is null for
    directories and for contents that weren't kept."""
    visits = archive.read("visit").groupBy("origin").agg(F.max_by("snapshot", F.struct("visit_date", "visit")).alias("id"))
    heads = visits.join(archive.read("snapshot").where((F.col("name") == "HEAD") & (F.col("target_type") == "revision")), "id") \
        .select("origin", F.col("target").alias("id"))
    level = heads.join(archive.read("revision").select("id", "directory"), "id").select(
        "origin", F.lit("").alias("path"), F.col("directory").alias("id"))
    directories, found = archive.read("directory"), None
    level = cut_lineage(level)
    while not level.isEmpty():
        wanted = directories.join(level.select("id").distinct(), "id", "left_semi")
        below = level.join(entries_of(wanted), "id").select(
            "origin", F.when(F.col("path") == "", F.col("name")).otherwise(F.concat_ws("/", "path", "name")).alias("path"), "perms",
            F.col("target").alias("id"))
        below = cut_lineage(below)
        found = below if found is None else found.unionByName(below)
        level = below.where(F.col("perms") == PERM_DIR).select("origin", "path", "id")
    if found is None:
        found = archive.spark.createDataFrame([], "origin string, path string, perms int, id string")
    sizes = archive.read("content").select("id", "length")
    return found.join(sizes, "id", "left").select("origin", "path", "perms", "id", "length")


def check_snapshots(archive: Archive) -> DataFrame:
    """Snapshots whose id isn't that of their branches (none, if all is well)."""
    branch = F.struct(F.col("name").cast("binary").alias("name"), snapshot_branch_hex(F.col("name"), F.col("target_type"), F.col("target")).alias("branch_hex"))
    made = archive.read("snapshot").groupBy("id").agg(snapshot_id(F.collect_list(branch)).alias("made"))
    return made.where(F.col("id") != F.col("made")).select("id")
