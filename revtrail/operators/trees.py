"""Directory identifiers for every directory version, bottom-up by depth.

A directory changes when an entry of it starts or ends, or it does itself.
For one depth these changes are the rows: two per version of an entry and of
a lifetime, clustered by directory and sorted by revision.  A task streams
through them with the open entries of one directory as its state, in entry
order; at every revision it hashes them, and a version of the directory is a
stretch with one id.  Nothing that stays as it is gets shuffled again: the
rows follow the changes, not entries x versions.  The ids of depth ``d``
become entries at depth ``d-1``.

A directory touched by very many revisions (the root of a long history) is
cut into blocks of revisions, each a cluster of its own.  A block starts with
rows for what is open there; blocks in which the directory doesn't change
have no rows at all.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.hashing import INF_REV, PERM_DIR, PERM_FILE, entry_sort_key, tree_entry_hex
from revtrail.operators import intervals
from revtrail.operators.intervals import Intervals
from revtrail.session import cut_lineage, dealt

ENTRY_COLS = ["origin", "parent", "name", "is_dir", "perms", "target", "from_rev", "to_rev"]
#: Kinds of rows in the order in which they count at one revision.
HEADER, CLOSE, LIFE, OPEN = -1, 0, 1, 2
VERSION_SCHEMA = "origin string, path string, from_rev long, to_rev long, tree_id string"


@dataclass
class TreeVersions:
    dirs: DataFrame   # origin, path, depth, from_rev, to_rev, tree_id, body if asked for (root: path '')
    root: DataFrame   # origin, from_rev, to_rev, tree_id


def file_entries(files: DataFrame) -> DataFrame:
    """Entries of file versions; their mode is ``perms`` if they have it."""
    perms = F.col("perms") if "perms" in files.columns else F.lit(PERM_FILE)
    return files.select("origin", "parent", "name", F.lit(False).alias("is_dir"),
                        perms.cast("int").alias("perms"), F.col("blob_id").alias("target"),
                        "from_rev", "to_rev", "depth")


def change_rows(kids: DataFrame, lifetimes: DataFrame) -> DataFrame:
    """(origin, path, rev, op, delta, key, entry, upto): what starts and ends in
    each directory; ``upto`` is the end of what a row opens."""
    key = entry_sort_key(F.col("name"), F.col("is_dir"))
    entry = F.unhex(tree_entry_hex(F.col("perms"), F.col("name"), F.col("target")))
    own = kids.select("origin", F.col("parent").alias("path"), "from_rev", "to_rev", key.alias("key"), entry.alias("entry")) \
        .where(F.col("entry").isNotNull())  # what has no id can't be listed
    lives = lifetimes.select("origin", "path", "from_rev", "to_rev", F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("entry"))
    row = lambda df, at, op, delta: df.select(
        "origin", "path", F.col(at).alias("rev"), F.lit(op).alias("op"), F.lit(delta).alias("delta"), "key", "entry", F.col("to_rev").alias("upto"))
    closed = F.col("to_rev") < F.lit(INF_REV)
    none = F.lit(None).cast("binary")
    return (row(own, "from_rev", OPEN, 0).unionByName(row(own.where(closed).withColumn("entry", none), "to_rev", CLOSE, 0))
            .unionByName(row(lives, "from_rev", LIFE, 1)).unionByName(row(lives.where(closed), "to_rev", LIFE, -1)))


def in_blocks(rows: DataFrame, last_rev: int) -> DataFrame:
    """``rows`` with the block of revisions each belongs to, rows for what is
    open at the start of a block, and a header row per block that tells the
    start of the directory's next one."""
    size = intervals.REV_BUCKET
    if last_rev < size:
        return rows.withColumn("block", F.lit(0).cast("long"))
    rows = cut_lineage(rows.withColumn("block", F.floor(F.col("rev") / size)))
    active = rows.select("origin", "path", "block").distinct()
    along = Window.partitionBy("origin", "path").orderBy("block")
    none = F.lit(None).cast("binary")
    headers = active.withColumn("upto", F.coalesce(F.lead("block").over(along) * size, F.lit(INF_REV))).select(
        "origin", "path", F.lit(-1).cast("long").alias("rev"), F.lit(HEADER).alias("op"), F.lit(0).alias("delta"), none.alias("key"),
        none.alias("entry"), "upto", "block")
    last_block = rows.agg(F.max("block")).first()[0] or 0  # ends count, too: the last change may be a delete
    last = F.least(F.floor((F.col("upto") - 1) / size), F.lit(last_block).cast("long"))
    opens = rows.where((F.col("op") == OPEN) | ((F.col("op") == LIFE) & (F.col("delta") > 0))).where(last > F.col("block"))
    held = opens.withColumn("block", F.explode(F.sequence(F.col("block") + 1, last))) \
        .join(active, ["origin", "path", "block"], "left_semi").withColumn("rev", F.col("block") * size)
    # what ends where a block starts isn't open in it
    ends = (F.col("op") == CLOSE) | (F.col("delta") < 0)
    return rows.where(~(ends & (F.col("rev") == F.col("block") * size))).unionByName(headers).unionByName(held)


def _fold(bodies: bool):
    """Versions of each directory (and block) from its sorted rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, alive, keys, entries, since, upto, rev, told = None, 0, [], {}, None, INF_REV, None, set()
        out: list[list] = [[], [], [], [], [], []]

        def version(to_rev):
            for c, v in zip(out, (at[0], at[1], since[0], to_rev, since[1], since[2])):
                c.append(v)

        def settle():
            """What the directory is from ``rev`` on."""
            nonlocal since
            if rev is None or rev < 0:
                return
            body = b"".join([entries[k] for k in keys]) if alive > 0 else None
            now = None if body is None else hashlib.sha1(b"tree %d\x00" % len(body) + body).hexdigest()
            if since is not None:
                if since[1] == now:
                    return
                if since[0] < rev:
                    version(rev)
            if now is None:
                since = None
                return
            since = (rev, now, body if bodies and now not in told else None)
            told.add(now)

        def flush():
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["origin", "path", "from_rev", "to_rev", "tree_id", "body"]
            n = 5 + bodies
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out[:n], kinds)], names=names[:n])
            for c in out:
                c.clear()
            return made

        for batch in batches:
            for origin, path, block, row_rev, op, delta, key, entry, row_upto in zip(*(c.to_pylist() for c in batch.columns)):
                group = (origin, path, block)
                if group != at or row_rev != rev:
                    settle()
                    if group != at:
                        if since is not None and since[0] < upto:
                            version(upto)
                        at, alive, keys, entries, since, upto, told = group, 0, [], {}, None, INF_REV, set()
                    rev = row_rev
                if op == OPEN:
                    if key not in entries:
                        insort(keys, key)
                    entries[key] = entry
                elif op == CLOSE:
                    if key in entries:
                        del entries[key]
                        del keys[bisect_left(keys, key)]
                elif op == LIFE:
                    alive += delta
                else:
                    upto = row_upto
            if out[0]:
                yield flush()
        settle()
        if since is not None and since[0] < upto:
            version(upto)
        if out[0]:
            yield flush()
    return run


def dir_versions(kids: DataFrame, lifetimes: DataFrame, last_rev: int, bodies: bool = False) -> DataFrame:
    """kids: ENTRY_COLS; lifetimes: origin, path, from_rev, to_rev -> (origin,
    path, from_rev, to_rev, tree_id) of every version, with ``bodies`` also
    the hashed bytes where a directory has that id for the first time."""
    rows = in_blocks(change_rows(kids, lifetimes), last_rev)
    rows = rows.select("origin", "path", "block", "rev", "op", "delta", "key", "entry", "upto")
    return dealt(rows, "origin", "path", "block").sortWithinPartitions("origin", "path", "block", "rev", "op") \
        .mapInArrow(_fold(bodies), VERSION_SCHEMA + (", body binary" if bodies else ""))


def build_trees(iv: Intervals, origins: DataFrame, bodies: bool = False) -> TreeVersions:
    """Tree ids of every directory version, deepest level first."""
    # files lie in directories one level above them; the deepest directory may be empty
    stats = (iv.files.select((F.col("depth") - 1).alias("depth"), "from_rev").unionByName(iv.dirs.select("depth", "from_rev"))
             .agg(F.max("depth"), F.max("from_rev")).first())
    deepest, last_rev = stats[0] or 0, stats[1] or 0
    files = file_entries(iv.files)
    lifetimes = iv.dirs
    root_life = origins.select("origin", F.lit("").alias("path"), F.lit(0).cast("long")
                               .alias("from_rev"), F.lit(INF_REV).cast("long").alias("to_rev"),
                               F.lit(0).alias("depth"))
    all_dirs = None
    child_dirs = None
    for d in range(deepest, -1, -1):
        kids = files.where(F.col("depth") == d + 1).select(*ENTRY_COLS)
        if child_dirs is not None:
            kids = kids.unionByName(child_dirs)
        lives = root_life if d == 0 else lifetimes.where(F.col("depth") == d).select(
            "origin", "path", "from_rev", "to_rev", "depth")
        # each level is read twice (as output and as the next level's
        # children): materialise it and cut the lineage
        dv = cut_lineage(dir_versions(kids, lives, last_rev, bodies).withColumn("depth", F.lit(d)))
        all_dirs = dv if all_dirs is None else all_dirs.unionByName(dv)
        child_dirs = dv.select(
            "origin",
            F.when(F.instr("path", "/") > 0, F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
            .otherwise(F.lit("")).alias("parent"),
            F.regexp_extract("path", r"([^/]*)$", 1).alias("name"),
            F.lit(True).alias("is_dir"), F.lit(PERM_DIR).alias("perms"),
            F.col("tree_id").alias("target"), "from_rev", "to_rev")
    root = all_dirs.where(F.col("depth") == 0).select("origin", "from_rev", "to_rev", "tree_id")
    return TreeVersions(all_dirs, root)
