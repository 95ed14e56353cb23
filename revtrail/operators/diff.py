"""Tree and content differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.hashing import PERM_DIR
from revtrail.session import cut_lineage


def line_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return (docs.select(key, F.explode(F.split(F.col(text), "\n")).alias("line"))
            .groupBy(key, "line").agg(F.count(F.lit(1)).alias("n")))


def diff_stat(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """pairs (old_id, new_id), contents (id, text) -> lines_added and
    lines_removed of each distinct pair: the lines of both sides meet by their
    text, those of the old one counted down; dealt once, by pair."""
    pairs = pairs.select("old_id", "new_id").distinct()
    lc = line_counts(contents, "id")
    new = pairs.join(lc.withColumnRenamed("id", "new_id"), "new_id").select("old_id", "new_id", "line", "n")
    old = pairs.join(lc.withColumnRenamed("id", "old_id"), "old_id").select("old_id", "new_id", "line", (-F.col("n")).alias("n"))
    j = new.unionByName(old).repartition("old_id", "new_id").groupBy("old_id", "new_id", "line").agg(F.sum("n").alias("more"))
    return j.groupBy("old_id", "new_id").agg(
        F.sum(F.greatest(F.col("more"), F.lit(0))).alias("lines_added"),
        F.sum(F.greatest(-F.col("more"), F.lit(0))).alias("lines_removed"))


def changed_files(files: DataFrame) -> DataFrame:
    """(origin, rev, path, old_id, new_id) where a file version follows on
    another one of its path with other data."""
    along = Window.partitionBy("origin", "path").orderBy("from_rev")
    f = files.withColumn("old_id", F.when(F.lag("to_rev").over(along) == F.col("from_rev"), F.lag("blob_id").over(along)))
    return f.where(F.col("old_id").isNotNull() & (F.col("old_id") != F.col("blob_id"))).select(
        "origin", F.col("from_rev").alias("rev"), "path", "old_id", F.col("blob_id").alias("new_id"))


def tree_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Full outer join of two listings (origin, path, kind, id) on path.

    status: 'missing' (in expected only), 'extra' (in actual only) or
    'different' (ids differ); equal rows are dropped.
    """
    e = expected.select("origin", "path", F.col("kind").alias("kind_e"), F.col("id").alias("id_e"))
    a = actual.select("origin", "path", F.col("kind").alias("kind_a"), F.col("id").alias("id_a"))
    j = e.join(a, ["origin", "path"], "full_outer")
    status = (F.when(F.col("id_a").isNull(), "missing").when(F.col("id_e").isNull(), "extra")
              .when(~F.col("id_e").eqNullSafe(F.col("id_a")), "different"))
    return j.withColumn("status", status).where(F.col("status").isNotNull()).select(
        "origin", "path", F.coalesce("kind_e", "kind_a").alias("kind"), "status")


def root_steps(root: DataFrame) -> DataFrame:
    """(origin, rev, old, new): every change of the root directory's id, from
    nothing at the first."""
    along = Window.partitionBy("origin").orderBy("from_rev")
    return root.select("origin", F.col("from_rev").alias("rev"), F.lag("tree_id").over(along).alias("old"), F.col("tree_id").alias("new"))


def descend(pairs: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """What differs below pairs of directories.

    pairs (keys, old, new: directory ids, null for none), entries (id, name,
    perms, target) of the directories -> (keys, path, kind, status) with
    status added, removed or changed.  Level by level the lists of entries of
    the two sides are compared where they meet; only entries that differ are
    dealt out, by name, and only directories whose ids differ go on, so equal
    subtrees are never opened and the work follows the differences.
    """
    word = F.concat_ws(" ", F.col("perms").cast("string"), "target", "name")  # a name may hold blanks
    lists = cut_lineage(entries.groupBy("id").agg(F.collect_list(word).alias("list")))
    none = F.array().cast("array<string>")
    level = pairs.where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, F.lit("").alias("path"), "old", "new")
    found = None
    while True:
        level = cut_lineage(level)
        if level.isEmpty():
            return found if found is not None else level.select(*keys, "path", F.lit("").alias("kind"), F.lit("").alias("status")).limit(0)

        both = level
        for which in ("old", "new"):
            both = both.join(lists.select(F.col("id").alias(which), F.col("list").alias(f"{which}_list")), which, "left") \
                .withColumn(f"{which}_list", F.coalesce(f"{which}_list", none))
        apart = lambda which, other: F.transform(F.array_except(f"{which}_list", f"{other}_list"), lambda w: F.struct(
            F.lit(which).alias("side"), F.split(w, " ", 3).alias("w")))
        apart = both.select(*keys, "path", F.explode(F.concat(apart("old", "new"), apart("new", "old"))).alias("e")).select(
            *keys, "path", "e.side", F.col("e.w")[2].alias("name"), F.col("e.w")[0].cast("int").alias("perms"), F.col("e.w")[1].alias("target"))
        of = lambda which, c: F.max(F.when(F.col("side") == which, F.col(c)))
        met = apart.groupBy(*keys, "path", "name").agg(
            of("old", "perms").alias("old_perms"), of("old", "target").alias("old"),
            of("new", "perms").alias("new_perms"), of("new", "target").alias("new"))
        path = F.when(F.col("path") == "", F.col("name")).otherwise(F.concat_ws("/", "path", "name"))
        met = cut_lineage(met.withColumn("path", path).drop("name"))
        kind = F.when(F.coalesce("new_perms", "old_perms") == PERM_DIR, "dir").otherwise("file")
        status = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
        rows = met.select(*keys, "path", kind.alias("kind"), status.alias("status"))
        found = rows if found is None else found.unionByName(rows)
        as_dir = lambda c: F.when(F.col(f"{c}_perms") == PERM_DIR, F.col(c)).alias(c)
        level = met.select(*keys, "path", as_dir("old"), as_dir("new")).where(~F.col("old").eqNullSafe(F.col("new")))
