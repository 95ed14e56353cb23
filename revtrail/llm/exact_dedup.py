"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Texts are equal when identical without the characters space, tab, line
feed, vertical tab, form feed and carriage return.  Only DataFrame
operations are used.  One scan of the texts gives a small table of lengths
and prefix hashes.  Rows whose length is unique are done, then rows whose
(length, prefix hash) is unique; only the texts of the others are read again
and hashed in full.  Every step groups by its key with partial aggregation,
so a group of any size meets as counters, not as rows.

Of equal texts the row with the most code points in the original stays,
then the smallest doc_id.  Null text counts as empty (and empty texts are
equal).  Rows that repeat a doc_id are all returned, and count one by one in
the group size; a null doc_id sorts after all others.  Further columns are
ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import as_ids, but_first, numbered, without, written

BLANKS = " \t\n\x0b\x0c\r"
PREFIX_CHARS = 256


def squeezed(text: Column) -> Column:
    """The text without blanks."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in BLANKS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def keep_order() -> Column:
    """Sorts the row that stays last: most code points, then smallest doc_id, null as the largest."""
    return F.struct(F.col("n_points"), F.col("doc_id").isNotNull(), -F.col("doc_id"))


def exact_groups(docs: DataFrame, with_digest: bool = False) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and, if asked
    for, text_sha256 of every document (which hashes all texts in the first
    scan; the groups are found by refinement all the same)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # as an array of one, the squeezed text is computed once for all that use it
    meta = rows.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"),
                       F.explode(F.array(squeezed(F.col("text")))).alias("bare"))
    meta = meta.select(
        "doc_id", "n_points", F.octet_length("bare").cast("long").alias("bytes"),
        F.xxhash64(F.substring("bare", 1, PREFIX_CHARS)).alias("prefix"),
        *([F.sha2(F.col("bare"), 256).alias("text_sha256")] if with_digest else []))
    meta = written(meta, "lengths")

    several = F.count(F.lit(1)) > 1
    by_length = meta.groupBy("bytes").agg(several.alias("more")).filter("more").select("bytes")
    same_length = meta.join(by_length, "bytes", "left_semi")
    by_prefix = same_length.groupBy("bytes", "prefix").agg(several.alias("more")).filter("more").select("bytes", "prefix")
    same_prefix = written(meta.join(by_prefix, ["bytes", "prefix"], "left_semi").select("doc_id").distinct()
                          .withColumnRenamed("doc_id", "of"), "same-prefix")

    same = F.col("doc_id").eqNullSafe(F.col("of"))
    full = (rows.join(same_prefix, same, "left_semi")
            .select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"),
                    F.sha2(squeezed(F.col("text")), 256).alias("sha")))
    full = written(full, "full-hashes")
    groups = full.groupBy("sha").agg(F.max_by("doc_id", keep_order()).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    found = full.join(groups, "sha").select("doc_id", "keep_id", "group_size", F.col("sha").alias("text_sha256"))
    alone = (meta.join(same_prefix, same, "left_anti")
             .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                     F.col("text_sha256") if with_digest else F.lit(None).cast("string").alias("text_sha256")))
    out = found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return out.select("doc_id", "keep_id", "group_size", "kept", *(["text_sha256"] if with_digest else []))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, whole: of equal texts one row, also
    where rows share a doc_id or have none."""
    rows, number = numbered(docs)
    groups = exact_groups(as_ids(rows, number)).filter("group_size > 1").select(
        F.col("doc_id").alias("row"), F.col("keep_id").alias("together"))
    longest = -F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return without(rows, number, but_first(rows, number, groups, longest))
