"""Golden identifiers recomputed with the Spark expressions."""

import datetime as dt

from pyspark.sql import functions as F

from revtrail.functions.hashing import (EMPTY_TREE_ID, PERM_DIR, revision_manifest_parts,
                                        snapshot_branch_hex, snapshot_id, sorted_entries_tree_id,
                                        entry_sort_key, tree_entry_hex)
from revtrail.operators.chain import revision_chain

UUID = "3187e211-bb14-4c82-9596-0b59d67cd7f4"
# Published revision history of the reference's base test repository.
HISTORY = [
    (1, "seanius", "2006-01-27 05:50:38.645397", "making dir structure...",
     "669a71cce6c424a81ba42b7dc5d560d32252f0ca", "0d7dd5f751cef8fe17e8024f7d6b0e3aac2cfd71"),
    (2, "seanius", "2006-01-27 05:50:44.821526", "making dir structure...",
     "008ac97a1118560797c50e3392fa1443acdaa349", "95edacc8848369d6fb1608e887d6d2474fd5224f"),
    (3, "seanius", "2006-01-27 05:50:57.282488", "making dir structure...",
     "3780effbe846a26751a95a8c95c511fb72be15b4", "fef26ea45a520071711ba2b9d16a2985ee837021"),
    (4, "seanius", "2006-01-27 05:51:04.191867", "making dir structure...",
     "ffcca9b09c5827a6b8137322d4339c8055c3ee1e", "3f51abf3b3d466571be0855dfa67e094f9ceff1b"),
    (5, "seanius", "2006-01-27 06:17:12.066765", "initial import",
     "7dc52cc04c3b8bd7c085900d60c159f7b846f866", "a3a577948fdbda9d1061913b77a1588695eadb41"),
    (6, "seanius", "2006-01-27 06:38:25.448277", "fix breakage in rules",
     "0deab3023ac59398ae467fc4bff5583008af1ee2", "4876cb10aec6f708f7466dddf547567b65f6c39c"),
    (7, "tony", "2016-06-24 09:07:04.2817", "Add a new README",
     "752c52134dcbf2fff13c7be1ce4e9e5dbf428a59", "7f5bc909c29d4e93d8ccfdda516e51ed44930ee1"),
    (8, "tony", "2016-06-24 09:08:42.099151", "Add link to README",
     "39c813fb4717a4864bacefbd90b51a3241ae4140", "38d81702cb28db4f1a6821e64321e5825d1f7fd6"),
]
SNAPSHOT_BASE = "889cacc2731e3312abfb2b1a0c18ade82a949e07"


def test_stamps_are_the_published_seconds():
    assert dt.datetime(2006, 1, 27, 5, 50, 38, tzinfo=dt.timezone.utc).timestamp() == 1138341038


def test_revision_chain_golden(spark):
    rows = [("o", r, dt.datetime.fromisoformat(d), a, m, t) for r, a, d, m, t, _ in HISTORY]
    df = spark.createDataFrame(rows, "origin string, rev long, date timestamp, author string, "
                                     "message string, tree_id string")
    pre, suf = revision_manifest_parts(F.col("tree_id"), F.col("author"), F.col("date"),
                                       F.lit(UUID), F.col("rev"), F.col("message"))
    bodies = df.select("origin", "rev", pre.alias("prefix"), suf.alias("suffix"))
    got = {r.rev: r.revision_id for r in revision_chain(bodies).collect()}
    assert got == {r: rid for r, *_, rid in HISTORY}


def test_snapshot_golden(spark):
    df = spark.createDataFrame([("4876cb10aec6f708f7466dddf547567b65f6c39c",)], "rid string")
    b = F.struct(F.lit("HEAD").cast("binary").alias("name"),
                 snapshot_branch_hex(F.lit("HEAD"), F.lit("revision"), F.col("rid")).alias("branch_hex"))
    assert df.select(snapshot_id(F.array(b))).first()[0] == SNAPSHOT_BASE


def test_tree_golden(spark):
    # gourmet/ holding the empty dirs trunk, branches, tags (revision 4)
    df = spark.createDataFrame([("branches",), ("tags",), ("trunk",)], "name string")
    e = F.struct(entry_sort_key(F.col("name"), F.lit(True)).alias("sort_key"),
                 tree_entry_hex(F.lit(PERM_DIR), F.col("name"), F.lit(EMPTY_TREE_ID)).alias("entry_hex"))
    inner = df.agg(sorted_entries_tree_id(F.collect_list(e))).first()[0]
    top = spark.createDataFrame([("gourmet", inner)], "name string, t string").agg(
        sorted_entries_tree_id(F.collect_list(F.struct(
            entry_sort_key(F.col("name"), F.lit(True)).alias("sort_key"),
            tree_entry_hex(F.lit(PERM_DIR), F.col("name"), F.col("t")).alias("entry_hex"))))).first()[0]
    assert top == "ffcca9b09c5827a6b8137322d4339c8055c3ee1e"
