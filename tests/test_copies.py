"""Copies of every shape, and as-of lookups on equal and unordered dates."""

import hashlib
import time

from pyspark.sql import functions as F

from revtrail.operators.copies import expand_copies
from revtrail.operators.ordinals import asof_lookup

CHANGES = ("origin string, rev long, seq int, path string, kind string, action string, "
           "copyfrom_path string, copyfrom_rev long, blob_id string, length long")


def put(rev, path):
    return ("o", rev, 2, path, "file", "put", None, -1, f"{path}@{rev}", 1)


def copy(rev, src, src_rev, dst):
    return ("o", rev, 1, dst, "dir", "copy", src, src_rev, None, None)


def files_at(spark, changes, rev):
    iv = expand_copies(spark.createDataFrame(changes, CHANGES)).intervals
    return {r.path: r.blob_id for r in iv.files.collect() if r.from_rev <= rev < r.to_rev}


def test_source_that_holds_a_destination(spark):
    log = [put(1, "vendor/x"), put(1, "trunk/a"), copy(2, "vendor", 1, "trunk/lib"), copy(3, "trunk", 2, "tags/1")]
    assert files_at(spark, log, 3) == {"vendor/x": "vendor/x@1", "trunk/a": "trunk/a@1", "trunk/lib/x": "vendor/x@1",
                                       "tags/1/a": "trunk/a@1", "tags/1/lib/x": "vendor/x@1"}


def test_copy_of_the_root(spark):
    log = [put(1, "a/b"), copy(2, "", 1, "all")]
    assert files_at(spark, log, 2) == {"a/b": "a/b@1", "all/a/b": "a/b@1"}


def test_long_chain_of_copies(spark):
    log = [put(1, "d1/f")] + [copy(i, f"d{i - 1}", i - 1, f"d{i}") for i in range(2, 7)]
    assert files_at(spark, log, 6) == {f"d{i}/f": "d1/f@1" for i in range(1, 7)}


def test_copy_of_an_earlier_revision_over_an_old_destination(spark):
    log = [put(1, "t/f"), put(2, "t/f"), put(2, "u/old"), copy(3, "t", 1, "u")]
    assert files_at(spark, log, 3) == {"t/f": "t/f@2", "u/f": "t/f@1"}


def test_highest_revision_of_equal_and_unordered_dates(spark):
    commits = spark.createDataFrame([("o", 5, 1), ("o", 5, 2), ("o", 9, 3), ("o", 7, 4), ("o", 30, 5)], "origin string, d int, rev int")
    probes = spark.createDataFrame([("o", t) for t in (4, 5, 6, 8, 9, 20, 31)], "origin string, t int")
    for width in (1, 4, 100):
        got = asof_lookup(probes, commits, ["origin"], "t", "d", ["rev"], lambda c: F.floor(c / width), highest=True)
        assert {r.t: r.rev for r in got.collect()} == {4: None, 5: 2, 6: 2, 8: 4, 9: 4, 20: 4, 31: 5}


def test_incremental_copy_from_an_archived_revision(spark):
    from revtrail.plans.load import load, load_incremental
    from revtrail.sources.adapters import ChangeLog
    rows = [put(1, "trunk/m"), put(1, "trunk/old"), ("o", 2, 0, "trunk/old", "file", "delete", None, -1, None, None),
            put(3, "trunk/m"), copy(4, "trunk", 1, "tags/1"), copy(5, "tags", 4, "more"), put(5, "z")]
    rows = [(*r[:8], r[8] and hashlib.sha1(r[8].encode()).hexdigest(), r[9]) for r in rows]
    changes = spark.createDataFrame(rows, CHANGES)
    commits = spark.createDataFrame([("o", r, None, "me", f"c{r}") for r in range(1, 6)],
                                    "origin string, rev long, date timestamp, author string, message string")
    origins = spark.createDataFrame([("o", "u", "file:///o")], "origin string, uuid string, url string")
    full = load(ChangeLog(origins, commits, changes))
    want = {r.rev: r.revision_id for r in full.revisions.collect()}
    before = load(ChangeLog(origins, commits.where("rev <= 3"), changes.where("rev <= 3")))
    at = spark.createDataFrame([("o", 3)], "origin string, at_rev long")
    got = {r.rev: r.revision_id for r in load_incremental(ChangeLog(origins, commits, changes), before, at).revisions.collect()}
    assert got == {r: want[r] for r in (4, 5)}


def test_paths_clear_of_destinations_are_built_once(spark, monkeypatch):
    from revtrail.operators import copies as C
    built, seen = C.build_intervals, []

    def recorded(changes):
        seen.append({r.path for r in changes.select("path").collect()})
        return built(changes)
    monkeypatch.setattr(C, "build_intervals", recorded)
    log = [put(1, "a/x"), put(1, "b/y"), copy(2, "a", 1, "tags/1"), copy(3, "tags/1", 2, "tags/2")]
    assert files_at(spark, log, 3) == {"a/x": "a/x@1", "b/y": "b/y@1", "tags/1/x": "a/x@1", "tags/2/x": "a/x@1"}
    assert sum("b/y" in s for s in seen) == 1 and sum("a/x" in s for s in seen) == 1


def test_ancestors_are_exploded_as_deep_as_sources(spark):
    from revtrail.operators.copies import copy_rows, expand_once
    from revtrail.operators.intervals import build_intervals
    log = [put(1, "a/b/c/d/e"), put(1, "a/f"), copy(2, "a/b", 1, "t"), copy(2, "", 1, "all")]
    changes = spark.createDataFrame(log, CHANGES)
    got = expand_once(copy_rows(changes), build_intervals(changes.where("copyfrom_rev = -1")))
    assert {r.path for r in got.collect() if r.kind == "file"} == {"t/c/d/e", "all/a/b/c/d/e", "all/a/f"}


def test_a_copy_is_expanded_once(spark, monkeypatch):
    """A chain takes a round per link, in which only its next copies are expanded, from what is near destinations alone."""
    from revtrail.operators import copies as C
    given = []
    real = C.expand_once

    def recorded(copies, iv):
        given.append((sorted(r.dst for r in copies.collect()), {r.path for r in iv.files.collect()}))
        return real(copies, iv)
    monkeypatch.setattr(C, "expand_once", recorded)
    log = [put(1, "d1/f"), put(1, "far/g")] + [copy(i, f"d{i - 1}", i - 1, f"d{i}") for i in range(2, 6)] + [copy(6, "d5", 3, "e")]
    assert files_at(spark, log, 6) == {"far/g": "far/g@1"} | {f"d{i}/f": "d1/f@1" for i in range(1, 6)}
    # d5 did not exist at revision 3, so that copy waits for none and finds nothing
    assert [g for g, _ in given] == [["d2"], ["d3", "e"], ["d4"], ["d5"]]
    assert all("far/g" not in paths for _, paths in given[1:])


def test_copies_wait_for_what_they_read_above_and_below(spark):
    log = [put(1, "t/a"), copy(2, "t", 1, "x/y/z"), copy(3, "x", 2, "w"), copy(4, "w/y", 3, "v"), copy(5, "", 4, "all"), copy(6, "all/v/z", 5, "u")]
    got = files_at(spark, log, 6)
    assert got["u/a"] == got["all/x/y/z/a"] == got["all/w/y/z/a"] == got["v/z/a"] == "t/a@1" and "all/all/t/a" not in got


def test_what_is_read_by_nobody_is_let_go(spark, tmp_path):
    """Neither the shuffles of a table that is written nor the tables between two steps stay on disk."""
    from revtrail.operators import intervals as I
    from revtrail.session import cut_lineage, path_exists
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        names = disk.getAllFiles()
        return {names.apply(i).getName() for i in range(names.size()) if names.apply(i).getName().startswith("shuffle_")}
    before = shuffles()
    made = cut_lineage(spark.range(1000).repartition(7, "id"))
    for _ in range(100):  # they are removed in the background
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and made.count() == 1000
    cuts, real = [], I.cut_lineage
    I.cut_lineage = lambda df: cuts.append(real(df)) or cuts[-1]
    try:
        log = [put(1, "a/b"), put(1, "a/c"), ("o", 2, 0, "a", "dir", "delete", None, -1, None, None)]
        iv = I.build_intervals(spark.createDataFrame(log, CHANGES))
    finally:
        I.cut_lineage = real
    there = [df.cut_path for df in cuts if path_exists(spark, df.cut_path)]
    assert len(cuts) == 4 and sorted(there) == sorted(df.cut_path for df in iv.held)
    assert sorted((r.path, r.from_rev, r.to_rev) for r in iv.files.collect()) == [("a/b", 1, 2), ("a/c", 1, 2)]


def test_orders_log_is_made_once_and_a_subtree_alone_is_hashed(spark, monkeypatch):
    from paths import SF_SMALL

    from revtrail.operators import trees as T
    from revtrail.plans import catalog
    from revtrail.sources import adapters
    hashed = []
    real = T.build_trees
    monkeypatch.setattr(T, "build_trees", lambda iv, *a, **k: hashed.append(iv) or real(iv, *a, **k))
    assert adapters.orders_changelog(spark, SF_SMALL) is adapters.orders_changelog(spark, SF_SMALL)
    assert catalog.QUERIES["root_projection"](spark, SF_SMALL).count() > 0
    assert {r.p for r in hashed[0].files.selectExpr("substring_index(path, '/', 1) p").distinct().collect()} == {"p4"}


def test_rounds_end_with_a_copy_to_nowhere(spark):
    log = [put(1, "a/f"), copy(2, "a", 1, "b"), copy(3, "b", 2, None), copy(4, "b", 3, "c")]
    assert files_at(spark, log, 4)["c/f"] == "a/f@1"
