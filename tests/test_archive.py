"""The archive: visits as one commit, restore, flush limits, tree differences, checksums, options and jobs."""

import random

import pytest
from pyspark.sql import functions as F

import naive
from revtrail.operators.batches import flush_numbers, flush_sizes
from revtrail.operators.diff import changed_files, descend, diff_stat, root_steps
from revtrail.operators.trees import build_trees
from revtrail.plans import archive as A
from revtrail.plans.load import load, visit_snapshots
from revtrail.plans.options import LoadOptions
from revtrail.session import path_exists
from test_props import DATA, copy, frames, history, put


@pytest.fixture(scope="module")
def logs():
    return {f"o{i}": history(random.Random(100 + i), 9) for i in range(4)}


@pytest.fixture(scope="module")
def loaded(spark, logs):
    log, props, variants = frames(spark, logs)
    return load(log, props=props, variants=variants)


@pytest.fixture(scope="module")
def contents(spark):
    """Every content as it is and as it may be exported."""
    import re
    forms = set()
    for d in DATA.values():
        forms |= {d, d.removeprefix("link "), *(re.sub("\r\n|\r|\n", e, d) for e in ("\n", "\r\n", "\r"))}
    rows = [(naive.git_id(b"blob", d.encode()), len(d.encode()), bytearray(d.encode())) for d in forms]
    return spark.createDataFrame(rows, "id string, length long, data binary")


def test_restored_trees_equal_the_loaded_ones(spark, tmp_path, logs, loaded, contents):
    archive = A.Archive(spark, str(tmp_path))
    counts = archive.append("v1", A.objects(loaded, contents, "2024-01-01", max_size=4))
    assert counts["skipped_content"] and counts["content"] and counts["directory"] and counts["snapshot"] == len(logs)
    got = {}
    for r in A.restored(archive).collect():
        got.setdefault(r.origin, {})[r.path] = (r.perms, r.id)
    for o, own in logs.items():
        nodes = naive.replay_log(*own)[max(c[0] for c in own[0])]
        files = {p: naive.exported(DATA[b], props) for p, (k, b, props, _) in nodes.items() if k == "file"}
        assert {p: x for p, x in got.get(o, {}).items() if x[0] != 0o40000} == files
        assert {p for p, x in got.get(o, {}).items() if x[0] == 0o40000} == {p for p, n in nodes.items() if n[0] == "dir"}
    assert A.check_snapshots(archive).count() == 0
    kept = {r.id: r.length for r in archive.read("content").collect()}
    assert all(n <= 4 for n in kept.values())


def test_a_visit_counts_as_a_whole_or_not_at_all(spark, tmp_path, loaded, contents):
    archive = A.Archive(spark, str(tmp_path))
    tables = A.objects(loaded, contents, "2024-01-01")
    # stopped before its manifest: nothing is visible, though files are there
    archive.stage("v1", "content", tables["content"])
    archive.stage("v1", "directory", tables["directory"])
    assert path_exists(spark, f"{tmp_path}/content/visit=v1") and archive.read("content").count() == 0 and archive.committed() == []
    counts = archive.append("v1", tables)
    assert archive.committed() == ["v1"] and archive.read("content").count() == counts["content"] > 0
    assert set(archive.append("v1", tables).values()) == {0}
    again = archive.append("v2", {t: d for t, d in tables.items() if t != "visit"})
    assert set(again.values()) == {0} and archive.committed() == ["v1", "v2"]
    with pytest.raises(ValueError):
        archive.append("../v3", tables)


def test_snapshot_falls_back_to_the_one_before(spark):
    one = lambda rows: spark.createDataFrame(rows, "origin string, snapshot_id string")
    origins = spark.createDataFrame([("a",), ("b",)], "origin string")
    got = {r.origin: (r.snapshot_id, r.reused) for r in visit_snapshots(origins, one([("a", "new")]), one([("a", "old"), ("b", "old")])).collect()}
    assert got == {"a": ("new", False), "b": ("old", True)}
    with pytest.raises(Exception, match="neither a new revision"):
        visit_snapshots(origins, one([("a", "new")]), one([])).collect()


def test_checksums_tell_trees_apart(spark):
    rows = [("a", "x/y", 0o100644, "1"), ("a", "x", 0o40000, "2"), ("b", "x", 0o40000, "2"), ("b", "x/y", 0o100644, "1"), ("c", "x", 0o40000, "2"),
            ("c", "x/y", 0o100755, "1")]
    got = {r.origin: r.checksum for r in A.manifest_checksums(spark.createDataFrame(rows, "origin string, path string, perms int, id string")).collect()}
    assert got["a"] == got["b"] != got["c"]
    found = spark.createDataFrame([("d1", "s1"), ("d2", "s2")], "id string, checksum string")
    assert [tuple(r) for r in A.export_extids(found, spark.createDataFrame([("s2",)], "checksum string")).collect()] == [("d2", "sha256-manifest", "s2")]


@pytest.mark.parametrize("most_rows, most_bytes", [(3, 10**9), (10**9, 25), (4, 25), (1, 1), (1000, 10**9)])
def test_flushes_equal_a_fold(spark, most_rows, most_bytes):
    rng = random.Random(most_rows + most_bytes)
    rows = [(k, i, rng.choice([None, 0, 0, 1, 7, 12, 40])) for k in "ab" for i in range(rng.randint(0, 90))] + [("c", 0, 3)]
    df = spark.createDataFrame(rows, "k string, i long, size long")
    numbered = flush_numbers(df, ["k"], ["i"], F.floor(F.col("i") / 16), F.col("size"), most_rows, most_bytes)
    want, sizes = {}, {}
    for k in "abc":
        flush, held, total = 1, 0, 0
        for _, i, s in sorted(r for r in rows if r[0] == k):
            if held and (held >= most_rows or total >= most_bytes):
                flush, held, total = flush + 1, 0, 0
            held, total = held + 1, total + (s or 0)
            want[k, i] = flush
            sizes[k, flush] = (held, total)
    assert {(r.k, r.i): r.flush for r in numbered.collect()} == want
    assert {(r.k, r.flush): (r.rows, r.bytes) for r in flush_sizes(numbered, ["k"], F.col("size")).collect()} == sizes


def test_descent_finds_what_every_revision_changes(spark, logs):
    log, _, _ = frames(spark, logs)
    res = load(log)
    dirs = build_trees(res.intervals, log.origins, bodies=True).dirs
    entries = A.entries_of(dirs.where("body is not null").select(F.col("tree_id").alias("id"), "body").dropDuplicates(["id"])).cache()
    got = {}
    for r in descend(root_steps(res.trees.root), entries, ["origin", "rev"]).collect():
        got.setdefault((r.origin, r.rev), set()).add((r.path, r.kind, r.status))
    for o, own in logs.items():
        states = naive.replay_log(*own)
        for rev in range(1, max(states) + 1):
            # a directory's id from its listing alone
            old, new = ({p: (n[0], n[1] if n[0] == "file" else naive.state_tree_id(
                {q[len(p) + 1:]: m for q, m in s.items() if q.startswith(p + "/")})) for p, n in s.items()} for s in (states[rev - 1], states[rev]))
            want = set()
            for p in old.keys() | new.keys():
                if old.get(p) != new.get(p):
                    status = "added" if p not in old else "removed" if p not in new else "changed"
                    want.add((p, (new.get(p) or old.get(p))[0], status))
            assert got.get((o, rev), set()) == want, (o, rev)


def test_lines_of_changed_files(spark):
    log, _, _ = frames(spark, {"o": ([put(1, "a", "1"), put(2, "a", "2"), put(3, "a", "2"), (4, 0, "a", "file", "delete", None, -1, None), put(5, "a", "1"),
                                      copy(6, "", 5, "t")], [])})
    pairs = changed_files(load(log).intervals.files).collect()
    assert [(r.rev, r.path, r.old_id, r.new_id) for r in pairs] == [(2, "a", "1", "2")]
    texts = spark.createDataFrame([("1", "x\ny\ny\n"), ("2", "y\nz\n")], "id string, text string")
    ids = spark.createDataFrame([("1", "2"), ("1", "2"), ("2", "1")], "old_id string, new_id string")
    assert sorted(tuple(r) for r in diff_stat(ids, texts).collect()) == [("1", "2", 1, 2), ("2", "1", 2, 1)]


def test_options():
    assert LoadOptions.parse(["incremental=false", "check_revision=10", "origins=a,b"]) == LoadOptions(incremental=False, check_revision=10, origins="a,b")
    for bad in (["speed=1"], ["incremental=maybe"], ["check_revision=x"], ["incremental"]):
        with pytest.raises(ValueError):
            LoadOptions.parse(bad)


def test_load_job(spark, tmp_path, logs, contents):
    from revtrail.main import JOBS
    log, props, _ = frames(spark, logs)
    for name, df in (("origins", log.origins), ("commits", log.commits), ("changes", log.changes), ("props", props), ("contents", contents)):
        df.write.parquet(f"{tmp_path}/log/{name}")
    run = lambda *words: {r.origin: (r.load_status, r.visit_status, r.altered) for r in
                          JOBS["load_log"](spark, f"{tmp_path}/log", f"{tmp_path}/archive", LoadOptions.parse(list(words))).collect()}
    assert run("origins=o0,o1", "visit_date=2024-01-01") == dict.fromkeys(["o0", "o1"], ("eventful", "full", False))
    second = run("visit_date=2024-01-02")
    assert second["o0"] == ("uneventful", "full", False) and second["o3"] == ("eventful", "full", False)
    whole = {r.origin: r.snapshot_id for r in load(*[log], props=props, variants=frames(spark, logs)[2]).snapshots.collect()}
    visits = A.Archive(spark, f"{tmp_path}/archive").read("visit").collect()
    assert {r.origin: r.snapshot for r in visits} == whole
    third = run("origins=o1", "incremental=false", "check_revision=3", "visit_date=2024-01-03")
    assert third == {"o1": ("uneventful", "full", False)}
    JOBS["export"](spark, f"{tmp_path}/log", f"{tmp_path}/out", LoadOptions())
    assert spark.read.parquet(f"{tmp_path}/out").select("origin").distinct().count() == len([o for o in logs if naive.replay_log(*logs[o])[9]])
