"""Steps of a load run when they are asked for, and once; so do the parts of the externals."""

import datetime as dt

import pytest

from revtrail.operators import externals as X
from revtrail.operators import props as P
from revtrail.plans import archive as A
from revtrail.plans import load as L
from test_props import frames, put

LOG = {"o": ([put(1, "d/a", "1"), put(2, "d/b", "2"), put(3, "c", "3")], [(1, "d/a", "svn:executable", "*")])}


@pytest.fixture
def built(monkeypatch):
    calls = []
    real = L.build_trees
    monkeypatch.setattr(L, "build_trees", lambda *a, **k: calls.append(k) or real(*a, **k))
    return calls


def test_intervals_need_no_trees_and_trees_are_built_once(spark, built):
    log, props, variants = frames(spark, LOG)
    res = L.load(log, props=props, variants=variants)
    assert res.intervals.files.count() == 3 and not built
    contents = spark.createDataFrame([], "id string, length long, data binary")
    tables = A.objects(res, contents, "2024-01-01")
    assert tables["directory"].count() == tables["directory"].select("id").distinct().count() and res.trees.dirs.count() > 0
    assert built == [{"bodies": True}] and "body" not in res.trees.dirs.columns


def test_revisions_are_kept_not_worked_out_by_every_reader(spark, built):
    log, _, _ = frames(spark, LOG)
    res = L.load(log)
    assert [r.rev for r in res.revisions.orderBy("rev").collect()] == [1, 2, 3]
    plan = res.snapshots._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and len(built) == 1


def test_without_copies_no_values_are_looked_up_for_them(spark, monkeypatch):
    log, props, _ = frames(spark, LOG)
    res = L.load(log)
    monkeypatch.setattr(P, "inherited", lambda *a: pytest.fail("nothing is copied"))
    got = P.prop_state(props, P.node_lifetimes(res.intervals), res.lineage).collect()
    assert [(r.path, r.name, r.value, r.from_rev) for r in got] == [("d/a", "svn:executable", "*", 1)]


def test_definitions_need_no_overlay(spark):
    changes = {o: ([put(1, "d/a", "1")], [(1, "d", "svn:externals", "ext file:///repos/p/d")]) for o in ("o", "p")}
    log, props, _ = frames(spark, changes)
    commits = spark.createDataFrame([(o, 1, dt.datetime(2024, 1, 1)) for o in changes], "origin string, rev long, date timestamp")
    origins = spark.createDataFrame([(o, "u", f"file:///repos/{o}") for o in changes], "origin string, uuid string, url string")
    res = L.load(log)
    made = X.applied(props, origins, commits, res.intervals, res.lineage)
    assert made["defs"].count() == 2 and set(made) == {"defs"}
    assert made["status"].count() == 2 and "nodes" not in made


def test_lifetimes_of_the_asked_paths_alone(spark):
    log, _, _ = frames(spark, LOG)
    iv = L.load(log).intervals
    asked = spark.createDataFrame([("o", "d/a"), ("o", ""), ("o", "gone"), ("x", "d/a")], "origin string, path string")
    assert sorted(r.path for r in P.node_lifetimes(iv, asked).collect()) == ["", "d/a"]
    assert sorted(r.path for r in P.node_lifetimes(iv).collect()) == ["", "c", "d", "d/a", "d/b"]


def test_a_small_file_of_many_rows_is_no_broadcast(spark):
    """Rows that repeat are small as a file and large on the driver."""
    from revtrail.session import cut_lineage
    side = cut_lineage(spark.range(600_000).selectExpr("id", "'a long text that is the same in every row of it' as t"))
    size = int(spark.read.parquet(side.cut_path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    plans, real = [], type(side.write).parquet

    def recorded(writer, path, *a, **k):
        plans.append(writer._df._jdf.queryExecution().sparkPlan().toString())
        return real(writer, path, *a, **k)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(3 * size))
    try:
        type(side.write).parquet = recorded
        made = cut_lineage(side.selectExpr("id", "t as u").join(side, "id"))
    finally:
        type(side.write).parquet = real
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert made.count() == 600_000
    assert plans and "BroadcastHashJoin" not in plans[0]
    assert spark.conf.get("spark.sql.sources.fileCompressionFactor") == "1.0"
