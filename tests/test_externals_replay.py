"""Externals at every revision against a sequential replay, and the rules one by one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import naive
from revtrail.operators import externals as X
from revtrail.operators.copies import expand_copies
from revtrail.operators.sweep import union_of, winners, without
from revtrail.operators.trees import build_trees
from revtrail.plans.load import tree_at_revision

CHANGES = ("origin string, rev long, seq int, path string, kind string, action string, "
           "copyfrom_path string, copyfrom_rev long, blob_id string, length long")
PROPS = "origin string, rev long, path string, name string, value string"
START = dt.datetime(2020, 1, 1)


def put(rev, path, blob=None, seq=2):
    return (rev, seq, path, "file", "put", None, -1, naive.git_id(b"blob", (blob or f"{path}@{rev}").encode()))


def copy(rev, src, src_rev, dst):
    return (rev, 1, dst, "dir", "copy", src, src_rev, None)


def delete(rev, path, kind="dir"):
    return (rev, 0, path, kind, "delete", None, -1, None)


def ext(rev, path, *lines):
    return (rev, path, "svn:externals", "\n".join(lines) if lines else None)


def run(spark, logs, dates):
    """(nodes {origin: {rev: {path: (kind, id)}}}, root ids, status rows)"""
    day = lambda o, r: START + dt.timedelta(hours=dates[o][r])
    heads = {o: max(c[0] for c in own[0]) for o, own in logs.items()}
    commits = spark.createDataFrame([(o, r, day(o, r)) for o in logs for r in range(1, heads[o] + 1)], "origin string, rev long, date timestamp")
    origins = spark.createDataFrame([(o, f"u-{o}", f"file:///repos/{o}") for o in logs], "origin string, uuid string, url string")
    changes = spark.createDataFrame([(o, *r, 1) for o, (c, _) in logs.items() for r in c], CHANGES)
    props = spark.createDataFrame([(o, *p) for o, (_, ps) in logs.items() for p in ps], PROPS)
    found = expand_copies(changes)
    iv, lineage = found.intervals, found.lineage
    made = X.applied(props, origins, commits, iv, lineage)
    nodes, status = made["nodes"], made["status"]
    rows = nodes.collect()
    got = {o: {rev: {r.path: (r.kind, r.id) for r in rows if r.origin == o and r.from_rev <= rev < r.to_rev} for rev in range(1, heads[o] + 1)}
           for o in logs}
    roots = tree_at_revision(commits, build_trees(X.as_intervals(nodes), origins).root)
    return got, {(r.origin, r.rev): r.tree_id for r in roots.collect()}, status


def history(rng, me, others, revs):
    changes, props = [], []
    for rev in range(1, revs + 1):
        states = naive.replay_log(changes, props) if changes else {0: {}}
        alive = states[max(states)]
        dirs = sorted(p for p, n in alive.items() if n[0] == "dir" and p)
        kind = rng.random()
        if kind < 0.12 and dirs:
            changes.append(delete(rev, rng.choice(dirs)))
        elif kind < 0.3 and rev > 2:
            src_rev = rng.randrange(1, rev)
            sources = sorted(p for p, n in states[src_rev].items() if n[0] == "dir")
            if sources:
                changes.append(copy(rev, rng.choice(sources), src_rev, f"t{rng.randrange(3)}"))
        if not any(c[0] == rev for c in changes):
            changes.append(put(rev, f"{rng.choice(['a', 'b', 'a/c'])}/{rng.choice('fgh')}"))
        alive = naive.replay_log(changes, [])[rev]
        hosts = ["", *sorted(p for p, n in alive.items() if n[0] == "dir")]
        if rng.random() < 0.6:
            lines = []
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                sub = rng.choice(["/a", "/b", "/a/c", "/t0", "", "/nowhere", "/a/f", "/b/g"])
                url, to = f"file:///repos/{rng.choice(others)}{sub}", rng.choice(["x", "y", "x/z", "c", "f"])
                form = rng.randrange(6)
                line = [f"{to} {url}", f"{url} {to}", f"-r{rng.randrange(1, revs + 2)} {url} {to}", f"{to} -r{rng.randrange(1, revs)} {url}",
                        f"{url}@{rng.randrange(1, revs + 2)} {to}", f"-r{rng.randrange(1, revs)} {url}@{rng.randrange(1, revs)} {to}"][form]
                lines.append(line)
            if rng.random() < 0.05:
                lines.append(f"file:///repos/{me} self")
            if rng.random() < 0.05:
                lines.append("-rx file:///repos/q bad")
            props.append(ext(rev, rng.choice(hosts), *lines))
    return changes, props


def even(logs, step=10):
    return {o: {r: step * r for r in range(1, max(c[0] for c in own[0]) + 1)} for o, own in logs.items()}


def scenarios():
    """{name: (logs, dates)}; a scenario's origins begin with its name."""
    out = {}

    def add(name, logs, dates=None):
        out[name] = logs, dates or even(logs)

    rng = random.Random(0)
    names = ["rnd_m", "rnd_n", "rnd_o", "rnd_p", "rnd_q"]
    logs = {o: history(rng, o, [x for x in names if x != o], 14) for o in names}
    add("rnd", logs, {o: dict(enumerate(sorted(rng.sample(range(400), 14)), 1)) for o in names})
    add("merge", {"merge_e": ([put(1, "src/foo"), put(1, "one")], []),
                  "merge_m": ([put(1, "trunk/src/bar"), put(1, "trunk/one"), put(2, "trunk/z"), put(3, "trunk/one"), put(4, "q")],
                              [ext(2, "trunk", "file:///repos/merge_e/src src", "file:///repos/merge_e/one one"), ext(4, "trunk")])})
    add("float", {"float_e": ([put(r, "lib/f") for r in range(1, 9)], []),
                  "float_m": ([put(r, f"a/v{r}") for r in range(1, 9)],
                              [ext(2, "a", "file:///repos/float_e/lib x"), ext(4, "a", "file:///repos/float_e/lib x", "file:///repos/float_e/lib y"),
                               ext(5, "a"), ext(7, "a", "file:///repos/float_e/lib x")])})
    add("two", {"two_e": ([put(r, "lib/f") for r in range(1, 7)], []), "two_d": ([put(1, "k/g")], []),
                "two_m": ([put(r, "a/v") for r in range(1, 7)],
                          [ext(2, "a", "file:///repos/two_e/lib x", "file:///repos/two_d/k x"), ext(5, "a", "file:///repos/two_e/lib x")])})
    add("peg", {"peg_e": ([put(1, "old/f"), put(2, "old/f"), copy(3, "old", 2, "new"), delete(4, "old"), put(5, "new/f"), put(6, "old/g")], []),
                "peg_m": ([put(r, "a/v") for r in range(1, 9)],
                          [ext(7, "a", "-r1 file:///repos/peg_e/new@5 moved", "-r5 file:///repos/peg_e/new@3 later", "-r1 file:///repos/peg_e/old@6 other",
                               "gone -r2 file:///repos/peg_e/old", "-r2 file:///repos/peg_e/old lost")])})
    add("own", {"own_e": ([put(1, "lib/f")], []),
                "own_m": ([put(1, "a/b/v"), put(2, "z"), delete(3, "a/b"), put(4, "z"), put(5, "a/b/w"), put(6, "z"), delete(7, "a"), put(8, "z")],
                          [ext(2, "a", "file:///repos/own_e/lib b/own"), ext(2, "a/b", "file:///repos/own_e/lib mine"),
                           ext(6, "", "file:///repos/own_e/lib a/b/own")])})
    add("bad", {"bad_e": ([put(1, "lib/f")], []),
                "bad_m": ([put(r, "a/v") for r in range(1, 8)],
                          [ext(2, "a", "file:///repos/bad_e/lib x"), ext(3, "", "file:///repos/bad_m self"), ext(5, ""),
                           ext(6, "a", "file:///repos/bad_e/lib x", "-rx q//q y")])})
    add("cpy", {"cpy_e": ([put(1, "lib/f"), put(3, "lib/f"), (3, 2, "bad/x", "file", "put", None, -1, None), put(3, "bad/y")], []),
                "cpy_m": ([put(1, "a/v"), put(2, "z"), copy(4, "a", 3, "t"), put(3, "z"), put(5, "z")],
                          [ext(2, "a", "file:///repos/cpy_e/lib x"), ext(5, "a", "file:///repos/cpy_e/bad p/b")])},
        {"cpy_e": {1: 10, 2: 15, 3: 35}, "cpy_m": {1: 1, 2: 20, 3: 30, 4: 40, 5: 50}})
    add("dead", {"dead_e": ([put(1, "x"), put(3, "lib/f"), put(5, "q")], []),
                 "dead_m": ([put(r, "a/v") for r in range(1, 6)],
                            [ext(2, "a", "file:///repos/dead_e/lib deep/down"), ext(4, "a"), ext(5, "a", "file:///repos/dead_e/lib deep/down")])})
    return out


@pytest.fixture(scope="module")
def ran(spark):
    every = scenarios()
    logs = {o: own for part, _ in every.values() for o, own in part.items()}
    dates = {o: own for _, part in every.values() for o, own in part.items()}
    got, roots, status = run(spark, logs, dates)
    return logs, naive.replay_externals(logs, dates), got, roots, status.collect()


def test_all_revisions_equal_a_sequential_replay(ran):
    logs, want, got, roots, _ = ran
    for o in logs:
        for rev in want[o]:
            if not o.startswith("cpy"):  # its unreadable file is no part of the replay
                assert got[o][rev] == want[o][rev], (o, rev)
                assert roots[o, rev] == naive.state_tree_id({p: (k, b, {}) for p, (k, b) in want[o][rev].items()}), (o, rev)


def test_merges_with_a_versioned_directory_and_hides_a_file(ran):
    m, one = ran[2]["merge_m"], naive.git_id(b"blob", b"one@1")
    assert {"trunk/src/bar", "trunk/src/foo"} <= set(m[2]) and m[2]["trunk/one"] == m[3]["trunk/one"] == ("file", one)
    assert "trunk/src/foo" not in m[4] and m[4]["trunk/one"] == ("file", naive.git_id(b"blob", b"trunk/one@3"))


def test_floating_external_stays_as_first_exported(ran):
    m, first = ran[2]["float_m"], ("file", naive.git_id(b"blob", b"lib/f@2"))
    assert [m[r].get("a/x/f") for r in (2, 3, 4, 6, 7, 8)] == [first, first, first, None, first, first]
    assert m[4]["a/y/f"] == ("file", naive.git_id(b"blob", b"lib/f@4"))


def test_survivor_of_two_definitions_is_exported_again(ran):
    m = ran[2]["two_m"]
    assert m[4]["a/x/f"] == ("file", naive.git_id(b"blob", b"lib/f@2")) and "a/x/g" in m[4]
    assert m[5]["a/x/f"] == ("file", naive.git_id(b"blob", b"lib/f@5")) and "a/x/g" not in m[5]


def test_operative_revision_of_the_node_at_the_peg(ran):
    """-r7 url@9 is the node found at 9, as it was at 7, also if it was moved in between."""
    m = ran[2]["peg_m"]
    blob = lambda rev, p="old/f": ("file", naive.git_id(b"blob", f"{p}@{rev}".encode()))
    assert m[8] == {"a": ("dir", None), "a/v": m[8]["a/v"], "a/moved": ("dir", None), "a/moved/f": blob(1),
                    "a/later": ("dir", None), "a/later/f": blob(5, "new/f"), "a/gone": ("dir", None), "a/gone/f": blob(2)}
    assert sorted(r.path for r in ran[4] if r.origin == "peg_m" and r.status == "dead") == ["lost", "other"]


def test_what_ancestors_own_survives_a_delete(ran):
    paths = {r: set(s) for r, s in ran[2]["own_m"].items()}
    assert {"a/b/own/f", "a/b/mine/f", "a/b/v"} <= paths[2]
    assert "a/b/own/f" in paths[3] and not {"a/b/mine", "a/b/v"} & paths[4]
    assert "a/b/mine" not in paths[5]  # the directory that comes back has no property
    assert paths[7] == paths[8] == {"z", "a", "a/b", "a/b/own", "a/b/own/f"}


def test_recursive_and_unparsable_values(ran):
    m = ran[2]["bad_m"]
    assert [("a/x/f" in m[r]) for r in range(1, 8)] == [False, True, False, False, True, False, False]
    assert {r.status for r in ran[4] if r.origin == "bad_m"} == {"valid", "recursive", "unparsable"}


def test_copied_property_uses_the_first_export_and_corrupted_targets(ran):
    m = ran[2]["cpy_m"]
    assert m[4]["t/x/f"] == m[4]["a/x/f"] == ("file", naive.git_id(b"blob", b"lib/f@1"))
    assert m[5]["a/p"] == ("dir", None) and "a/p/b" not in m[5]
    assert [r.status for r in ran[4] if r.origin == "cpy_m" and r.path == "p/b"] == ["corrupted"]


def test_dead_definition_makes_its_parents_and_isnt_tried_again(ran):
    m = ran[2]["dead_m"]
    assert [set(m[r]) for r in (2, 4, 5)] == [{"a", "a/v", "a/deep"}, {"a", "a/v"}, {"a", "a/v", "a/deep"}]


def test_interval_algebra_against_every_moment(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randrange(4), f, f + rng.randrange(0, 9)) for f in (rng.randrange(30) for _ in range(60))]
    df = spark.createDataFrame(rows, "k string, v int, from_rev long, to_rev long")
    at = lambda rs, k, t: [r for r in rs if r[0] == k and r[-2] <= t < r[-1]]
    won = [tuple(r) for r in winners(df, ["k"], F.col("v"), ["v"]).collect()]
    some = [tuple(r) for r in union_of(df, ["k"]).collect()]
    holes = [("a", 3, 8), ("a", 6, 12), ("b", 0, 2), ("c", 1, 2)]
    left = [tuple(r) for r in without(winners(df, ["k"], F.col("v"), ["v"]), spark.createDataFrame(holes, "k string, from_rev long, to_rev long"),
                                      ["k"], ["v"]).collect()]
    for k in "ab":
        for t in range(45):
            vs = sorted(r[1] for r in at(rows, k, t))
            assert [r[1] for r in at(won, k, t)] == vs[:1] and len(at(some, k, t)) == bool(vs)
            assert [r[1] for r in at(left, k, t)] == ([] if at(holes, k, t) else vs[:1])
    ends = sorted((r[0], r[-2], r[-1], r[1]) for r in won)
    assert all(not (a[0] == b[0] and a[2] == b[1] and a[3] == b[3]) for a, b in zip(ends, ends[1:]))
