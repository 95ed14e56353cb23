"""Properties through lifetimes, copies and increments against a sequential replay."""

import random

import pytest
from pyspark.sql import functions as F

import naive
from revtrail.plans.export import content_variants
from revtrail.plans.load import load, load_incremental
from revtrail.sources.adapters import ChangeLog

CHANGES = ("origin string, rev long, seq int, path string, kind string, action string, "
           "copyfrom_path string, copyfrom_rev long, blob_id string, length long")
PROPS = "origin string, rev long, path string, name string, value string"
NAMES = {"svn:executable": ["*"], "svn:special": ["*"], "svn:eol-style": ["native", "CRLF", "CR", "odd"]}
DATA = {naive.git_id(b"blob", d.encode()): d for d in
        ["plain", "link a/f", "one\r\ntwo\n", "x\ry\n", "link \r\n", "é\n", *(f"v{i}\n" for i in range(20))]}


def put(rev, path, blob, seq=2):
    return (rev, seq, path, "file", "put", None, -1, blob)


def copy(rev, src, src_rev, dst):
    return (rev, 1, dst, "dir", "copy", src, src_rev, None)


def history(rng, revs):
    """A random log: puts, deletes, copies (of copies, of roots of copies, with
    files replaced inside them) and property changes."""
    dirs, files, blobs = ["a", "b", "c", "a/d", "b/d"], ["f", "g", "h"], list(DATA)
    changes, props = [], []
    for rev in range(1, revs + 1):
        where = rng.choice(dirs)
        kind = rng.random()
        alive = naive.replay_log(changes, [])[rev - 1] if changes and max(c[0] for c in changes) == rev - 1 else {}
        if kind < 0.3 and rev > 2:
            states = naive.replay_log(changes, [])
            src_rev = rng.randrange(1, rev)
            sources = [p for p, n in states.get(src_rev, {}).items() if n[0] == "dir"]
            if sources:
                src, dst = rng.choice(sources), f"t{rng.randrange(4)}" if rng.random() < 0.6 else f"{where}/k{rng.randrange(2)}"
                changes.append(copy(rev, src, src_rev, dst))
                if rng.random() < 0.4:
                    changes.append(put(rev, f"{dst}/{rng.choice(files)}", rng.choice(blobs)))
        elif kind < 0.42 and alive:
            path = rng.choice(sorted(alive))
            changes.append((rev, 0, path, alive[path][0], "delete", None, -1, None))
        if not any(c[0] == rev for c in changes):
            changes.append(put(rev, f"{where}/{rng.choice(files)}", rng.choice(blobs)))
        alive = sorted(p for p, n in naive.replay_log(changes, [])[rev].items() if n[0] == "file")
        for path in rng.sample(alive, min(len(alive), rng.choice([0, 1, 2, 3]))):
            name = rng.choice(list(NAMES))
            props.append((rev, path, name, rng.choice([None, *NAMES[name] * 2])))
    return changes, props


def frames(spark, logs):
    changes = [(o, *r[:7], r[7], 1) for o, (c, _) in logs.items() for r in c]
    props = [(o, *p) for o, (_, ps) in logs.items() for p in ps]
    variants = spark.createDataFrame([(d,) for d in DATA.values()], "d string").select(*content_variants(F.encode("d", "UTF-8")))
    commits = [(o, r, None, "me", f"c{r}") for o, (c, _) in logs.items() for r in range(1, max(x[0] for x in c) + 1)]
    return (ChangeLog(spark.createDataFrame([(o, f"uuid-{o}", f"file:///repos/{o}") for o in logs], "origin string, uuid string, url string"),
                      spark.createDataFrame(commits, "origin string, rev long, date timestamp, author string, message string"),
                      spark.createDataFrame(changes, CHANGES)),
            spark.createDataFrame(props, PROPS), variants)


@pytest.fixture(scope="module")
def logs():
    return {f"o{i}": history(random.Random(i), 12) for i in range(8)}


@pytest.fixture(scope="module")
def full(spark, logs):
    log, props, variants = frames(spark, logs)
    return load(log, props=props, variants=variants)


def test_states_equal_a_sequential_replay(full, logs):
    files, dirs, values = full.intervals.files.collect(), full.intervals.dirs.collect(), full.props.collect()
    for origin, own in logs.items():
        for rev, want in naive.replay_log(*own).items():
            at = lambda rows: [r for r in rows if r.origin == origin and r.from_rev <= rev < r.to_rev]  # noqa: B023, E731
            assert {r.path: r.blob_id for r in at(files)} == {p: n[1] for p, n in want.items() if n[0] == "file"}, (origin, rev)
            assert {r.path for r in at(dirs)} == {p for p, n in want.items() if n[0] == "dir"}, (origin, rev)
            assert {(r.path, r.name): r.value for r in at(values)} == {(p, k): v for p, n in want.items() for k, v in n[2].items()}, (origin, rev)
            assert len(at(values)) == sum(len(n[2]) for n in want.values())


def test_exported_tree_ids_equal_a_sequential_replay(full, logs):
    got = {(r.origin, r.rev): r.tree_id for r in full.tree_at_rev.collect()}
    want = {(o, rev): naive.state_tree_id(s, DATA) for o, own in logs.items() for rev, s in naive.replay_log(*own).items() if rev}
    assert got == want


def test_increment_with_properties_equals_the_full_load(spark, logs, full):
    at = 6
    log, props, variants = frames(spark, logs)
    want = {(r.origin, r.rev): r.revision_id for r in full.revisions.collect()}
    before = ChangeLog(log.origins, log.commits.where(F.col("rev") <= at), log.changes.where(F.col("rev") <= at))
    first = load(before, props=props.where(F.col("rev") <= at), variants=variants)
    last = log.origins.select("origin", F.lit(at).cast("long").alias("at_rev"))
    more = load_incremental(log, first, last, props=props, variants=variants)
    got = {(r.origin, r.rev): r.revision_id for r in more.revisions.collect()}
    assert got == {k: v for k, v in want.items() if k[1] > at}


def test_copied_executable_and_chain(spark):
    blob = {d: b for b, d in DATA.items()}
    log = ([put(1, "trunk/x", blob["plain"]), put(1, "trunk/l", blob["link a/f"]), copy(2, "trunk", 1, "tags/1"), put(3, "trunk/x", blob["v1\n"]),
            copy(4, "tags", 3, "old"), copy(5, "old/1", 4, "trunk/again"), put(5, "trunk/again/x", blob["v2\n"])],
           [(1, "trunk/x", "svn:executable", "*"), (1, "trunk/l", "svn:special", "*"), (3, "trunk/x", "svn:executable", None),
            (5, "trunk/again/l", "svn:special", None)])
    changes, props, variants = frames(spark, {"o": log})
    files = load(changes, props=props, variants=variants).exported.files.collect()
    modes = lambda rev: {r.path: oct(r.perms) for r in files if r.from_rev <= rev < r.to_rev}
    assert modes(3) == {"trunk/x": "0o100644", "trunk/l": "0o120000", "tags/1/x": "0o100755", "tags/1/l": "0o120000"}
    assert modes(5) == modes(3) | {"old/1/x": "0o100755", "old/1/l": "0o120000", "trunk/again/x": "0o100755", "trunk/again/l": "0o100644"}


def test_lifetimes_are_read_once(spark):
    from pyspark.sql import functions as F

    from revtrail.operators.props import prop_state
    n = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            n.add(len(b))
            yield b
    lives = spark.createDataFrame([("o", "a", 1, 9), ("o", "b", 2, 9)], "origin string, path string, life_from long, life_to long")
    lives = lives.mapInPandas(counted, lives.schema)
    events = spark.createDataFrame([("o", 1, "a", "p", "v")], "origin string, rev long, path string, name string, value string")
    lineage = spark.createDataFrame([("o", "b", 2, "a", 1)], "origin string, path string, rev long, src_path string, src_rev long")
    state = prop_state(events, lives, lineage).orderBy(F.col("path")).collect()
    assert [(r.path, r.value, r.from_rev, r.to_rev) for r in state] == [("a", "v", 1, 9), ("b", "v", 2, 9)]
    assert n.value == 2
