"""Externals: definitions stored in a directory property that graft a
subtree of another repository (at some revision) into this one.

Pipeline, all on tables: property intervals -> lines -> parsed definitions
(one bad line voids the property value) -> recursion check -> the export each
stretch of a definition uses -> distinct exports resolved once -> target
subtree rows re-rooted under the host directory -> overlay over the versioned
nodes at every revision.

*Exports.*  Within a run a definition is exported when it first appears
anywhere in the repository, and what was exported is used wherever the same
definition appears later.  It stays as it was while the definition stays in
its directory, whatever else of the property changes (islands of consecutive
property intervals).  Only when another definition of the same target path
goes away is the first one left for it exported again.  Once an export finds
nothing the definition is dead and isn't tried again.

*Revisions.*  A definition names a node by its path at the peg revision, and
reads it at the operative one, whatever its path was then: the node's
lifetime at the peg is looked up (as-of on path), and if it began after the
operative revision as a copy, its source is followed, in rounds, one per link
of copies.  The peg is the one given (a number or a date), else for lines in
the old format the operative revision, else the target's revision current
at the date of the host revision whose export is used; the operative revision
is the one given, else the peg.

*Overlay.*  A graft wins over a versioned node of its path and merges with
what else is there; nodes below a file are hidden; the parent directories of
a target exist, also of a dead one.  While any definition of a repository is
recursive, none of its externals counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.externals import externals_lines, parse_external
from revtrail.functions.hashing import INF_REV, PERM_FILE
from revtrail.functions.paths import ancestors
from revtrail.functions.urls import is_recursive_external, root_url_candidates
from revtrail.operators.intervals import Intervals, with_path_parts
from revtrail.operators.ordinals import asof_lookup
from revtrail.operators.props import node_lifetimes, prop_state
from revtrail.operators.sweep import union_of, winners, without
from revtrail.session import cut_lineage

NAME = "svn:externals"
#: What makes two definitions the same; the optional revisions as null-safe keys.
SAME = ["path", "url", "rev_k", "peg_k", "date_k", "relative_url", "legacy_format"]


def _bucket(c):
    return F.floor(c / 4096)


def _join_path(dir_: Column, path: Column) -> Column:
    return F.when(dir_ == "", path).otherwise(F.concat(dir_, F.lit("/"), path))


def external_intervals(prop_events: DataFrame, iv: Intervals, lineage: DataFrame | None = None) -> DataFrame:
    """(origin, dir, value, from_rev, to_rev) of svn:externals values within
    each directory lifetime, copied directories included."""
    events = cut_lineage(prop_events.where(F.col("name") == NAME))
    paths = events.select("origin", "path")
    if lineage is not None:
        paths = paths.unionByName(lineage.select("origin", "path"))
    st = prop_state(events, node_lifetimes(iv, paths.distinct()), lineage)
    dirs = iv.dirs.select("origin", "path").distinct()
    return st.join(dirs, ["origin", "path"], "left_semi").unionByName(st.where(F.col("path") == "")).select(
        "origin", F.col("path").alias("dir"), "value", "from_rev", "to_rev")


def definitions(intervals: DataFrame, origins: DataFrame) -> DataFrame:
    """Parsed definitions per property interval; ``void`` marks values with
    an unparsable line (none of their definitions apply)."""
    lines = intervals.join(origins.select("origin", F.col("url").alias("origin_url")), "origin") \
        .select("origin", "origin_url", "dir", "from_rev", "to_rev",
                F.explode(externals_lines(F.col("value"))).alias("l")) \
        .select("*", F.col("l.line_no").alias("line_no"), F.col("l.line").alias("line")).drop("l")
    # parsing takes long for few bytes: dealt by number, not merged by size, and as the windows below need them
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = lines.repartition(tasks, "origin", "dir", "from_rev")
    repo_url = F.col("origin_url")
    parsed = lines.withColumn("d", parse_external(F.col("line"), F.col("dir"), repo_url))
    d = F.col("d")
    out = parsed.select("origin", "origin_url", "dir", "from_rev", "to_rev", "line_no", "line",
                        d["path"].alias("path"), d["url"].alias("url"),
                        d["revision"].alias("revision"), d["peg_revision"].alias("peg_revision"),
                        d["peg_date"].alias("peg_date"), d["relative_url"].alias("relative_url"),
                        d["legacy_format"].alias("legacy_format"), d["error"].alias("error"))
    w = Window.partitionBy("origin", "dir", "from_rev")
    out = out.withColumn("void", F.bool_or(F.col("error").isNotNull()).over(w))
    rec = is_recursive_external(repo_url, F.col("dir"), F.col("path"), F.col("url"))
    rank = F.row_number().over(Window.partitionBy("origin", "dir", "from_rev", "path")
                               .orderBy("line_no"))
    return (out.withColumn("recursive", F.when(F.col("error").isNull(), rec).otherwise(F.lit(False)))
            .withColumn("rank", F.when(F.col("error").isNull(), rank))
            .withColumn("rev_k", F.coalesce(F.col("revision"), F.lit(-1)))
            .withColumn("peg_k", F.coalesce(F.col("peg_revision"), F.lit(-1)))
            .withColumn("date_k", F.coalesce(F.col("peg_date"), F.lit(""))))


def removed(defs: DataFrame) -> DataFrame:
    """(origin, dir, rev, path, url) of definitions that were in the value
    ending at ``rev`` and aren't in the one that starts there, if any does."""
    key = ["path", "url", "rev_k", "peg_k"]
    d = defs.where(F.col("error").isNull() & ~F.col("void"))
    prev = d.where(F.col("to_rev") < F.lit(INF_REV)).select("origin", "dir", F.col("to_rev").alias("rev"), *key)
    cur = d.select("origin", "dir", F.col("from_rev").alias("rev"), *key)
    return prev.join(cur, ["origin", "dir", "rev", *key], "left_anti").select("origin", "dir", "rev", "path", "url").distinct()


def with_exports(defs: DataFrame) -> DataFrame:
    """Usable definitions with ``export_rev``, the host revision whose export
    they use: the last one, by the start of their island, of any directory."""
    d = defs.where(F.col("error").isNull() & ~F.col("void") & ~F.col("recursive"))
    gone = removed(defs).select("origin", "dir", F.col("rev").alias("from_rev"), "path").distinct()
    forced = d.where(F.col("rank") == 1).join(gone, ["origin", "dir", "from_rev", "path"], "left_semi") \
        .select("origin", "dir", "from_rev", "line_no", F.lit(True).alias("again"))
    d = d.join(forced, ["origin", "dir", "from_rev", "line_no"], "left")
    # a value may repeat a definition
    d = d.withColumn("copy_no", F.row_number().over(Window.partitionBy("origin", "dir", "from_rev", *SAME).orderBy("line_no")))
    along = Window.partitionBy("origin", "dir", *SAME, "copy_no").orderBy("from_rev")
    new = F.coalesce("again", F.lit(False)) | ~F.lag("to_rev").over(along).eqNullSafe(F.col("from_rev"))
    d = d.withColumn("starts", F.when(new, F.col("from_rev")))
    d = cut_lineage(d.withColumn("since", F.max("starts").over(along.rowsBetween(Window.unboundedPreceding, 0))))
    exports = d.groupBy("origin", *SAME).agg(F.min("from_rev").alias("export_rev")).unionByName(
        d.where("again").select("origin", *SAME, F.col("from_rev").alias("export_rev"))).distinct()
    return asof_lookup(d, exports, ["origin", *SAME], "since", "export_rev", ["export_rev"], _bucket) \
        .drop("again", "copy_no", "starts", "since")


def resolve(used: DataFrame, origins: DataFrame, commits: DataFrame, iv: Intervals, lineage: DataFrame) -> DataFrame:
    """Distinct (url, revisions, format, host date) of ``used`` -> target
    origin, sub path, revision read and the path there (``node``: null if
    there is none, then the definition is dead)."""
    keys = ["url", "rev_k", "peg_k", "date_k", "legacy_format", "host_date"]
    keyed = used.select(*keys, "revision", "peg_revision", "peg_date").distinct()
    cands = keyed.select("url", F.posexplode(root_url_candidates(F.col("url"))).alias("pos", "cand")).distinct()
    hit = cands.join(origins.select(F.col("url").alias("cand"), F.col("origin").alias("target")), "cand")
    best = hit.groupBy("url").agg(F.min_by(F.struct("target", "cand"), F.col("pos")).alias("b"))
    r = keyed.join(best, "url", "left").select(
        "*", F.col("b.target").alias("target_origin"),
        F.regexp_replace(F.substring(F.col("url"), F.length("b.cand") + 1, 1 << 30), "^/+|/+$", "")
        .alias("sub_path")).drop("b")
    known = commits.select("origin", "date", F.col("rev").alias("asof_rev"))

    def current(rows: DataFrame, when: str, out: str) -> DataFrame:
        """The target revision current at ``when`` for each key."""
        rows = rows.where(F.col("target_origin").isNotNull()).withColumnRenamed("target_origin", "origin")
        at = asof_lookup(rows.select("origin", F.col(when).alias("_when"), *[k for k in keys]), known,
                         ["origin"], "_when", "date", ["asof_rev"], lambda t: F.to_date(t), highest=True)
        return at.select(*keys, F.col("asof_rev").alias(out))

    r = r.withColumn("peg_at", F.try_to_timestamp("peg_date").cast(commits.schema["date"].dataType))
    dated = current(r.where(F.col("peg_revision").isNull() & F.col("peg_at").isNotNull()), "peg_at", "peg_rev")
    r = r.join(dated, keys, "left").withColumn(
        "peg", F.coalesce("peg_revision", "peg_rev", F.when(F.col("legacy_format"), F.col("revision"))))
    floating = current(r.where(F.col("peg").isNull()), "host_date", "asof_rev")
    r = r.join(floating, keys, "left").withColumn("peg", F.coalesce("peg", "asof_rev"))
    r = r.withColumn("target_rev", F.coalesce("revision", "peg")).drop("asof_rev", "peg_rev", "peg_at")
    latest = commits.groupBy(F.col("origin").alias("target_origin")).agg(F.max("rev").alias("latest"))
    r = cut_lineage(r.join(latest, "target_origin", "left"))
    there = r.where((F.col("peg") <= F.col("latest")) & (F.col("target_rev") <= F.col("latest")) & (F.col("target_rev") >= 0))
    nodes = traced(there.select(F.col("target_origin").alias("origin"), F.col("sub_path").alias("path"), "peg",
                                F.col("target_rev").alias("rev")).distinct(), iv, lineage)
    nodes = nodes.withColumnsRenamed({"origin": "target_origin", "path": "sub_path", "rev": "target_rev"})
    return r.join(nodes, ["target_origin", "sub_path", "peg", "target_rev"], "left").drop("latest")


def traced(wanted: DataFrame, iv: Intervals, lineage: DataFrame) -> DataFrame:
    """wanted (origin, path, peg, rev) -> with ``node``, the path at ``rev`` of
    the node that is at ``path`` at ``peg``; without those that have none."""
    came = lineage.select("origin", F.col("path").alias("at"), F.col("rev").alias("life_from"), "src_path", "src_rev")
    asked = ["origin", "path", "peg", "rev"]
    open_ = wanted.select(*asked, F.col("path").alias("at"), F.col("peg").alias("then"))
    found = None
    while True:
        spans = cut_lineage(node_lifetimes(iv, open_.select("origin", F.col("at").alias("path")).distinct()).withColumnRenamed("path", "at"))
        at = asof_lookup(open_, spans, ["origin", "at"], "then", "life_from", ["life_from", "life_to"], _bucket)
        at = cut_lineage(at.where(F.col("life_from").isNotNull() & (F.col("then") < F.col("life_to"))))
        here = at.where((F.col("rev") >= F.col("life_from")) & (F.col("rev") < F.col("life_to"))).select(*asked, F.col("at").alias("node"))
        found = here if found is None else found.unionByName(here)
        open_ = cut_lineage(at.where(F.col("rev") < F.col("life_from")).join(came, ["origin", "at", "life_from"]).select(
            *asked, F.col("src_path").alias("at"), F.col("src_rev").alias("then")))
        if open_.isEmpty():
            return found


def stretches(defs: DataFrame, origins: DataFrame, commits: DataFrame, iv: Intervals, lineage: DataFrame) -> DataFrame:
    """Usable definitions with their export and its target: target_origin,
    sub_path, target_rev, node; null where there is nothing."""
    dates = commits.select("origin", F.col("rev").alias("export_rev"), F.col("date").alias("host_date"))
    used = cut_lineage(with_exports(defs).join(dates, ["origin", "export_rev"]))
    keys = ["url", "rev_k", "peg_k", "date_k", "legacy_format", "host_date"]
    target = resolve(used, origins, commits, iv, lineage).select(*keys, "target_origin", "sub_path", "target_rev", "node")
    out = used.join(target, keys, "left").withColumn("dest", _join_path(F.col("dir"), F.col("path")))
    # nothing is exported any more once a definition is dead
    dead = out.where(F.col("node").isNull()).groupBy("origin", *SAME).agg(F.min("export_rev").alias("dead_from"))
    late = F.col("export_rev") >= F.col("dead_from")
    return cut_lineage(out.join(dead, ["origin", *SAME], "left").withColumn(
        "node", F.when(~F.coalesce(late, F.lit(False)), F.col("node"))).drop("dead_from"))


def graft(used: DataFrame, files: DataFrame, dirs: DataFrame) -> DataFrame:
    """Rows grafted by every definition: (origin, dir, from_rev, to_rev,
    line_no, rank, dest, path, kind, id, perms) with ``path`` the host path
    of the grafted node."""
    perms = F.col("perms") if "perms" in files.columns else F.lit(PERM_FILE)
    nodes = (files.select("origin", "path", F.lit("file").alias("kind"), F.col("blob_id").alias("id"),
                          perms.cast("int").alias("perms"), "from_rev", "to_rev")
             .unionByName(dirs.select("origin", "path", F.lit("dir").alias("kind"), F.lit(None).cast("string").alias("id"),
                                      F.lit(None).cast("int").alias("perms"), "from_rev", "to_rev")))
    live = used.where(F.col("node").isNotNull())
    wanted = live.select("target_origin", "node").distinct()
    above = F.concat(F.array(F.lit("")), ancestors(F.col("path"), include_self=True))
    under = nodes.join(wanted.select(F.col("target_origin").alias("origin")).distinct(), "origin", "left_semi").select(
        F.col("origin").alias("target_origin"), F.col("path").alias("tpath"), "kind", "id", "perms",
        F.col("from_rev").alias("t_from"), F.col("to_rev").alias("t_to"), F.explode(above).alias("node"))
    under = under.join(wanted, ["target_origin", "node"], "left_semi")
    rows = live.join(under, ["target_origin", "node"]).where(
        (F.col("t_from") <= F.col("target_rev")) & (F.col("target_rev") < F.col("t_to")))
    rel = F.when(F.col("node") == "", F.concat(F.lit("/"), F.col("tpath"))).otherwise(
        F.substring(F.col("tpath"), F.length("node") + 1, 1 << 30))
    cols = ["origin", "dir", "from_rev", "to_rev", "line_no", "rank", "dest"]
    rows = rows.select(*cols, F.concat(F.col("dest"), rel).alias("path"), "kind", "id", "perms")
    # the root of a repository has no row of its own
    roots = live.where(F.col("node") == "").select(*cols, F.col("dest").alias("path"), F.lit("dir").alias("kind"),
                                                   F.lit(None).cast("string").alias("id"), F.lit(None).cast("int").alias("perms"))
    return rows.unionByName(roots)


def classify(defs: DataFrame, used: DataFrame, grafted: DataFrame) -> DataFrame:
    """Definitions with their status: unparsable, recursive, dead (nothing to
    export), corrupted (part of it can't be exported: a file without
    content; then nothing is grafted) or valid."""
    key = ["origin", "dir", "from_rev", "line_no"]
    n = grafted.groupBy(*key).agg(F.bool_or((F.col("kind") == "file") & F.col("id").isNull()).alias("broken"))
    target = used.select(*key, "export_rev", "target_origin", "sub_path", "target_rev", "node", "dest")
    j = defs.join(target, key, "left").join(n, key, "left")
    status = (F.when(F.col("error").isNotNull() | F.col("void"), "unparsable")
              .when(F.col("recursive"), "recursive")
              .when(F.col("broken"), "corrupted")
              .when(F.col("broken").isNull(), "dead").otherwise("valid"))
    return j.withColumn("status", status).drop("broken", "node")


def in_effect(status: DataFrame) -> DataFrame:
    """Definitions that leave a trace (a valid one grafts, the others make the
    parents of their target) in the stretches in which they count: those
    without a recursive definition anywhere in the repository."""
    values = ["dest", "rank", "status"]
    key = ["origin", "dir", "since", "line_no"]
    live = status.where(F.col("status").isin("valid", "dead", "corrupted")).withColumn("since", F.col("from_rev"))
    off = union_of(status.where(F.col("status") == "recursive"), ["origin"])
    holes = live.select("origin", "dir", "since", "line_no", F.col("from_rev").alias("f"), F.col("to_rev").alias("t")).join(off, "origin") \
        .where((F.col("from_rev") < F.col("t")) & (F.col("f") < F.col("to_rev"))).select(*key, "from_rev", "to_rev")
    return without(live, holes, key, values)


def _below_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(origin, path, from_rev, to_rev): when a file is above the path of a row."""
    tops = files.select("origin", F.col("path").alias("anc"), F.col("from_rev").alias("f"), F.col("to_rev").alias("t"))
    own = rows.join(files.select("origin").distinct(), "origin", "left_semi")
    probes = own.select("origin", "path", "from_rev", "to_rev", F.explode(ancestors(F.col("path"))).alias("anc"))
    met = probes.join(tops, ["origin", "anc"]).where((F.col("f") < F.col("to_rev")) & (F.col("from_rev") < F.col("t")))
    return met.select("origin", "path", F.col("f").alias("from_rev"), F.col("t").alias("to_rev")).distinct()


VALUES = ["kind", "id", "perms", "source"]


def overlay(files: DataFrame, dirs: DataFrame, grafted: DataFrame, effect: DataFrame) -> DataFrame:
    """Every node at every revision with externals applied: (origin, path,
    kind, id, perms, source, from_rev, to_rev), disjoint per path, ``source``
    versioned, external or parent (of a target).

    Of grafts on one path that of the deepest host directory wins, then the
    later line.  Paths that no external touches pass as they are.
    """
    perms = F.col("perms") if "perms" in files.columns else F.lit(PERM_FILE)
    none, no_perms, no_line = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(None).cast("int")
    span = ["from_rev", "to_rev"]
    versioned = files.select("origin", "path", F.lit("file").alias("kind"), F.col("blob_id").alias("id"), perms.cast("int").alias("perms"), *span) \
        .unionByName(dirs.select("origin", "path", F.lit("dir").alias("kind"), none.alias("id"), no_perms.alias("perms"), *span)) \
        .select("*", F.lit("versioned").alias("source"), none.alias("dir"), no_line.alias("line_no"))
    counts = effect.where(F.col("status") == "valid").select("origin", "dir", F.col("since").alias("s"), "line_no",
                                                              F.col("from_rev").alias("f"), F.col("to_rev").alias("t"))
    grafts = grafted.drop("to_rev").withColumnRenamed("from_rev", "s").join(counts, ["origin", "dir", "s", "line_no"]).select(
        "origin", "path", "kind", "id", "perms", F.col("f").alias("from_rev"), F.col("t").alias("to_rev"), F.lit("external").alias("source"),
        "dir", F.col("line_no").cast("int").alias("line_no"))
    parents = effect.select("origin", F.explode(ancestors(F.col("dest"))).alias("path"), *span)
    parents = union_of(parents, ["origin", "path"]).select(
        "origin", "path", F.lit("dir").alias("kind"), none.alias("id"), no_perms.alias("perms"), *span, F.lit("parent").alias("source"),
        none.alias("dir"), no_line.alias("line_no"))
    added = cut_lineage(grafts.unionByName(parents))
    touched = added.select("origin", "path").distinct()
    prio = F.when(F.col("source") == "external", 0).when(F.col("source") == "versioned", 1).otherwise(2)
    order = F.struct(prio.alias("p"), -F.coalesce(F.length("dir"), F.lit(0)).alias("n"), -F.coalesce("line_no", F.lit(0)).alias("l"), "dir", "kind", "id")
    key = ["origin", "path"]
    # the versioned nodes are many and read often: dealt once
    dealt = cut_lineage(versioned.join(touched.withColumn("met", F.lit(True)), key, "left"))
    won = cut_lineage(winners(dealt.where("met").drop("met").unionByName(added), key, order, VALUES))
    rest = dealt.where(F.col("met").isNull()).select(*key, *VALUES, *span)
    out = won.unionByName(rest)
    # an external file hides what is versioned below it, a versioned one what is grafted below it
    tops = won.where(F.col("kind") == "file").select("origin", "path", *span)
    held = rest.where(F.col("kind") == "file").join(added.select("origin", F.explode(ancestors(F.col("path"))).alias("path")).distinct(), key, "left_semi")
    hidden = cut_lineage(_below_files(out, cut_lineage(tops.unionByName(held.select("origin", "path", *span)))))
    return without(out, hidden, key, VALUES)


def as_intervals(nodes: DataFrame) -> Intervals:
    """Nodes of ``overlay`` as file versions and directory lifetimes."""
    span = ["from_rev", "to_rev"]
    files = nodes.where(F.col("kind") == "file").select("origin", "path", F.col("id").alias("blob_id"), "perms", *span)
    dirs = nodes.where(F.col("kind") == "dir").select("origin", "path", *span)
    return Intervals(with_path_parts(files), with_path_parts(dirs))


class Applied(dict):
    """Everything about the externals of a load, each part worked out when it
    is first asked for: defs (parsed lines), used (usable ones with their
    export and target), grafted, status, effect (when they count) and nodes
    (the trees with externals applied)."""

    def __init__(self, prop_events: DataFrame, origins: DataFrame, commits: DataFrame, iv: Intervals, lineage: DataFrame):
        super().__init__()
        self.steps = {
            "defs": lambda: definitions(cut_lineage(external_intervals(prop_events, iv, lineage)), origins),
            "used": lambda: stretches(self["defs"], origins, commits, iv, lineage),
            "grafted": lambda: graft(self["used"], iv.files, iv.dirs),
            "status": lambda: classify(self["defs"], self["used"], self["grafted"]),
            "effect": lambda: in_effect(self["status"]),
            "nodes": lambda: overlay(iv.files, iv.dirs, self["grafted"], self["effect"]),
        }

    def __missing__(self, part: str) -> DataFrame:
        made = self.steps[part]()
        self[part] = made if part == "used" else cut_lineage(made)  # stretches cuts what it returns
        return self[part]


def applied(prop_events: DataFrame, origins: DataFrame, commits: DataFrame, iv: Intervals, lineage: DataFrame) -> Applied:
    """The externals of a load (see ``Applied``)."""
    return Applied(prop_events, origins, commits, iv, lineage)
