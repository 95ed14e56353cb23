"""Node properties as validity intervals.

A property keeps its last value within one lifetime of its node: a
delete ends the lifetime and a later re-add starts without properties.
Each property event is attached to the lifetime it falls in with an
as-of lookup on (origin, path); values then run until the next event on
the same property or the end of the lifetime.

A lifetime that starts as a copy starts with the properties its source
had at the source revision.  The lineage table (node, source node, source
revision) is joined to the values known so far with an as-of lookup per
(source path, name); what is found starts a value on the copy, which runs
until the copy's own first event on that property.  Copies of copies take
further rounds, each on the values the round before has added alone, so a
round costs what it adds and the last one finds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.hashing import INF_REV
from revtrail.functions.paths import ancestors
from revtrail.operators.intervals import Intervals, lifetimes
from revtrail.operators.ordinals import asof_lookup
from revtrail.plans.export import file_perms
from revtrail.session import cut_lineage, dealt


def _bucket(c):
    return F.floor(c / 4096)


def node_lifetimes(iv: Intervals, paths: DataFrame | None = None) -> DataFrame:
    """(origin, path, life_from, life_to) of files, directories and roots; of
    the ``paths`` (origin, path) alone if they are given, so that no other
    version is sorted."""
    asked = (lambda df: df) if paths is None else (lambda df: df.join(paths, ["origin", "path"], "left_semi"))
    dirs = asked(iv.dirs.select("origin", "path", F.col("from_rev").alias("life_from"), F.col("to_rev").alias("life_to")))
    roots = iv.dirs.select("origin").unionByName(iv.files.select("origin")).distinct().select(
        "origin", F.lit("").alias("path"), F.lit(0).cast("long").alias("life_from"), F.lit(INF_REV).cast("long").alias("life_to"))
    files = asked(iv.files.select("origin", "path", "from_rev", "to_rev", "continues"))
    return lifetimes(files).unionByName(dirs).unionByName(asked(roots))


def prop_state(prop_events: DataFrame, lives: DataFrame, lineage: DataFrame | None = None, split: bool = True) -> DataFrame:
    """prop_events (origin, rev, path, name, value; NULL value = unset; one
    per property and revision), lives as of ``node_lifetimes``, lineage
    (origin, path, rev, src_path, src_rev) -> (origin, path, name, value,
    from_rev, to_rev).  Not ``split``: all revisions are in one block."""
    if lineage is not None:  # read by the events, their firsts and the copies
        lives = cut_lineage(lives)
    ev = asof_lookup(prop_events, lives, ["origin", "path"], "rev", "life_from", ["life_from", "life_to"], _bucket, split=split)
    ev = ev.where(F.col("life_to").isNotNull() & (F.col("rev") < F.col("life_to")))
    if lineage is not None:
        ev = cut_lineage(ev)
    w = Window.partitionBy("origin", "path", "life_from", "name").orderBy("rev")
    out = ev.withColumn("to_rev", F.coalesce(F.lead("rev").over(w), F.col("life_to")))
    state = out.where(F.col("value").isNotNull()).select(
        "origin", "path", "name", "value", F.col("rev").alias("from_rev"), "to_rev")
    if lineage is None:
        return state
    state = cut_lineage(state)
    if lineage.isEmpty():  # nothing is copied, so nothing is inherited
        return state
    first = ev.groupBy("origin", "path", "life_from", "name").agg(F.min("rev").alias("first_rev"))
    born = lineage.withColumnRenamed("rev", "life_from").join(lives, ["origin", "path", "life_from"])
    born, first = cut_lineage(born), cut_lineage(first)
    all_found, fresh = state, state
    while True:
        fresh = cut_lineage(inherited(born, fresh, split).join(first, ["origin", "path", "life_from", "name"], "left").select(
            "origin", "path", "name", "value", F.col("life_from").alias("from_rev"),
            F.least(F.coalesce("first_rev", "life_to"), "life_to").alias("to_rev")).where("from_rev < to_rev"))
        if fresh.isEmpty():
            return all_found
        all_found = all_found.unionByName(fresh)


def inherited(copied: DataFrame, state: DataFrame, split: bool = True) -> DataFrame:
    """Rows of ``copied`` (origin, src_path, src_rev, ...) with name and value
    of each property in force on their source.  Not ``split``: as in ``prop_state``."""
    names = state.select("origin", F.col("path").alias("src_path"), "name").distinct()
    probes = copied.join(names, ["origin", "src_path"])
    values = state.select("origin", F.col("path").alias("src_path"), "name", "from_rev", "value", F.col("to_rev").alias("until"))
    hit = asof_lookup(probes, values, ["origin", "src_path", "name"], "src_rev", "from_rev", ["value", "until"], _bucket, split=split)
    return hit.where(F.col("src_rev") < F.col("until")).drop("until")


def lean_variants(variants: DataFrame) -> DataFrame:
    """``variants`` without the line endings that leave the data as it is:
    they need no id of their own."""
    return variants.select("blob_id", "link_id", *[F.nullif(c, "blob_id").alias(c) for c in ("id_lf", "id_crlf", "id_cr")])


def exported_files(files: DataFrame, state: DataFrame, variants: DataFrame) -> DataFrame:
    """File versions as an export writes them: with the properties in force
    applied to data and mode.

    files (origin, path, blob_id, from_rev, to_rev), state as of
    ``prop_state``, variants (blob_id and the ids that its data has as a
    link, link_id, and with each line ending, id_lf, id_crlf, id_cr) ->
    (origin, path, blob_id, perms, from_rev, to_rev), a row for each stretch
    of one id and mode.  Version and property intervals are merged as one
    event list per path, so a long-lived property meets a path's versions
    without being joined to each of them.
    """
    names = {"special": "svn:special", "executable": "svn:executable", "eol": "svn:eol-style"}
    ids = ["blob_id", "link_id", "id_lf", "id_crlf", "id_cr"]
    versions = files.select("origin", "path", "blob_id", "from_rev", "to_rev").join(lean_variants(variants), "blob_id", "left")
    version = F.struct(F.lit(True).alias("on"), *ids)
    nothing = F.lit(None).cast("struct<on:boolean,value:string>")
    gone = F.struct(F.lit(False).alias("on"), *[F.lit(None).cast("string").alias(c) for c in ids])
    events = (versions.select("origin", "path", F.col("from_rev").alias("rev"), version.alias("v"))
              .unionByName(versions.select("origin", "path", F.col("to_rev").alias("rev"), gone.alias("v")))
              .withColumns({k: nothing for k in names}))
    wanted = state.where(F.col("name").isin(list(names.values())))
    ends = (wanted.select("origin", "path", F.col("from_rev").alias("rev"), "name",
                          F.struct(F.lit(True).alias("on"), F.col("value").alias("value")).alias("p"))
            .unionByName(wanted.select("origin", "path", F.col("to_rev").alias("rev"), "name",
                                       F.struct(F.lit(False).alias("on"), F.lit(None).cast("string").alias("value")).alias("p"))))
    events = events.unionByName(ends.select("origin", "path", "rev", F.lit(None).cast(events.schema["v"].dataType).alias("v"),
                                            *[F.when(F.col("name") == n, F.col("p")).alias(k) for k, n in names.items()]))
    # what starts at a revision counts over what ends there; dealt once, for the sums and the windows
    events = dealt(events, "origin", "path").groupBy("origin", "path", "rev").agg(F.max("v").alias("v"), *[F.max(k).alias(k) for k in names])
    order = Window.partitionBy("origin", "path").orderBy("rev")
    now = order.rowsBetween(Window.unboundedPreceding, 0)
    at = events.select("origin", "path", "rev", *[F.last(c, ignorenulls=True).over(now).alias(c) for c in ("v", *names)])
    on = lambda k: F.coalesce(F.col(k)["on"], F.lit(False))
    link = on("special") & F.col("v")["link_id"].isNotNull()
    eol = F.when(on("eol"), F.col("eol")["value"])
    ending = (F.when(eol.isin("native", "LF"), F.col("v")["id_lf"]).when(eol == "CRLF", F.col("v")["id_crlf"])
              .when(eol == "CR", F.col("v")["id_cr"]))
    written = F.when(link, F.col("v")["link_id"]).otherwise(F.coalesce(ending, F.col("v")["blob_id"]))
    at = at.select("origin", "path", "rev", F.when(on("v"), F.struct(written.alias("blob_id"),
                                                                    file_perms(link, on("executable")).alias("perms"))).alias("s"))
    at = at.withColumn("same", F.col("s").eqNullSafe(F.lag("s").over(order)) & (F.row_number().over(order) > 1))
    at = at.where(~F.col("same")).withColumn("to_rev", F.lead("rev").over(order))
    return at.where(F.col("s").isNotNull()).select(
        "origin", "path", F.col("s.blob_id").alias("blob_id"), F.col("s.perms").alias("perms"), F.col("rev").alias("from_rev"), "to_rev")


def props_at(state: DataFrame, at: DataFrame) -> DataFrame:
    """Property map rows in force at at(origin, at_rev)."""
    return (state.join(at, "origin")
            .where((F.col("from_rev") <= F.col("at_rev")) & (F.col("at_rev") < F.col("to_rev")))
            .select("origin", "path", "name", "value"))


def crawl(iv: Intervals, state: DataFrame, at: DataFrame) -> DataFrame:
    """Every node at at(origin, at_rev), the root included: origin, path, type
    (file or dir) and the map of its properties."""
    cols = ["origin", "path", "from_rev", "to_rev"]
    nodes = iv.files.select(*cols, F.lit("file").alias("type")).unionByName(iv.dirs.select(*cols, F.lit("dir").alias("type")))
    nodes = nodes.join(at, "origin").where((F.col("from_rev") <= F.col("at_rev")) & (F.col("at_rev") < F.col("to_rev"))) \
        .select("origin", "path", "type").unionByName(at.select("origin", F.lit("").alias("path"), F.lit("dir").alias("type")))
    held = props_at(state, at).groupBy("origin", "path").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("props"))
    none = F.create_map().cast("map<string,string>")
    return nodes.join(held, ["origin", "path"], "left").withColumn("props", F.coalesce("props", none))


def propget(state: DataFrame, wanted: DataFrame, recurse: bool = False) -> DataFrame:
    """wanted (origin, rev, target, name) -> those columns with path and value
    of the property at the target, or at and below it; paths without it have no row."""
    above = F.concat(F.array(F.lit("")), ancestors(F.col("path"), include_self=True))
    target = F.explode(above) if recurse else F.col("path")
    rows = state.join(wanted.select("origin", "name").distinct(), ["origin", "name"], "left_semi").select("*", target.alias("target"))
    return rows.join(wanted, ["origin", "name", "target"]).where((F.col("from_rev") <= F.col("rev")) & (F.col("rev") < F.col("to_rev"))) \
        .select("origin", "rev", "target", "name", "path", "value")
