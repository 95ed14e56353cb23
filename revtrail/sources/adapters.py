"""Adapters from the driver's tables to change logs.

A change log is three DataFrames:

* ``origins``  (origin, uuid, url)
* ``commits``  (origin, rev, date, author, message)
* ``changes``  (origin, rev, seq, path, kind, action, copyfrom_path,
  copyfrom_rev, blob_id, length)

``seq`` orders changes inside one revision: delete 0, copy 1, put 2.
File data never travels with the changes, only its blob id and length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrail.functions.hashing import blob_id
from revtrail.operators.ordinals import dense_ordinal
from revtrail.plans.export import content_variants
from revtrail.session import cut_lineage
from revtrail.sources.tables import read_table

SEQ_DELETE, SEQ_COPY, SEQ_PUT = 0, 1, 2
# Eol styles cycled through by the property adapters.
EOL_STYLES = ["native", "LF", "CRLF", "CR", "bogus"]


@dataclass
class ChangeLog:
    origins: DataFrame
    commits: DataFrame
    changes: DataFrame


def uuid_of(origin: Column) -> Column:
    """Deterministic repository uuid for a synthetic origin (md5, 8-4-4-4-12)."""
    m = F.md5(origin)
    return F.concat_ws("-", F.substring(m, 1, 8), F.substring(m, 9, 4), F.substring(m, 13, 4),
                       F.substring(m, 17, 4), F.substring(m, 21, 12))


def change_row(origin, rev, seq, path, kind, action, blob=None, length=None,
               copyfrom_path=None, copyfrom_rev=None) -> list[Column]:
    lit = lambda v, t: v if isinstance(v, Column) else F.lit(v).cast(t)
    return [
        origin.alias("origin"), rev.alias("rev"), lit(seq, "int").alias("seq"),
        path.alias("path"), lit(kind, "string").alias("kind"),
        lit(action, "string").alias("action"),
        lit(copyfrom_path, "string").alias("copyfrom_path"),
        lit(copyfrom_rev if copyfrom_rev is not None else -1, "long").alias("copyfrom_rev"),
        lit(blob, "string").alias("blob_id"), lit(length, "long").alias("length"),
    ]


def events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events numbered into revisions: one origin per user; numbered once,
    read by every load."""
    from revtrail.plans.jobs import memo
    return memo(spark, sf_dir, "events_base", lambda: _numbered_events(spark, sf_dir))


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "props")
    ev = ev.withColumn("origin", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    ev = dense_ordinal(ev, ["origin"], [F.col("ts"), F.col("event_id")],
                       F.to_date("ts"), out="rev")
    k = F.get_json_object("props", "$.k").cast("int")
    # numbered once, read by the commit and the change projections
    return cut_lineage(ev.withColumn("k", k).drop("props"))


def events_changelog(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Adapter E (FIXTURES §3): user events as single-path commits.

    path ``d<k div 10>/f<k>``; ``error`` deletes the file; ``signup`` with
    ``k % 10 = 0`` deletes the directory; every other event writes
    ``<event_type> <event_id>`` into the file.
    """
    return events_to_changelog(events_base(spark, sf_dir))


def _export_data() -> Column:
    number = F.col("event_id").cast("string")
    kind = F.col("event_id") % 3
    return (F.when(kind == 0, F.concat(F.lit("link "), number))
            .when(kind == 1, F.concat(F.col("event_type"), F.lit("\r\n"), number, F.lit("\n")))
            .otherwise(F.concat_ws(" ", F.col("event_type"), number)))


def _contents(ev: DataFrame, data: Column) -> DataFrame:
    return ev.select(blob_id(data).alias("id"), F.octet_length(data).cast("long").alias("length"), F.encode(data, "UTF-8").alias("data")) \
        .dropDuplicates(["id"])


def events_export_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents of ``events_export_log``: id, length, data."""
    return _contents(events_base(spark, sf_dir), _export_data())


def events_export_log(spark: SparkSession, sf_dir: str) -> tuple[ChangeLog, DataFrame, DataFrame]:
    """Adapter E with contents that properties change: of event ids divisible
    by 3 the data is ``link <event_id>``, of the next ones two lines with
    mixed endings.  Properties as in ``events_properties``, and on files with
    k % 3 = 1 a ``view`` sets ``svn:special`` and a ``purchase`` unsets it.
    Returns the log, the property events and the content variants."""
    log, props, variants = events_to_export(events_base(spark, sf_dir))
    return log, props, variants.dropDuplicates(["blob_id"])


def events_to_export(ev: DataFrame) -> tuple[ChangeLog, DataFrame, DataFrame]:
    """``events_export_log`` on numbered events; a content that comes again
    has its variants again."""
    data = _export_data()
    path = F.concat(F.lit("d"), F.floor(F.col("k") / 10).cast("string"), F.lit("/f"), F.col("k").cast("string"))
    special = ev.where((F.col("k") % 3 == 1) & F.col("event_type").isin("view", "purchase")).select(
        "origin", "rev", path.alias("path"), F.lit("svn:special").alias("name"),
        F.when(F.col("event_type") == "view", F.lit("*")).alias("value"))
    variants = ev.select(*content_variants(F.encode(data, "UTF-8")))
    return events_to_changelog(ev, data), _event_properties(ev).unionByName(special), variants


def _event_change(data: Column) -> list[Column]:
    """The change that a numbered event makes, see ``change_row``."""
    dir_path = F.concat(F.lit("d"), F.floor(F.col("k") / 10).cast("string"))
    file_path = F.concat(dir_path, F.lit("/f"), F.col("k").cast("string"))
    is_file_delete = F.col("event_type") == "error"
    is_dir_delete = (F.col("event_type") == "signup") & (F.col("k") % 10 == 0)
    action = F.when(is_file_delete | is_dir_delete, "delete").otherwise("put")
    return change_row(
        F.col("origin"), F.col("rev"),
        F.when(is_file_delete | is_dir_delete, SEQ_DELETE).otherwise(SEQ_PUT),
        F.when(is_dir_delete, dir_path).otherwise(file_path),
        F.when(is_dir_delete, "dir").otherwise("file"),
        action,
        blob=F.when(action == "put", blob_id(data)),
        length=F.when(action == "put", F.octet_length(data).cast("long")),
    )


def events_to_changelog(ev: DataFrame, data: Column | None = None) -> ChangeLog:
    """Adapter E on numbered events (origin, rev, event_id, ts, event_type, k)."""
    if data is None:
        data = F.concat_ws(" ", F.col("event_type"), F.col("event_id").cast("string"))

    commits = ev.select(
        "origin", "rev", F.col("ts").cast("timestamp").alias("date"),
        F.col("event_type").alias("author"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"))
    changes = ev.select(*_event_change(data))
    origins = commits.select("origin").distinct().select(
        "origin", uuid_of(F.col("origin")).alias("uuid"),
        F.concat(F.lit("file:///repos/"), F.col("origin")).alias("url"))
    return ChangeLog(origins, commits, changes)


def events_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents of adapter E: id, length, data; read by every visit."""
    from revtrail.plans.jobs import memo
    return memo(spark, sf_dir, "events_contents", lambda: cut_lineage(
        _contents(events_base(spark, sf_dir), F.concat_ws(" ", F.col("event_type"), F.col("event_id").cast("string")))))


#: Bytes of a dump file of adapter E: longer dumps are cut off there, as on a full disk.
DUMP_QUOTA = 18_000


def events_dump_records(spark: SparkSession, sf_dir: str) -> tuple[ChangeLog, DataFrame]:
    """Adapter E as dump records (origin, rev, no, record): a revision record
    with author and message and a node record per revision.  Of event ids
    divisible by 5 the file holds text that looks like records itself."""
    from revtrail.sources.dumps import node_record, revision_record
    ev = events_base(spark, sf_dir)
    number = F.col("event_id").cast("string")
    data = F.when(F.col("event_id") % 5 == 0, F.concat(
        F.lit("Revision-number: "), number, F.lit("\nContent-length: 9\n\nNode-path: x\n\nNode-path: y\nContent-length: 99999\n\nend"))) \
        .otherwise(F.concat_ws(" ", "event_type", number))
    log = events_to_changelog(ev, data)
    revs = log.commits.select("origin", "rev", F.lit(0).alias("no"),
                              revision_record(F.col("rev"), {"svn:author": F.col("author"), "svn:log": F.col("message")}).alias("record"))
    nodes = ev.select(*_event_change(data), data.alias("text")).select(
        "origin", "rev", F.lit(1).alias("no"),
        node_record(F.col("path"), F.col("kind"), F.when(F.col("action") == "put", "change").otherwise("delete"),
                    F.when(F.col("action") == "put", F.col("text"))).alias("record"))
    return log, revs.unionByName(nodes)


def conversations_changelog(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Adapter C: one origin per conversation, one revision per turn, no
    date (-> epoch), no changed path (every tree is empty)."""
    cv = read_table(spark, sf_dir, "conversations")
    origin = F.concat(F.lit("v"), F.col("conv_id").cast("string"))
    commits = cv.select(origin.alias("origin"), (F.col("turn") + 1).cast("long").alias("rev"),
                        F.lit(None).cast("timestamp").alias("date"),
                        F.col("role").alias("author"), F.col("text").alias("message"))
    origins = commits.select("origin").distinct().select(
        "origin", uuid_of(F.col("origin")).alias("uuid"),
        F.concat(F.lit("file:///repos/"), F.col("origin")).alias("url"))
    empty = commits.limit(0).select(*change_row(
        F.col("origin"), F.col("rev"), SEQ_PUT, F.lit(""), "file", "put"))
    return ChangeLog(origins, commits, empty)


def document_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter D: every document is a file ``<lang>/<doc_id>`` of origin
    ``<source>``; ids are computed where the text is read."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    data = F.encode(F.col("text"), "UTF-8")
    return d.select(
        "doc_id", F.col("source").alias("origin"),
        F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("path"),
        F.sha1(data).alias("sha1"), blob_id(data).alias("sha1_git"),
        F.sha2(data, 256).alias("sha256"), F.octet_length(data).cast("long").alias("length"))


def nations_changelog(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Adapter N: one commit adding ``<region>/<nation>`` files holding the
    nation name."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    data = F.col("n_name")
    changes = j.select(*change_row(
        F.lit("world"), F.lit(1).cast("long"), SEQ_PUT,
        F.concat_ws("/", "r_name", "n_name"), "file", "put",
        blob=blob_id(data), length=F.octet_length(data).cast("long")))
    commits = changes.select("origin", "rev").distinct().select(
        "origin", "rev", F.lit(None).cast("timestamp").alias("date"),
        F.lit("").alias("author"), F.lit("nations").alias("message"))
    origins = commits.select("origin").distinct().select(
        "origin", uuid_of(F.col("origin")).alias("uuid"),
        F.concat(F.lit("file:///repos/"), F.col("origin")).alias("url"))
    return ChangeLog(origins, commits, changes)


def _orders_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders numbered per customer (origin, rev), and their lines with them,
    numbered within the order (line)."""
    from pyspark.sql import Window
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                   "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    o = o.withColumn("origin", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    o = cut_lineage(dense_ordinal(o, ["origin"], [F.col("o_orderdate"), F.col("o_orderkey")],
                                  F.year("o_orderdate"), out="rev"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_extendedprice")
    li = li.withColumn("line", F.row_number().over(w))
    return o, li.join(o, li.l_orderkey == o.o_orderkey)


def _part_dir() -> Column:
    return F.concat(F.lit("p"), (F.col("l_partkey") % 50).cast("string"))


def _order_file() -> Column:
    return F.concat_ws("/", _part_dir(), F.col("l_returnflag"), F.col("line").cast("string"))


def _order_copies(j: DataFrame) -> DataFrame:
    """The copies of adapter O: tags of part directories."""
    return j.where((F.col("line") == 1) & (F.col("o_orderstatus") == "F")
                   & (F.col("rev") > 1)).select(*change_row(
                       F.col("origin"), F.col("rev"), SEQ_COPY,
                       F.concat(F.lit("tags/o"), F.col("o_orderkey").cast("string")), "dir", "copy",
                       copyfrom_path=_part_dir(), copyfrom_rev=F.col("rev") - 1))


def _orders_log(o: DataFrame, j: DataFrame, copies: DataFrame, data: Column) -> ChangeLog:
    puts = j.select(*change_row(
        F.col("origin"), F.col("rev"), SEQ_PUT, _order_file(),
        "file", "put", blob=blob_id(data), length=F.octet_length(data).cast("long")))
    commits = o.select("origin", "rev", F.col("o_orderdate").cast("timestamp").alias("date"),
                       F.concat(F.lit("customer"), F.col("o_custkey").cast("string")).alias("author"),
                       F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("message"))
    origins = commits.select("origin").distinct().select(
        "origin", uuid_of(F.col("origin")).alias("uuid"),
        F.concat(F.lit("file:///repos/"), F.col("origin")).alias("url"))
    # materialised once: read by the copy expansion, both interval builds
    # and the load
    return ChangeLog(origins, commits, cut_lineage(puts.unionByName(copies)))


def _order_data() -> Column:
    return F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
                       F.col("l_suppkey").cast("string"))


def orders_changelog(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Adapter O: one origin per customer, one revision per order (by date,
    key); each line item writes ``p<partkey % 50>/<returnflag>/<line>``;
    an order with status ``F`` also copies the part directory of its
    first line, as of the previous revision, to ``tags/o<orderkey>``.  Made
    once, read by every query on it."""
    from revtrail.plans.jobs import memo

    def build():
        o, j = _orders_lines(spark, sf_dir)
        return _orders_log(o, j, _order_copies(j), _order_data())
    return memo(spark, sf_dir, "orders_changelog", build)


def orders_export_log(spark: SparkSession, sf_dir: str) -> tuple[ChangeLog, DataFrame, DataFrame]:
    """Adapter O with chains of copies and with contents that properties change.

    The revision after a tag copies it to ``branches/o<orderkey>``, the one
    after that copies the branch to ``old/o<orderkey>``.  Of part keys
    divisible by 3 the data is a link, of the next ones two lines with mixed
    endings.  A line sets (supplier % 4 = 0) or unsets (1) its file's
    ``svn:executable``, on links ``svn:special`` (set on odd line numbers), on
    two-line files ``svn:eol-style`` (supplier % 5); a tag unsets
    ``svn:executable`` of its first lines' files as it copies them."""
    o, j = _orders_lines(spark, sf_dir)
    j = cut_lineage(j)
    tags = _order_copies(j)
    key = lambda c: F.col(c).cast("string")
    tagged = j.where((F.col("line") == 1) & (F.col("o_orderstatus") == "F") & (F.col("rev") > 1)) \
        .select("origin", "rev", F.col("o_orderkey").alias("tag_key"))
    numbered = o.select("origin", "rev", "o_orderkey")

    def onward(before: DataFrame, was: str, to: str) -> DataFrame:
        """The next revision copies what ``before`` (origin, rev, key) made."""
        nxt = before.withColumn("rev", F.col("rev") + 1).withColumnRenamed(before.columns[2], "old_key").join(numbered, ["origin", "rev"])
        return nxt.select(*change_row(
            F.col("origin"), F.col("rev"), SEQ_COPY, F.concat(F.lit(f"{to}/o"), key("o_orderkey")), "dir", "copy",
            copyfrom_path=F.concat(F.lit(f"{was}/o"), key("old_key")), copyfrom_rev=F.col("rev") - 1))

    branched = tagged.select("origin", (F.col("rev") + 1).alias("rev")).join(numbered, ["origin", "rev"])
    copies = tags.unionByName(onward(tagged, "tags", "branches")).unionByName(onward(branched, "branches", "old"))
    kind = F.col("l_partkey") % 3
    data = (F.when(kind == 0, F.concat(F.lit("link "), _order_data()))
            .when(kind == 1, F.concat(_order_data(), F.lit("\r\n"), key("l_suppkey"), F.lit("\n"))).otherwise(_order_data()))
    event = lambda rows, path, name, value: rows.select(
        "origin", "rev", path.alias("path"), F.lit(name).alias("name"), value.cast("string").alias("value"))
    sup = F.col("l_suppkey")
    styles = F.element_at(F.array(*[F.lit(s) for s in EOL_STYLES]), (sup % 5 + 1).cast("int"))
    firsts = tagged.select("*", F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))).alias("flag"))
    props = (event(j.where((sup % 4).isin(0, 1)), _order_file(), "svn:executable", F.when(sup % 4 == 0, "*"))
             .unionByName(event(j.where(kind == 0), _order_file(), "svn:special", F.when(F.col("line") % 2 == 1, "*")))
             .unionByName(event(j.where(kind == 1), _order_file(), "svn:eol-style", styles))
             .unionByName(event(firsts, F.concat(F.lit("tags/o"), key("tag_key"), F.lit("/"), "flag", F.lit("/1")), "svn:executable", F.lit(None))))
    variants = j.select(*content_variants(F.encode(data, "UTF-8"))).dropDuplicates(["blob_id"])
    return _orders_log(o, j, copies, data), props, variants


def events_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property events on the files of adapter E: ``click`` sets
    ``svn:eol-style`` (cycling through EOL_STYLES by k), ``purchase`` sets
    ``svn:executable``, ``view`` with k % 3 = 0 unsets it."""
    return _event_properties(events_base(spark, sf_dir))


def _event_properties(ev: DataFrame) -> DataFrame:
    dir_path = F.concat(F.lit("d"), F.floor(F.col("k") / 10).cast("string"))
    file_path = F.concat(dir_path, F.lit("/f"), F.col("k").cast("string"))
    styles = F.array(*[F.lit(s) for s in EOL_STYLES])
    t = F.col("event_type")
    name = (F.when(t == "click", F.lit("svn:eol-style"))
            .when(t == "purchase", F.lit("svn:executable"))
            .when((t == "view") & (F.col("k") % 3 == 0), F.lit("svn:executable")))
    value = (F.when(t == "click", F.element_at(styles, (F.col("k") % 5 + 1).cast("int")))
             .when(t == "purchase", F.lit("*")))
    return ev.select("origin", "rev", file_path.alias("path"), name.alias("name"),
                     value.alias("value")).where(F.col("name").isNotNull())


def events_externals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``svn:externals`` events on adapter E (u is the user, j = k div 10).

    On ``d<j>`` a ``view`` with k % 10 = 7 sets, and one with k % 10 = 8
    unsets, a value of these lines (in brackets: when the event's id says so):
    1. directory d<(j + 1) % 10> of user u + 1, floating, old format;
    2. a comment;
    3. [% 2 = 0] d0 of user u + 2 at revision 3;
    4. [% 3 = 0] the directory of line 1 over the versioned file f<k>;
    5. [% 4 = 1] d5 of user u + 2 onto the target of line 1;
    6. [% 5 = 0] what is d1 of user u + 3 at revision 4, read at revision 2;
    7. [% 7 = 0] d2 of user u + 1 by a relative url;
    8. [% 23 = 0] the repository itself, which is recursive;
    9. [% 13 = 0] an unparsable line, which voids the value.
    On the root a ``purchase`` with k % 10 = 9 sets, and one with k % 10 = 6
    unsets, d4 of user u + 1 below d<j>, [% 2 = 0] all of user u + 2's
    repository as of revision 1 and [% 3 = 0] d4 again on the target of line 1.
    """
    ev = events_base(spark, sf_dir)
    j = F.floor(F.col("k") / 10)
    uid, k = F.col("user_id"), F.col("k")
    repo = lambda n: F.concat(F.lit("file:///repos/u"), (uid + n).cast("string"))
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    if_id = lambda n, r, line: F.when(F.col("event_id") % n == r, line).otherwise("")
    near = text(repo(1), "/d", ((j + 1) % 10).cast("string"))
    on_dir = F.concat_ws(
        "\n", text("ext/lib ", near), F.lit("# more"),
        if_id(2, 0, text("-r3 ", repo(2), "/d0 pinned")), if_id(3, 0, text("f", k.cast("string"), " ", near)),
        if_id(4, 1, text(repo(2), "/d5 ext/lib")), if_id(5, 0, text("-r2 ", repo(3), "/d1@4 peg")),
        if_id(7, 0, text("../../u", (uid + 1).cast("string"), "/d2 rel/two")), if_id(23, 0, text(repo(0), " self")),
        if_id(13, 0, F.lit("-rx file:///repos/u1/d1 broken")))
    on_root = F.concat_ws("\n", text(repo(1), "/d4 d", j.cast("string"), "/own"), if_id(2, 0, text("lib -r1 ", repo(2))),
                          if_id(3, 0, text(repo(1), "/d4 d", j.cast("string"), "/ext/lib")))
    kind, digit = F.col("event_type"), k % 10
    value = F.when((kind == "view") & (digit == 7), on_dir).when((kind == "purchase") & (digit == 9), on_root)
    chosen = ((kind == "view") & digit.isin(7, 8)) | ((kind == "purchase") & digit.isin(9, 6))
    path = F.when(kind == "view", F.concat(F.lit("d"), j.cast("string"))).otherwise("")
    return ev.where(chosen).select("origin", "rev", path.alias("path"), F.lit("svn:externals").alias("name"), value.alias("value"))
