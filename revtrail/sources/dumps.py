"""Dump files and dumper logs, written and read as text files by Spark.

A dump is a run of records, revisions and the nodes that each changes.  A
record has header lines, a blank line and as many bytes of content as its
header says.  The content may hold anything, also lines that look like
headers, so a record can't be found by its first line alone.

Reading keeps no content: every line becomes its file, place and size.  The
byte offset of a line is a prefix sum over the lines before it, taken per
split of the file and carried over the splits.  Each line that looks like
the first of a record is a candidate, with the end that its own header
declares.  A candidate that no earlier one reaches is a record for sure.
The others, content that looks like records, sit in stretches that start at
a sure one; each stretch is walked from record to record on its own, as a
sorted stream with one number of state.  A file without such content needs
no walk.

Plain files are split over tasks.  Compressed ones are read by one task each,
their size is that of their lines (so a missing last newline goes unnoticed).

Files of very many origins take their time by number, not by bytes: some 30 ms
of a core each to write, to list and to open.  Bundles hold them in one text
file per task, plain or gzip; every line starts with the name of the file it
belongs to and a tab, so contents may still hold anything, and they are read
by the same steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revtrail.functions.hashing import INF_REV
from revtrail.functions.urls import PARTIAL_LOAD_CODES
from revtrail.operators.ordinals import asof_lookup, next_matching, prefix_max, prefix_sum
from revtrail.session import cut_lineage, dealt

# First lines of records, header of the content's size, dumper log markers and error codes.
REVISION_LINE = "Revision-number: "
NODE_LINE = "Node-path: "
LENGTH_LINE = "Content-length: "
DUMPED_PREFIX = "* Dumped revision"
NOT_FOUND_CODE = "E170013"
NO_SPACE_CODE = "E000028"
CHECKSUM_CODE = "E200014"
END_OF_STREAM_CODE = "E140001"
ERROR_CODE_RE = r"(E\d{6})"

OFFSET_BUCKET = 64 << 20  # bytes of a file per block of the windows


def _block(offset):
    return F.floor(offset / OFFSET_BUCKET)


# ------------------------------------------------------------------- writing

def _counted(name: str, text: Column) -> Column:
    """One property in a dump: key and value with their sizes."""
    return F.concat(F.lit(f"K {len(name)}\n{name}\nV "), F.octet_length(text).cast("string"), F.lit("\n"), text, F.lit("\n"))


def revision_record(rev: Column, props: dict[str, Column]) -> Column:
    body = F.concat(*[_counted(k, v) for k, v in props.items()], F.lit("PROPS-END\n"))
    size = F.octet_length(body).cast("string")
    return F.concat(F.lit(REVISION_LINE), rev.cast("string"), F.lit("\nProp-content-length: "), size, F.lit(f"\n{LENGTH_LINE}"), size, F.lit("\n\n"), body)


def node_record(path: Column, kind: Column, action: Column, text: Column) -> Column:
    """``text`` null: a record without content."""
    size = F.octet_length(text).cast("string")
    head = F.concat(F.lit(NODE_LINE), path, F.lit("\nNode-kind: "), kind, F.lit("\nNode-action: "), action)
    held = F.concat(F.lit("\nText-content-length: "), size, F.lit(f"\n{LENGTH_LINE}"), size, F.lit("\n\n"), text, F.lit("\n"))
    return F.concat(head, F.when(text.isNotNull(), held).otherwise(F.lit("\n\n")))


def cut_at(records: DataFrame, quota: int | None) -> DataFrame:
    """records (origin, rev, no, record) as an origin's file of at most
    ``quota`` bytes holds them: one is cut off at its last character that
    isn't a line feed, later ones have none; ``whole`` tells which are complete."""
    if quota is None:
        return records.withColumn("whole", F.lit(True))
    size = F.octet_length("record").cast("long") + 1
    placed = prefix_sum(records.withColumn("_at", F.struct("rev", "no")), ["origin"], "_at",
                        lambda c: F.floor(c["rev"] / 4096), size, "upto")
    room = F.lit(quota) - (F.col("upto") - size)
    held = F.substring(F.col("record").cast("binary"), F.lit(1), F.greatest(room - 1, F.lit(0)).cast("int")).cast("string")
    held = F.nullif(F.regexp_replace(held, r"\n+$", ""), F.lit(""))
    return placed.withColumn("whole", room >= size) \
        .withColumn("record", F.when(F.col("whole"), F.col("record")).otherwise(held)).drop("_at", "upto")


def write_dumps(records: DataFrame, origins: DataFrame, path: str, quota: int | None = None, compression: str = "none") -> DataFrame:
    """One dump file per origin below ``path``; records (origin, rev, no,
    record, each ending with one newline less than in the file).  Returns the
    rows as written, without the texts."""
    rows = dump_rows(records, origins, quota)
    _one_file_each(rows.where(F.col("record").isNotNull()), ["rev", "no"], "record", path, compression)
    return rows.drop("record").where("rev >= 0")


def dump_rows(records: DataFrame, origins: DataFrame, quota: int | None = None) -> DataFrame:
    """The rows of each origin's dump as a file of at most ``quota`` bytes holds
    them (see ``cut_at``), its first lines (rev -1) included."""
    first = origins.select("origin", F.lit(-1).cast("long").alias("rev"), F.lit(0).alias("no"),
                           F.concat(F.lit("SVN-fs-dump-format-version: 2\n\nUUID: "), "uuid", F.lit("\n")).alias("record"))
    return cut_lineage(cut_at(first.unionByName(records.select("origin", "rev", F.col("no").cast("int").alias("no"), "record")), quota))


def dumper_log(written: DataFrame, wanted: DataFrame) -> DataFrame:
    """(origin, line_no, line) of the dumper's output: a line per revision that
    was written whole, and why it stopped.  ``wanted`` origins without a
    dump weren't found."""
    revs = written.groupBy("origin", "rev").agg(F.bool_and("whole").alias("whole"))
    lines = revs.where("whole").select("origin", F.col("rev").alias("line_no"),
                                       F.concat(F.lit(f"{DUMPED_PREFIX} "), F.col("rev").cast("string"), F.lit(".")).alias("line"))
    cut = revs.where("not whole").groupBy("origin").agg(F.min("rev").alias("line_no")).select(
        "origin", "line_no", F.lit(f"svnrdump: {NO_SPACE_CODE}: Can't write to stream: No space left on device").alias("line"))
    missing = wanted.join(written.select("origin").distinct(), "origin", "left_anti").select(
        "origin", F.lit(0).cast("long").alias("line_no"),
        F.concat(F.lit(f"svnrdump: {NOT_FOUND_CODE}: Unable to connect to a repository at URL 'file:///repos/"), "origin", F.lit("'")).alias("line"))
    return lines.unionByName(cut).unionByName(missing)


def write_lines(lines: DataFrame, path: str) -> None:
    """Log lines (origin, line_no, line) as one text file per origin."""
    _one_file_each(lines, ["line_no"], "line", path)


def _one_file_each(rows: DataFrame, order: list[str], text: str, path: str, compression: str = "none") -> None:
    """One text file per origin.  Files are many and small, so it is their
    number that takes time, not their bytes: the tasks aren't merged by size,
    and each moves its own files into place (committer version 2) in place of
    the driver moving all of them at the end."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartition(n, "origin").sortWithinPartitions("origin", *order).select("origin", text)
     .write.mode("overwrite").option("compression", compression).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy("origin").text(path))


def write_bundles(rows: DataFrame, order: list[str], text: str, path: str, compression: str = "none") -> None:
    """The texts of each origin in ``order``, as ``_one_file_each`` writes them,
    in bundles: a file per task, in which an origin's lines follow each other,
    each with the origin in front.  Rows without a text have no line."""
    name = F.concat(F.url_encode("origin"), F.lit("\t"))
    lines = F.concat(name, F.replace(F.col(text), F.lit("\n"), F.concat(F.lit("\n"), name)))
    (dealt(rows.where(F.col(text).isNotNull()), "origin").sortWithinPartitions("origin", *order).select(lines.alias("value"))
     .write.mode("overwrite").option("compression", compression).text(path))


# ------------------------------------------------------------------- reading

def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """``read_lines`` of the files in the bundles below ``path``; ``file`` is
    the origin.  Their own size isn't known but by their lines."""
    df = spark.read.option("lineSep", "\n").text(path, recursiveFileLookup=True)
    # as bytes, for a line may be cut off within a character
    line = F.substring(F.col("value").cast("binary"), F.instr("value", "\t") + 1, F.lit(1 << 30)).cast("string")
    return df.select(F.url_decode(F.substring_index("value", "\t", 1)).alias("file"), F.lit(INF_REV).cast("long").alias("file_size"), _place_in_file(),
                     F.octet_length(line).cast("long").alias("bytes"), line.alias("line"))


def _place_in_file() -> Column:
    return F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n")).alias("at")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, bytes, line) of every line of the text files below ``path``
    (plain or gzip); ``at`` sorts the lines of a file: split, place in it."""
    df = spark.read.text(path, recursiveFileLookup=True)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"),
                     _place_in_file(), F.octet_length("value").cast("long").alias("bytes"), F.col("value").alias("line"))


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, files) of the dumps below ``path``.  records: file, kind
    (revision or node), start, header_end, finish (byte offsets; finish is
    where the content should end), rev, complete.  files: file, size, garbage
    (something follows the last record that is none)."""
    return records_in(read_lines(spark, path))


def records_in(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``read_records`` of lines as of ``read_lines`` or ``read_bundles``."""
    line = F.col("line")
    number = F.regexp_extract(line, r": (\d+)\s*$", 1).try_cast("long")
    kind = (F.when(line.rlike(f"^{REVISION_LINE}\\d"), "revision").when(line.startswith(NODE_LINE), "node")
            .when(line.startswith(LENGTH_LINE), "length").when(line == "", "blank"))
    lines = lines.select(
        "file", "file_size", F.col("at")["split"].alias("split"), "bytes", kind.alias("kind"), F.when(kind.isin("revision", "length"), number).alias("number"))
    # a task reads the lines of a split in their order, so nothing needs to be sorted
    seen = cut_lineage(lines.mapInPandas(_place, PLACED_SCHEMA))
    ends = seen.where(F.col("kind") == "end")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut_lineage(ends.withColumn("base", F.coalesce(F.sum("start").over(before), F.lit(0).cast("long"))))
    plain = ~F.col("file").endswith(".gz")
    files = cut_lineage(ends.groupBy("file").agg(
        F.sum("start").alias("size"), F.max("file_size").alias("file_size"), F.max(F.col("base") + F.col("number")).alias("last_text"))
        .withColumn("size", F.when(plain, F.least("size", "file_size")).otherwise(F.col("size"))))
    marks = cut_lineage(seen.where(F.col("kind") != "end").join(ends.select("file", "split", "base"), ["file", "split"]).select(
        "file", (F.col("base") + F.col("start")).alias("start"), "kind", "number", F.lit(0).alias("s")))
    for what, value in (("blank", "start"), ("length", "number")):
        marks, held = next_matching(marks, ["file"], "start", "s", _block, F.col("kind") == what,
                                    ["start"] if value == "start" else ["start", value], out=what)
        marks = cut_lineage(marks)
        held.unpersist()
    found = marks.where(F.col("kind").isin("revision", "node")).select(
        "file", "kind", "start", F.when(F.col("kind") == "revision", F.col("number")).alias("rev"), (F.col("blank.start") + 1).alias("header_end"),
        F.when(F.col("length.start") < F.col("blank.start"), F.col("length.number")).otherwise(0).alias("bytes"))
    found = found.withColumn("finish", F.coalesce(F.col("header_end") + F.coalesce("bytes", F.lit(0)), F.lit(INF_REV).cast("long")))
    records = cut_lineage(reached(found.drop("bytes")))
    # a node belongs to the revision record before it
    revs = records.where(F.col("kind") == "revision").select("file", F.col("start").alias("of"), F.col("rev").alias("of_rev"))
    records = asof_lookup(records, revs, ["file"], "start", "of", ["of_rev"], _block)
    records = records.join(files.select("file", "size"), "file").select(
        "file", "kind", "start", "header_end", "finish", F.col("of_rev").alias("rev"), (F.col("finish") <= F.col("size")).alias("complete"))
    records = cut_lineage(records)
    ends = records.groupBy("file").agg(F.max("finish").alias("finish"))
    files = files.join(ends, "file", "left").select("file", "size", F.coalesce(F.col("last_text") >= F.col("finish"), F.lit(True)).alias("garbage"))
    return records, files


PLACED_SCHEMA = "file string, file_size long, split long, kind string, start long, number long"


def _place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the lines of each split, in their order, those with a kind, each with
    its offset in the split; then an ``end`` with the split's bytes (start),
    and where its last line with text starts (number)."""
    at, done, last = None, 0, None
    columns = ["file", "file_size", "split", "kind", "start", "number"]

    def ends(rows):
        return pd.DataFrame(rows, columns=columns).astype({"number": "Int64"})

    for batch in batches:
        if batch.empty:
            continue
        key = batch[["file", "file_size", "split"]]
        first = (batch["file"].ne(batch["file"].shift()) | batch["split"].ne(batch["split"].shift())).to_numpy().copy()
        first[0] = True
        heads = first.nonzero()[0]
        group = first.cumsum() - 1
        upto = (batch["bytes"] + 1).to_numpy().cumsum()
        start = upto - batch["bytes"].to_numpy() - 1
        keys = list(key.iloc[heads].itertuples(index=False, name=None))
        goes_on = at == keys[0]
        base = start[heads]
        if goes_on:
            base[0] -= done
        start = start - base[group]
        total = upto[[*(heads[1:] - 1), len(batch) - 1]] - base
        texts = (batch["bytes"].to_numpy() > 0).nonzero()[0]
        lasts = dict(zip(group[texts].tolist(), start[texts].tolist()))  # the last one of each counts
        if goes_on and 0 not in lasts:
            lasts[0] = last
        over = [] if at is None or goes_on else [(*at, "end", done, last)]
        over += [(*k, "end", int(total[i]), lasts.get(i)) for i, k in enumerate(keys[:-1])]
        at, done, last = keys[-1], int(total[-1]), lasts.get(len(keys) - 1)
        marked = batch.assign(start=start)[columns][batch["kind"].notna().to_numpy()].astype({"number": "Int64"})
        yield marked
        if over:
            yield ends(over)
    if at is not None:
        yield ends([(*at, "end", done, last)])


def reached(found: DataFrame) -> DataFrame:
    """The candidates (file, start, finish, ...) that are records: those met on
    the way from record to record."""
    far = prefix_max(found, ["file"], "start", _block, F.col("finish"), "before")
    far = far.withColumn("sure", F.coalesce(F.col("start") >= F.col("before"), F.lit(True))).drop("before")
    far = cut_lineage(prefix_sum(far, ["file"], "start", _block, F.col("sure").cast("long"), "stretch"))
    doubtful = far.where(~F.col("sure")).select("file", "stretch").distinct()
    rows = far.join(doubtful, ["file", "stretch"], "left_semi")
    walked = rows.repartition("file", "stretch").sortWithinPartitions("file", "stretch", "start").mapInPandas(_walk, rows.schema)
    return far.join(doubtful, ["file", "stretch"], "left_anti").unionByName(walked).drop("sure", "stretch")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the sorted candidates of each stretch those that start where the
    last record has ended."""
    at, done = None, 0
    for batch in batches:
        keep = []
        for key, start, finish in zip(zip(batch["file"], batch["stretch"]), batch["start"].tolist(), batch["finish"].tolist()):
            if key != at:
                at, done = key, 0
            keep.append(start >= done)
            if keep[-1]:
                done = finish
        yield batch[keep]


def dump_summary(records: DataFrame, files: DataFrame) -> DataFrame:
    """Per dump file: complete records, whether it is truncated, and the last
    revision of which all records are complete (loading stops there)."""
    by_rev = records.groupBy("file", "rev").agg(F.bool_and("complete").alias("complete"), F.sum(F.col("complete").cast("long")).alias("n"))
    last = Window.partitionBy("file").orderBy(F.col("rev").desc_nulls_last())
    by_rev = by_rev.join(files, "file").withColumn(
        "complete", F.col("complete") & ~(F.col("garbage") & (F.row_number().over(last) == 1)))
    got = by_rev.groupBy("file").agg(F.sum("n").alias("n_records"), (~F.bool_and("complete")).alias("truncated"),
                                     F.max(F.when(F.col("complete"), F.col("rev"))).alias("max_complete_rev"))
    return files.select("file").join(got, "file", "left").select(
        "file", F.coalesce("n_records", F.lit(0).cast("long")).alias("n_records"), F.coalesce("truncated", F.lit(True)).alias("truncated"),
        "max_complete_rev")


def load_log(records: DataFrame) -> DataFrame:
    """(file, line) that loading a truncated dump reports: a node's content cut
    short fails its checksum, anything else ends the stream."""
    broken = records.where("not complete")
    text = F.when((F.col("kind") == "node") & F.col("header_end").isNotNull(), F.lit(f"svnadmin: {CHECKSUM_CODE}: Checksum mismatch")) \
        .otherwise(F.lit(f"svnadmin: {END_OF_STREAM_CODE}: Unexpected EOF on stream"))
    return broken.select("file", text.alias("line"))


def dump_log_status(lines: DataFrame, last_loaded: DataFrame, key: str = "origin") -> DataFrame:
    """lines (key, line_no, line) of dumper logs, last_loaded (key,
    last_loaded_rev) -> last dumped revision, error codes and lines, and the
    outcome of the dump step."""
    dumped = F.when(F.col("line").startswith(DUMPED_PREFIX),
                    F.regexp_extract("line", r"revision ([0-9]+)", 1).cast("long"))
    code = F.nullif(F.regexp_extract("line", ERROR_CODE_RE, 1), F.lit(""))
    error = F.when(code.isNotNull(), F.struct("line_no", "line"))
    per = lines.groupBy(key).agg(
        F.max_by(dumped, F.when(dumped.isNotNull(), F.col("line_no"))).alias("last_dumped"),
        F.array_join(F.array_sort(F.collect_set(code)), ",").alias("error_codes"),
        F.array_join(F.transform(F.array_sort(F.collect_list(error)), lambda e: e["line"]), "\n").alias("errors"))
    j = per.join(last_loaded, key, "left")
    ll = F.coalesce("last_loaded_rev", F.lit(-1))
    last = F.coalesce("last_dumped", F.lit(-1))
    outcome = (F.when(F.col("error_codes") == "", "complete")
               .when(last > ll, "partial")
               .when((last != -1) & (last < ll), "behind_archive")
               .when(F.contains(F.col("error_codes"), F.lit(NOT_FOUND_CODE)), "not_found")
               .otherwise("error"))
    return j.select(key, F.col("last_dumped"), "error_codes", "errors", outcome.alias("outcome"))


def partial_load_possible(message: Column) -> Column:
    """Can what came before this error be loaded all the same?"""
    return F.array_contains(F.array(*[F.lit(c) for c in PARTIAL_LOAD_CODES]), F.regexp_extract(message, ERROR_CODE_RE, 1))
