"""Dump files read back: record boundaries, truncation at any byte, gzip, splits; dumper logs."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from revtrail.sources import dumps as D


def dump(rng, revs):
    """(bytes, [(kind, start, header_end, finish, rev)]): contents hold text that looks like records."""
    out, records = b"SVN-fs-dump-format-version: 2\n\nUUID: x\n\n", []

    def add(kind, rev, head, content, tail):
        nonlocal out
        start = len(out)
        out += head + b"\n\n"
        records.append((kind, start, len(out), len(out) + len(content), rev))
        out += content + tail

    def content():
        parts = [b"text\n", b"\n", b"Revision-number: 7\n", b"Content-length: 5\n", b"Node-path: a\n", b"Content-length: 100000\n", "é ".encode(), b"\xff\xfe",
                 b"\n\nNode-path: z\n\n", b"Revision-number: 1\nContent-length: 30\n\n"]
        return b"".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 12])))

    for rev in range(revs):
        props = b"K 7\nsvn:log\nV 3\nabc\n" + content() + b"PROPS-END\n"
        add("revision", rev, b"Revision-number: %d\nProp-content-length: %d\nContent-length: %d" % (rev, len(props), len(props)), props, b"\n")
        for i in range(rng.choice([0, 1, 2, 3])):
            if rng.random() < 0.2:
                add("node", rev, b"Node-path: p%d\nNode-action: delete" % i, b"", b"\n")
            else:
                text = content()
                add("node", rev, b"Node-path: p%d\nNode-kind: file\nNode-action: add\nText-content-length: %d\nContent-length: %d" % (i, len(text), len(text)),
                    text, b"\n\n")
    return out, records


def expected(data, records, size, packed):
    """What a reader of the first ``size`` bytes finds."""
    cut = data[:size]
    size += packed and not cut.endswith(b"\n")
    rows, garbage = [], False
    for kind, start, header_end, finish, rev in records:
        line = cut[start:].split(b"\n")[0]
        first = b"Revision-number: " if kind == "revision" else b"Node-path: "
        if not line:
            break
        if not line.startswith(first) or (kind == "revision" and len(line) == len(first)):
            garbage = True
            break
        rows.append((kind, start, None if header_end > len(cut) else header_end, header_end <= len(cut) and finish <= size))
    return rows, garbage


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(8)
    root, want = tmp_path_factory.mktemp("dumps"), {}
    for i in range(60):
        data, records = dump(rng, rng.choice([1, 3, 12]))
        size = len(data) if i % 4 == 0 else rng.randrange(60, len(data))
        if i % 4 == 1:  # cut close to a record's start
            size = min(len(data), rng.choice(records)[1] + rng.randrange(0, 45))
        packed = i % 3 == 0
        path = root / f"origin=o{i}"
        path.mkdir()
        if packed:
            (path / "d.txt.gz").write_bytes(gzip.compress(data[:size]))
        else:
            (path / "d.txt").write_bytes(data[:size])
        want[f"o{i}"] = expected(data, records, size, packed)
    return str(root), want


def test_records_of_whole_and_truncated_dumps(spark, folder):
    root, want = folder
    origin = F.regexp_extract("file", r"/origin=([^/]+)/", 1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # files are split in odd places
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        records, files = D.read_records(spark, root)
        rows = records.select(origin.alias("origin"), "*").orderBy("start").collect()
        known = {r.origin: r.garbage for r in files.select(origin.alias("origin"), "garbage").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, (own, garbage) in want.items():
        got = [(r.kind, r.start, r.header_end, r.complete) for r in rows if r.origin == name]
        broken = [x for x in own if not x[3]]
        assert [x[:2] + x[3:] for x in got] == [x[:2] + x[3:] for x in own], name
        assert [x for x in got if x[3]] == [x for x in own if x[3]], name
        if not broken:
            assert known[name] == garbage or not own, name


def test_summary(spark):
    rows = [("whole", "revision", 0, 5, 9, 1, True), ("whole", "node", 10, 15, 20, 1, True), ("node", "revision", 0, 5, 9, 1, True),
            ("node", "revision", 10, 15, 20, 2, True), ("node", "node", 21, None, 99, 2, False), ("tail", "revision", 0, 5, 9, 1, True),
            ("tail", "revision", 10, 15, 20, 2, True)]
    records = spark.createDataFrame(rows, "file string, kind string, start long, header_end long, finish long, rev long, complete boolean")
    files = spark.createDataFrame([("whole", 20, False), ("node", 30, False), ("tail", 25, True), ("none", 3, True)], "file string, size long, garbage boolean")
    got = {r.file: (r.n_records, r.truncated, r.max_complete_rev) for r in D.dump_summary(records, files).collect()}
    assert got == {"whole": (2, False, 1), "node": (2, True, 1), "tail": (2, True, 1), "none": (0, True, None)}


def test_round_trip_through_written_files(spark, tmp_path):
    texts = ["plain", "two\nlines\n", "", "Revision-number: 9\n\nü", None]
    rows = [("a", r, F.lit(r)) for r in range(5)]
    base = spark.createDataFrame([("a", r, texts[r]) for _, r, _ in rows] + [("b", 0, "x" * 500)], "origin string, rev long, t string")
    records = base.select("origin", "rev", F.lit(0).alias("no"), D.revision_record(F.col("rev"), {"svn:log": F.lit("é\n")}).alias("record")).unionByName(
        base.select("origin", "rev", F.lit(1).alias("no"), D.node_record(F.lit("p"), F.lit("file"), F.lit("add"), F.col("t")).alias("record")))
    origins = spark.createDataFrame([("a", "ua"), ("b", "ub")], "origin string, uuid string")
    for codec in ("none", "gzip"):
        D.write_dumps(records, origins, f"{tmp_path}/{codec}", compression=codec)
        found, files = D.read_records(spark, f"{tmp_path}/{codec}")
        got = sorted((r.rev, r.kind, r.finish - r.header_end, r.complete) for r in found.where("file like '%origin=a%'").collect())
        props = len("K 7\nsvn:log\nV 3\né\n\nPROPS-END\n".encode())
        assert got == sorted([(r, "revision", props, True) for r in range(5)] + [(r, "node", len((t or "").encode()), True) for r, t in enumerate(texts)])
        assert not any(r.garbage for r in files.collect())
    written = D.write_dumps(records, origins, f"{tmp_path}/short", quota=330)
    lines = D.dumper_log(written, spark.createDataFrame([("a",), ("b",), ("c",)], "origin string"))
    D.write_lines(lines, f"{tmp_path}/logs")
    back = D.read_lines(spark, f"{tmp_path}/logs").select(F.regexp_extract("file", r"/origin=([^/]+)/", 1).alias("origin"), F.col("at").alias("line_no"), "line")
    loaded = spark.createDataFrame([("a", -1), ("b", 3)], "origin string, last_loaded_rev long")
    got = {r.origin: (r.last_dumped, r.error_codes, r.outcome) for r in D.dump_log_status(back, loaded).collect()}
    assert got["b"] == (None, "E000028", "error") and got["c"] == (None, "E170013", "not_found")
    assert got["a"][1:] == ("E000028", "partial") and 0 <= got["a"][0] < 4


def test_partial_loading(spark):
    df = spark.createDataFrame([("svnadmin: E200014: Checksum mismatch",), ("x E160013: File not found",), ("E140001: Unexpected EOF",), ("none",)], "m string")
    assert [r[0] for r in df.select(D.partial_load_possible(F.col("m"))).collect()] == [True, True, False, False]


def test_files_are_written_by_several_tasks(spark, tmp_path):
    lines = spark.range(40).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("origin"), F.lit(0).alias("line_no"), F.lit("x").alias("line"))
    D.write_lines(lines, str(tmp_path / "logs"))
    files = list((tmp_path / "logs").rglob("part-*.txt"))
    assert len(files) == 40 and len({f.name[:10] for f in files}) > 1


def test_lines_without_a_kind_are_not_kept(spark, tmp_path, monkeypatch):
    """Contents are long: reading keeps a row per marked line and split, not one per line."""
    (tmp_path / "a.dump").write_bytes(b"UUID: x\n\nRevision-number: 1\nContent-length: 5000\n\n" + b"text\n" * 1000 + b"\n")
    kept, cut = [], D.cut_lineage
    monkeypatch.setattr(D, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    records, files = D.read_records(spark, str(tmp_path))
    assert [(r.start, r.finish, r.complete) for r in records.collect()] == [(9, 5050, True)]
    assert max(df.count() for df in kept) < 20


def test_lines_are_placed_alike_in_batches_of_any_size():
    import pandas as pd
    rng = random.Random(3)
    rows = [(f"f{f}", 100, split, rng.choice([0, 0, 3, 7]), rng.choice(["blank", "length", None]), rng.choice([None, 5]))
            for f in range(4) for split in (0, 50) for _ in range(rng.choice([1, 2, 9]))]
    lines = pd.DataFrame(rows, columns=["file", "file_size", "split", "bytes", "kind", "number"]).astype({"number": "Int64"})
    want, at = [], {}
    for file, _, split, size, kind, number in rows:
        one = at.setdefault((file, split), [0, None])
        if kind:
            want.append((file, split, kind, one[0], number))
        if size:
            one[1] = one[0]
        one[0] += size + 1
    want += [(*k, "end", *v) for k, v in at.items()]
    for n in (1, 2, 5, 100):
        batches = (lines.iloc[i:i + n].reset_index(drop=True) for i in range(0, len(lines), n))
        got = pd.concat(D._place(batches))
        found = [(r.file, r.split, r.kind, r.start, None if pd.isna(r.number) else int(r.number)) for r in got.itertuples()]
        assert sorted(found, key=str) == sorted(want, key=str)


def test_bundles_hold_what_files_hold(spark, tmp_path):
    """Dumps and logs of many origins in a few files, cut off in a character, with tabs and names to be quoted."""
    texts = ["plain", "two\n\tlines\n", "", "Revision-number: 9\n\nü", None, "a\tb\n\nNode-path: z\n\n"]
    base = spark.createDataFrame([(f"o {i}\t%/{i}" if i == 7 else f"o{i}", r, texts[(i + r) % 6]) for i in range(40) for r in range(5)],
                                 "origin string, rev long, t string")
    records = base.select("origin", "rev", F.lit(0).alias("no"), D.revision_record(F.col("rev"), {"svn:log": F.lit("é" * 20)}).alias("record")).unionByName(
        base.select("origin", "rev", F.lit(1).alias("no"), D.node_record(F.lit("p"), F.lit("file"), F.lit("add"), F.col("t")).alias("record")))
    origins = base.select("origin").distinct().withColumn("uuid", F.lit("u"))
    for codec, quota in (("none", None), ("none", 401), ("gzip", 402)):
        root = f"{tmp_path}/{codec}{quota}"
        written = D.write_dumps(records, origins, f"{root}/files", quota, codec)
        rows = D.dump_rows(records, origins, quota)
        D.write_bundles(rows, ["rev", "no"], "record", f"{root}/bundles", codec)
        assert sorted(written.collect()) == sorted(rows.drop("record").where("rev >= 0").collect())
        assert len(list((tmp_path / f"{codec}{quota}" / "bundles").glob("part-*"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        cols = ["kind", "start", "header_end", "finish", "rev", "complete"]
        origin = F.url_decode(F.url_decode(F.regexp_extract("file", r"/origin=([^/]+)/", 1)))  # the path as a url, the name as a folder
        one, their = D.read_records(spark, f"{root}/files")
        two, own = D.records_in(D.read_bundles(spark, f"{root}/bundles"))
        assert sorted(map(str, two.select("file", *cols).collect())) == sorted(map(str, one.select(origin.alias("file"), *cols).collect()))
        assert sorted(map(str, own.select("file", "size", "garbage").collect())) == sorted(map(str, their.select(origin.alias("file"), "size", "garbage").collect()))


def test_bundled_lines_keep_their_order(spark, tmp_path):
    rows = [(f"o{i}", n, None if n == 3 else f"{n}\tx" * (n % 2)) for i in range(30) for n in range(20)]
    D.write_bundles(spark.createDataFrame(rows, "origin string, line_no int, line string"), ["line_no"], "line", f"{tmp_path}/logs")
    got = D.read_bundles(spark, f"{tmp_path}/logs").orderBy("file", "at").collect()
    want = sorted((o, n, t) for o, n, t in rows if t is not None)
    assert [(r.file, r.line, r.bytes) for r in got] == [(o, t, len(t)) for o, _, t in want]


def test_dump_queries_read_no_more_than_they_need(spark, tmp_path):
    """The state of the dumper's logs needs neither records read back nor logs of loading; no origin has a file of its own."""
    from datetime import datetime, timedelta

    from revtrail.plans import catalog, jobs
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 30, "purchase", '{"k": %d}' % (i % 7)) for i in range(300)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    assert catalog.QUERIES["dump_log_status"](spark, str(tmp_path)).count() == 31
    made = {k[2] for k in jobs._CACHE if k[1] == str(tmp_path)}
    assert "dumper_logs" in made and not made & {"dump_records", "load_logs"}
    folder = jobs._CACHE[(spark.sparkContext.applicationId, str(tmp_path), "dumps")][0].removeprefix("file:")
    import pathlib
    assert 0 < len(list(pathlib.Path(folder).rglob("part-*"))) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert catalog.QUERIES["dump_frames"](spark, str(tmp_path)).count() == 30
