"""WARC archives: writing with revisits, reading by boundary-chain verification.

*Writing.*  Of records with equal payloads the one with the largest page_id
is a response, the others are revisits that refer to it.  A record is a
string, so Spark's text writer lays the files out: its line separator is the
blank line pair that ends a WARC record.  Files are gzipped as a whole;
offsets are those of the archive inside.

*Reading.*  The magic that starts a record may also stand inside a payload.
So a task emits every place with the magic as a candidate, together with the
place where its successor would start by its Content-Length.  The record at
a file's start is real, and so is the successor of a real record.  Pointer
jumping finds them all in about log2(records of a file) rounds: each round
adds the records that the pointers of the known ones reach, then doubles the
length of all pointers.  Candidates that are never reached are payload.

A null html is an empty payload; null or odd urls are written without line
breaks.  Rows that repeat a page_id and payload get the same record type;
the record of a null page_id never stands for others unless it has only
such.  Further columns are ignored.  An empty table gives no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import folder, written

MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
#: Records of a file; a file is one row when it is read.
RECORDS_PER_FILE = 1000
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CANDIDATES = ("file string, at long, next long, record_type string, page_id long, url string, payload_bytes long, "
              "payload_digest string, refers_to long, intact boolean")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: eight groups of 20 bits, four letters each."""
    def letters(i):
        bits = F.conv(F.substring(F.sha1(data), i * 5 + 1, 5), 16, 10).cast("int")
        return F.concat(*(F.substring(F.lit(ALPHABET), F.shiftright(bits, s).bitwiseAND(31) + 1, 1) for s in (15, 10, 5, 0)))
    return F.concat(*(letters(i) for i in range(8)))


def records(pages: DataFrame, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The pages' records as strings, without the blank lines at their end.
    Payloads of fewer than ``least_bytes`` are always responses."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long"))
    first = (rows.select("page_id", "digest").groupBy("digest").agg(F.max("page_id").alias("stands"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("digest", "stands"))
    rows = rows.join(first, "digest", "left")
    revisit = (F.col("bytes") >= least_bytes) & F.col("stands").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("stands"))
    rows = rows.withColumn("revisit", F.coalesce(revisit, F.lit(False)))
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]+", " ")
    block = F.when(F.col("revisit"), F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("html")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda x: F.concat(F.lit("<urn:page:"), F.coalesce(x.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(MAGIC.decode()), line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Target-URI", clean),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
                                          line("WARC-Refers-To", urn(F.col("stands"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE,
                   compression: str = "gzip") -> None:
    (records(pages, least_bytes).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file)
     .option("compression", compression).text(path))


def parse(content: bytes, at: int) -> dict | None:
    """The record that would start at ``at``; None if it has no header."""
    end = content.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    head = {}
    for text in content[at:end].split(b"\r\n")[1:]:
        name, colon, value = text.partition(b":")
        if not colon:
            return None
        head[name.strip().lower()] = value.strip()
    size = head.get(b"content-length", b"")
    if not size.isdigit():
        return None
    stop = end + 4 + int(size)
    follows = content[stop:stop + 4] == b"\r\n\r\n" and (stop + 4 == len(content) or content.startswith(MAGIC, stop + 4))
    row = {"at": at, "next": stop + 4, "record_type": head.get(b"warc-type", b"").decode("utf-8", "replace"),
           "page_id": urn_number(head.get(b"warc-record-id")), "url": head.get(b"warc-target-uri", b"").decode("utf-8", "replace"),
           "refers_to": urn_number(head.get(b"warc-refers-to")), "payload_bytes": None, "payload_digest": None, "intact": follows}
    if row["record_type"] == "revisit":
        row["payload_bytes"] = int(head[b"x-payload-length"]) if head.get(b"x-payload-length", b"").isdigit() else None
        row["payload_digest"] = head.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("utf-8", "replace")
    elif follows:  # else it is no record, and its payload would be hashed for nothing
        body = content.find(b"\r\n\r\n", end + 4, stop)
        body = end + 4 if body < 0 else body + 4
        row["payload_bytes"] = stop - body
        row["payload_digest"] = base64.b32encode(hashlib.sha1(memoryview(content)[body:stop]).digest()).decode()
    return row


def urn_number(value: bytes | None) -> int | None:
    digits = (value or b"").removeprefix(b"<urn:page:").removesuffix(b">").strip()
    return int(digits) if digits.removeprefix(b"-").isdigit() else None


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place with the magic, and what a record there would be."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    fields = pa.schema([("file", pa.string()), ("at", pa.int64()), ("next", pa.int64()), ("record_type", pa.string()),
                        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                content = gzip.decompress(row["content"]) if row["path"].endswith(".gz") else row["content"]
                at, found = content.find(MAGIC), []
                while at >= 0:
                    if (record := parse(content, at)) is not None:
                        found.append({"file": row["path"]} | record)
                    at = content.find(MAGIC, at + 1)
                if found:
                    yield pa.RecordBatch.from_pylist(found, fields)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return written(files.mapInArrow(find, CANDIDATES), "warc-candidates")


def reachable(found: DataFrame) -> DataFrame:
    """(file, at) of the candidates on the chain from each file's start."""
    spark = found.sparkSession
    most = found.groupBy("file").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    few = max(4, (most["all"] or 0) // 500_000)  # files of the small tables between rounds
    places = found.select(F.col("file").alias("of"), F.col("at").alias("place"))
    jump = found.select("file", "at", F.col("next").alias("to")).join(
        places, (F.col("file") == F.col("of")) & (F.col("to") == F.col("place")), "left_semi")
    known = found.filter("at = 0").select("file", "at")
    for _ in range(math.ceil(math.log2(max(2, most["most"] or 0)))):
        jump = written(jump.coalesce(few), "warc-jumps")
        known = written(known.unionByName(known.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))).coalesce(few),
                        "warc-known")
        onward = jump.select(F.col("file").alias("of"), F.col("at").alias("to"), F.col("to").alias("beyond"))
        jump = (jump.withColumnRenamed("file", "of").join(onward, ["of", "to"])
                .select(F.col("of").alias("file"), "at", F.col("beyond").alias("to")))
    return known


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The real records: file, at, record_type, page_id, url, payload_bytes, payload_digest, refers_to, intact."""
    found = candidates(spark, path)
    return found.join(reachable(found), ["file", "at"], "left_semi").drop("next")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    path = folder(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(pages.sparkSession, path)
