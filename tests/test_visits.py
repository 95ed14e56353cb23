"""State of streamed visits: files by bucket, and the ids of a full load."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from revtrail.operators.ordinals import asof_lookup, dense_ordinal
from revtrail.plans.load import load
from revtrail.sources.adapters import events_to_export
from revtrail.sources.tables import TABLE_SCHEMAS
from revtrail.streaming.visits import VisitStream, _events

KINDS = ["view", "click", "purchase", "signup", "error"]


def _rows(ids):
    start = dt.datetime(2024, 1, 1)
    return [(i, start + dt.timedelta(hours=i), i % 7, KINDS[i * i % 5], 1.0, f'{{"k": {i * 3 % 23}}}') for i in ids]


def _full_load(spark, rows):
    ev = dense_ordinal(_events(spark.createDataFrame(rows, TABLE_SCHEMAS["events"])), ["origin"], ["ts", "event_id"], F.to_date("ts"), out="rev")
    log, props, variants = events_to_export(ev)
    revisions = load(log, props=props, variants=variants.dropDuplicates(["blob_id"])).revisions
    return {(r.origin, r.rev): r.revision_id for r in revisions.collect()}


def test_a_bucket_is_one_file_a_batch(spark, tmp_path):
    """Not one by every task that has rows of it; with an empty batch, late
    events and a batch that runs again on the way."""
    visits = VisitStream(spark, f"{tmp_path}/stream", buckets=2, export=True)
    some = set(range(0, 120)) - {40, 41}
    for i, ids in ((0, some), (1, []), (2, {40, 41, *range(120, 160)}), (2, {40, 41, *range(120, 160)})):
        visits.process_batch(spark.createDataFrame(_rows(ids), TABLE_SCHEMAS["events"]).repartition(3), i)
    for name in ("events", "heads", "tree", "props", "variants"):
        folders = glob.glob(f"{tmp_path}/stream/state/{name}/bkt=*/batch=*")
        assert folders and [len(glob.glob(f"{x}/*.parquet")) for x in folders] == [1] * len(folders), name
    got = [(r.origin, r.rev, r.revision_id) for r in visits.read_revisions().collect()]
    whole = _full_load(spark, _rows(range(160)))
    assert len(got) == len(whole) and {(o, v): r for o, v, r in got} == whole


def test_ordinals_and_lookups_in_one_bucket(spark):
    """Without buckets as with them, null keys and times too."""
    day = dt.datetime(2024, 1, 1)
    rows = [(k, None if i % 9 == 0 else day + dt.timedelta(hours=5 * i), i) for k in ("a", "b", None) for i in range(20)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, i long")
    a, b = (sorted(map(tuple, dense_ordinal(df, ["key"], ["ts", "i"], F.to_date("ts"), split=s).select("key", "i", "ordinal").collect())) for s in (True, False))
    assert a == b and len(a) == 34
    left = df.select("key", F.when(F.col("i") % 6 != 0, F.col("i")).alias("t"))
    right = df.where("i % 4 = 1").select("key", F.col("i").alias("r"), (F.col("i") * 10).alias("v"))
    a, b = (sorted(map(str, asof_lookup(left, right, ["key"], "t", "r", ["v"], lambda c: F.floor(c / 4096), split=s).collect())) for s in (True, False))
    assert a == b and len(a) == 60
