"""Object sinks: size split and the append of objects not yet archived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.session import path_exists

# Fixed value: default maximum content size in bytes.
DEFAULT_MAX_CONTENT_SIZE = 100_000


def size_split(contents: DataFrame, max_size: int = DEFAULT_MAX_CONTENT_SIZE) -> DataFrame:
    """status = 'skipped' above ``max_size`` (the data is dropped, ids kept)."""
    skipped = F.col("length") > F.lit(max_size)
    return contents.withColumn("status", F.when(skipped, "skipped").otherwise("content"))


def new_objects(candidates: DataFrame, archive: DataFrame, key: str = "id") -> DataFrame:
    """Distinct candidate ids that the archive does not hold (anti join).

    Both sides are hashed on the id, which is uniformly distributed, so
    the shuffle has no hot key; AQE turns it into a broadcast when the
    archive side is small at run time.
    """
    return candidates.dropDuplicates([key]).join(archive.select(key), key, "left_anti")


def append_new(df: DataFrame, archive_path: str, key: str,
               max_records_per_file: int = 1_000_000) -> int:
    """Append rows whose ``key`` is not yet in the archive table at
    ``archive_path``; returns the number of rows written."""
    spark = df.sparkSession
    if path_exists(spark, archive_path):
        fresh = new_objects(df, spark.read.parquet(archive_path).select(key), key)
    else:
        fresh = df.dropDuplicates([key])
    fresh = fresh.cache()
    n = fresh.count()
    fresh.write.mode("append").option("maxRecordsPerFile", max_records_per_file).parquet(archive_path)
    fresh.unpersist()
    return n
