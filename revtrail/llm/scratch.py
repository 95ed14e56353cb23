"""Shared scratch tables: written Parquet below ``spark.checkpoint.dir``.

A written table cuts the lineage, survives lost executors and lets a later
pass read only the columns it needs.  The folder is the one the cluster
names; only a local session without the setting gets one of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared scratch space."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the shared scratch space and read back."""
    path = folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bound the rows of an Arrow batch; texts are long, so the default of
    10,000 rows would make batches of tens of megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of each row, and that column's name.  Decisions
    about rows go by the number, as rows may share a doc_id or have none.
    Where every row has a doc_id of its own that is the number; else the rows
    are written with one, for a number must stay the same each time they are read."""
    name = "_" + "_".join(docs.columns).replace(".", "_").replace("`", "_")  # a name that no column has
    id_ = F.col("doc_id").cast("long")
    seen = docs.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(id_).alias("ids")).first()
    if seen["rows"] == seen["ids"]:
        return docs.withColumn(name, id_), name
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def as_ids(rows: DataFrame, number: str) -> DataFrame:
    """doc_id (the row's number), text."""
    return rows.select(F.col(number).alias("doc_id"), "text")


def but_first(rows: DataFrame, number: str, groups: DataFrame, *order: Column) -> DataFrame:
    """``of``: numbers of the rows in ``groups`` (row, together) that aren't
    the first of their group by ``order``, then doc_id (null last), then number."""
    doc_id = F.col("doc_id").cast("long")
    placed = rows.select(F.col(number).alias("row"), F.struct(*order, doc_id.isNull(), doc_id, F.col(number)).alias("place"))
    members = written(groups.join(placed, "row"), "members")
    first = members.groupBy("together").agg(F.min_by("row", "place").alias("row"))
    return members.join(first, "row", "left_anti").select(F.col("row").alias("of"))


def without(rows: DataFrame, number: str, dropped: DataFrame) -> DataFrame:
    """The rows, whole but for their number, whose number isn't in ``dropped``
    (one column).  The numbers are written first: their size is then known
    when the join is planned, which is a broadcast below Spark's threshold
    (the texts stay where they are) and a shuffle beyond."""
    gone = written(dropped.toDF(number), "dropped-rows")
    return rows.join(gone, number, "left_anti").drop(number)
