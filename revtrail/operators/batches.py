"""Where a buffer that flushes at a number of rows or bytes would flush.

The rows of a key stand in an order; a buffer takes them one by one and is
flushed as soon as it holds ``most_rows`` rows or ``most_bytes`` bytes.  Where
one flush ends decides where the next one ends, but each row's own answer,
"if a batch began here, where would the next one begin", needs only prefix
sums: it is the row reached by the row limit or by the byte limit, the latter
an as-of lookup of the sums.  The batches that really begin are those reached
from the first row, found by doubling the jumps: with jumps of 1, 2, 4, ...
batches known, every round doubles the reached starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrail.operators.ordinals import asof_lookup, dense_ordinal, prefix_sum
from revtrail.session import cut_lineage

BLOCK = 100_000  # rows of a key per block of the windows


def _block(c):
    return F.floor(c / BLOCK)


def flush_numbers(rows: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, size: Column,
                  most_rows: int, most_bytes: int) -> DataFrame:
    """``rows`` with ``flush``, the 1-based number of the flush that writes
    each within its ``keys``.  ``order`` must be unique within a key and
    ``bucket`` non-decreasing along it; a null size counts as 0."""
    keys = list(keys)
    sized = cut_lineage(dense_ordinal(rows, keys, order, bucket, out="_n").withColumn("_size", F.coalesce(size, F.lit(0)).cast("long")))
    lean = prefix_sum(sized.select(*keys, "_n", "_size"), keys, "_n", _block, F.col("_size"), "_upto")
    lean = cut_lineage(lean.withColumn("_before", F.col("_upto") - F.col("_size")))
    # a batch that begins at _n ends with the first row at which the sum since then is large enough,
    # the row after the last one whose sum is still below
    reach = asof_lookup(lean.withColumn("_limit", F.col("_before") + most_bytes - 1),
                        lean.groupBy(*keys, "_upto").agg(F.max("_n").alias("_last")), keys, "_limit", "_upto", ["_last"],
                        lambda c: F.floor(c / (64 * most_bytes)))
    full = F.greatest(F.coalesce("_last", F.lit(0)), F.col("_n") - 1) + 1
    jump = reach.select(*keys, "_n", (F.least(full, F.col("_n") + most_rows - 1) + 1).alias("_next"))
    count = sized.groupBy(*keys).agg(F.max("_n").alias("_count"))
    jump = cut_lineage(jump.join(count, keys).where(F.col("_next") <= F.col("_count")).drop("_count"))
    starts = cut_lineage(count.select(*keys, F.lit(1).cast("long").alias("_n")))
    while not jump.isEmpty():
        ahead = starts.join(jump, [*keys, "_n"]).select(*keys, F.col("_next").alias("_n"))
        starts = cut_lineage(starts.unionByName(ahead).distinct())
        far = jump.select(*keys, F.col("_n").alias("_next"), F.col("_next").alias("_far"))
        jump = cut_lineage(jump.join(far, [*keys, "_next"]).select(*keys, "_n", F.col("_far").alias("_next")))
    marked = sized.join(starts.withColumn("_start", F.lit(1)), [*keys, "_n"], "left")
    out = prefix_sum(marked, keys, "_n", _block, F.coalesce("_start", F.lit(0)).cast("long"), "flush")
    return out.drop("_n", "_size", "_start")


def flush_sizes(numbered: DataFrame, keys: Sequence[str], size: Column) -> DataFrame:
    """(keys, flush, rows, bytes) of every flush."""
    return numbered.groupBy(*keys, "flush").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.coalesce(size, F.lit(0))).cast("long").alias("bytes"))
