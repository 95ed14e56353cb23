"""Dense per-key ordinals and as-of lookups that do not funnel a hot key
through one window partition.

Both split the key space by a bucket that is monotone in the ordering
(a day, a block of revisions): the heavy, row-level window runs per
(key, bucket); only one summary row per (key, bucket) goes through the
per-key window that stitches the buckets together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  bucket: Column, out: str = "ordinal", split: bool = True) -> DataFrame:
    """1-based ``row_number()`` over ``keys`` ordered by ``order``.

    ``bucket`` must be non-decreasing along ``order`` within a key.  Rows
    with a null key or bucket are counted, then dropped.  Not ``split``: no
    key has more rows than a window holds, so they aren't cut into buckets.
    """
    keys = list(keys)
    if not split:
        numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
        return df.withColumn(out, numbered).where(bucket.isNotNull()).dropna(subset=keys)
    b = df.withColumn("_bkt", bucket)
    local_w = Window.partitionBy(*keys, "_bkt").orderBy(*order)
    local = b.withColumn("_local", F.row_number().over(local_w))
    offsets = (
        b.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(
            Window.partitionBy(*keys).orderBy("_bkt")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_n")
    )
    return (local.join(offsets, [*keys, "_bkt"])
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_bkt", "_local", "_off"))


def asof_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: str,
                right_t: str, values: Sequence[str], bucket_of, inclusive: bool = True,
                highest: bool = False, split: bool = True) -> DataFrame:
    """For every ``left`` row, the ``values`` of the ``right`` row of the same
    ``keys`` with the largest ``right_t`` <= ``left_t`` (``<`` when not
    ``inclusive``).  Right rows must be unique on (keys, right_t).

    With ``highest`` the values of all earlier right rows compete and the
    largest (by the first value) wins; then right rows need not be unique,
    nor the values ascend with time.

    ``bucket_of(col)`` maps an order value to a coarser, monotone bucket.
    Left rows with no earlier right row get NULL values.  Not ``split``: all
    order values fall into one bucket, so no earlier one has anything to add.
    """
    keys = list(keys)
    values = list(values)
    # right rows sort before left rows at equal time when inclusive
    r_side, l_side = (0, 1) if inclusive else (1, 0)
    lft = left.withColumn("_t", F.col(left_t)).withColumn("_side", F.lit(l_side))
    rgt = right.select(*keys, F.col(right_t).alias("_t"), *values) \
        .withColumn("_side", F.lit(r_side))
    packed = F.struct(*[F.col(v) for v in values])
    lcols = lft.columns
    u = lft.select(*lcols, F.lit(None).cast(rgt.select(packed.alias("p")).schema[0].dataType)
                   .alias("_val")).unionByName(
        rgt.select(*keys, "_t", "_side", packed.alias("_val")), allowMissingColumns=True)
    u = u.withColumn("_bkt", bucket_of(F.col("_t")))
    w = (Window.partitionBy(*keys, "_bkt").orderBy("_t", "_side")
         .rowsBetween(Window.unboundedPreceding, 0))
    best = F.max if highest else (lambda c: F.last(c, ignorenulls=True))
    u = u.withColumn("_local", best("_val").over(w))
    if not split:
        return u.where(F.col("_side") == l_side).select(*left.columns, *[F.col("_local")[v].alias(v) for v in values])
    # per-bucket carry: last right value of every earlier bucket
    summary = (rgt.withColumn("_bkt", bucket_of(F.col("_t")))
               .groupBy(*keys, "_bkt").agg((F.max(packed) if highest else F.max_by(packed, F.col("_t"))).alias("_last")))
    lb = lft.select(*keys, bucket_of(F.col("_t")).alias("_bkt")).distinct() \
        .withColumn("_last", F.lit(None).cast(summary.schema["_last"].dataType))
    # a left bucket sorts before the summary of its own bucket, so only
    # strictly earlier buckets feed the carry
    carry_w = (Window.partitionBy(*keys).orderBy("_bkt", "_is_summary")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = (summary.withColumn("_is_summary", F.lit(1))
             .unionByName(lb.withColumn("_is_summary", F.lit(0)))
             .withColumn("_carry", best("_last").over(carry_w))
             .where(F.col("_is_summary") == 0).select(*keys, "_bkt", "_carry"))
    res = (u.where(F.col("_side") == l_side)
           .join(carry, [*keys, "_bkt"], "left")
           .withColumn("_v", F.greatest("_local", "_carry") if highest else F.coalesce("_local", "_carry")))
    out_cols = [c for c in left.columns]
    return res.select(*out_cols, *[F.col("_v")[v].alias(v) for v in values])


def next_matching(df: DataFrame, keys: Sequence[str], t: str, s: str, bucket_of,
                  is_candidate: Column, values: Sequence[str], out: str = "next"
                  ) -> tuple[DataFrame, DataFrame]:
    """For every row, the ``values`` (as struct ``out``) of the first
    candidate row strictly after it in (t, s) order within ``keys``.

    The row-level window runs per (keys, bucket); the first candidate of
    every later bucket comes from a per-bucket summary stitched by a small
    per-key window, so one hot key is spread over its buckets.  Only rows
    with no candidate after them in their own bucket (at most the tail of
    each bucket) are joined with that carry.

    Returns (result, held): ``held`` is persisted and read by ``result``;
    unpersist it once the result is materialised.
    """
    keys = list(keys)
    packed = F.struct(*[F.col(v) for v in values])
    d = df.withColumn("_bkt", bucket_of(F.col(t))).withColumn(
        "_cand", F.when(is_candidate, packed))
    w = (Window.partitionBy(*keys, "_bkt").orderBy(F.col(t).desc(), F.col(s).desc())
         .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_local", F.last("_cand", ignorenulls=True).over(w))
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    summary = (d.where(F.col("_cand").isNotNull()).groupBy(*keys, "_bkt")
               .agg(F.min_by(F.col("_cand"), F.struct(F.col(t), F.col(s))).alias("_first")))
    tails = d.where(F.col("_local").isNull())
    rows_b = tails.select(*keys, "_bkt").distinct().withColumn(
        "_first", F.lit(None).cast(summary.schema["_first"].dataType))
    # descending buckets: a row bucket sorts before the summary of its own
    # bucket, so only strictly later buckets feed the carry
    cw = (Window.partitionBy(*keys).orderBy(F.col("_bkt").desc(), F.col("_is_summary"))
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = (summary.withColumn("_is_summary", F.lit(1))
             .unionByName(rows_b.withColumn("_is_summary", F.lit(0)))
             .withColumn("_carry", F.last("_first", ignorenulls=True).over(cw))
             .where(F.col("_is_summary") == 0).select(*keys, "_bkt", "_carry"))
    head = d.where(F.col("_local").isNotNull()).withColumn(out, F.col("_local"))
    tail = tails.join(carry, [*keys, "_bkt"], "left").withColumn(out, F.col("_carry")).drop("_carry")
    res = head.unionByName(tail).drop("_bkt", "_cand", "_local")
    return res, d


def prefix_sum(df: DataFrame, keys: Sequence[str], order: str, bucket_of, value: Column,
               out: str) -> DataFrame:
    """Inclusive running sum of ``value`` over ``keys`` ordered by ``order``
    (unique within a key), computed per (keys, bucket) plus the totals of
    the earlier buckets, so a hot key is spread over its buckets."""
    keys = list(keys)
    d = df.withColumn("_bkt", bucket_of(F.col(order))).withColumn("_v", value)
    lw = (Window.partitionBy(*keys, "_bkt").orderBy(order)
          .rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("_local", F.sum("_v").over(lw))
    totals = d.groupBy(*keys, "_bkt").agg(F.sum("_v").alias("_tot"))
    ow = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_tot").over(ow), F.lit(0))) \
        .select(*keys, "_bkt", "_off")
    return (d.join(offsets, [*keys, "_bkt"])
            .withColumn(out, F.col("_off") + F.col("_local"))
            .drop("_bkt", "_v", "_local", "_off"))


def prefix_max(df: DataFrame, keys: Sequence[str], order: str, bucket_of, value: Column,
               out: str) -> DataFrame:
    """The largest ``value`` of the rows before (not of the row itself; NULL
    for the first) over ``keys`` ordered by ``order`` (unique within a key),
    split by buckets as ``prefix_sum``."""
    keys = list(keys)
    d = df.withColumn("_bkt", bucket_of(F.col(order))).withColumn("_v", value)
    lw = (Window.partitionBy(*keys, "_bkt").orderBy(order)
          .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_local", F.max("_v").over(lw))
    tops = d.groupBy(*keys, "_bkt").agg(F.max("_v").alias("_top"))
    ow = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = tops.withColumn("_carry", F.max("_top").over(ow)).select(*keys, "_bkt", "_carry")
    return (d.join(carry, [*keys, "_bkt"]).withColumn(out, F.greatest("_carry", "_local"))
            .drop("_bkt", "_v", "_local", "_carry"))
