"""Interval algebra per key, by windows and equi joins.

Rows hold from ``from_rev`` up to (not including) ``to_rev``.  A sweep cuts
the time of each key at every start and end of its rows.  Where a row starts
and ends among the cuts is found with two equi joins, and the row is
exploded over exactly the stretches it covers: the work is as large as what
overlaps, and no range join is planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrail.session import cut_lineage


def winners(rows: DataFrame, keys: Sequence[str], order: Column, values: Sequence[str]) -> DataFrame:
    """(keys, values, from_rev, to_rev): at any time the values of the row that
    holds then and comes first by ``order``, in disjoint stretches as long as
    the values stay the same."""
    keys, values = list(keys), list(values)
    rows = rows.where("from_rev < to_rev").withColumn("_order", order)
    cuts = rows.select(*keys, F.col("from_rev").alias("_at")).unionByName(
        rows.select(*keys, F.col("to_rev").alias("_at"))).distinct()
    along = Window.partitionBy(*keys).orderBy("_at")
    cuts = cuts.withColumn("_n", F.row_number().over(along)).withColumn("_next", F.lead("_at").over(along))
    first = cuts.select(*keys, F.col("_at").alias("from_rev"), F.col("_n").alias("_i"))
    last = cuts.select(*keys, F.col("_at").alias("to_rev"), (F.col("_n") - 1).alias("_j"))
    held = rows.join(first, [*keys, "from_rev"]).join(last, [*keys, "to_rev"]).select(
        *keys, F.explode(F.sequence("_i", "_j")).alias("_n"), "_order", F.struct(*values).alias("_v"))
    best = held.groupBy(*keys, "_n").agg(F.min_by("_v", "_order").alias("_v"))
    best = best.join(cuts, [*keys, "_n"]).select(*keys, "_v", F.col("_at").alias("from_rev"), F.col("_next").alias("to_rev"))
    along = Window.partitionBy(*keys).orderBy("from_rev")
    goes_on = F.lag("to_rev").over(along).eqNullSafe(F.col("from_rev")) & F.lag("_v").over(along).eqNullSafe(F.col("_v"))
    best = best.withColumn("_new", (~goes_on).cast("int")) \
        .withColumn("_run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return best.groupBy(*keys, "_run").agg(F.any_value("_v").alias("_v"), F.min("from_rev").alias("from_rev"),
                                           F.max("to_rev").alias("to_rev")).select(*keys, "_v.*", "from_rev", "to_rev")


def union_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, from_rev, to_rev): the times at which any row holds, as disjoint stretches."""
    keys = list(keys)
    along = Window.partitionBy(*keys).orderBy("from_rev", "to_rev")
    before = F.max("to_rev").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = rows.select(*keys, "from_rev", "to_rev").where("from_rev < to_rev") \
        .withColumn("_new", (F.coalesce(before, F.lit(-1)) < F.col("from_rev")).cast("int"))
    runs = runs.withColumn("_run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "_run").agg(F.min("from_rev").alias("from_rev"), F.max("to_rev").alias("to_rev")).drop("_run")


def without(rows: DataFrame, holes: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The rows less the times of the ``holes`` (keys, from_rev, to_rev).  Rows
    of a key must not overlap one another; keys without holes pass as they are."""
    keys, values = list(keys), list(values)
    cols = [*keys, *values, "from_rev", "to_rev"]
    dealt = cut_lineage(rows.select(*cols).join(holes.select(*keys).distinct().withColumn("_cut", F.lit(True)), keys, "left"))
    own = dealt.where("_cut").select(*cols).withColumn("_hole", F.lit(False))
    gaps = holes.join(own.select(*keys).distinct(), keys, "left_semi").select(*keys, "from_rev", "to_rev").withColumn("_hole", F.lit(True))
    left = winners(own.unionByName(gaps, allowMissingColumns=True), keys, ~F.col("_hole"), [*values, "_hole"])
    return dealt.where(F.col("_cut").isNull()).select(*cols).unionByName(left.where(~F.col("_hole")).select(*cols))
