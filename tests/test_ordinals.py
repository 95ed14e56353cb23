"""Block-split helpers equal their single-window definitions (random data)."""

import random

from pyspark.sql import functions as F

from revtrail.operators.ordinals import asof_lookup, dense_ordinal, next_matching, prefix_sum


def _rows(seed, n=400):
    rnd = random.Random(seed)
    # a hot key holding about a third of the rows
    return [(("hot" if rnd.random() < 0.34 else f"k{rnd.randrange(6)}"), i, rnd.randrange(0, 50),
             rnd.random() < 0.3) for i in range(n)]


def test_prefix_sum_and_next_matching(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "key string, t long, v long, cand boolean")
    bucket = lambda c: F.floor(c / 7)  # noqa: E731 - many small blocks
    got_sum = {r.t: r.s for r in prefix_sum(df, ["key"], "t", bucket, F.col("v"), "s").collect()}
    nm, held = next_matching(df.withColumn("s0", F.lit(0)), ["key"], "t", "s0", bucket,
                             F.col("cand"), ["t"], out="nx")
    got_next = {r.t: (r.nx.t if r.nx is not None else None) for r in nm.collect()}
    held.unpersist()
    by_key = {}
    for k, t, v, c in rows:
        by_key.setdefault(k, []).append((t, v, c))
    for items in by_key.values():
        items.sort()
        acc = 0
        for i, (t, v, _) in enumerate(items):
            acc += v
            assert got_sum[t] == acc
            nxt = next((t2 for t2, _, c2 in items[i + 1:] if c2), None)
            assert got_next[t] == nxt


def test_dense_ordinal_and_asof(spark):
    rows = _rows(2)
    df = spark.createDataFrame(rows, "key string, t long, v long, cand boolean")
    got = {r.t: r.o for r in dense_ordinal(df, ["key"], [F.col("t")], F.floor(F.col("t") / 9), "o").collect()}
    right = df.where("cand").select("key", F.col("t").alias("rt"), F.col("v").alias("val"))
    left = df.select("key", F.col("t").alias("lt"))
    a = {r.lt: r.val for r in asof_lookup(left, right, ["key"], "lt", "rt", ["val"],
                                          lambda c: F.floor(c / 11)).collect()}
    by_key = {}
    for k, t, v, c in rows:
        by_key.setdefault(k, []).append((t, v, c))
    for items in by_key.values():
        items.sort()
        for i, (t, _, _) in enumerate(items):
            assert got[t] == i + 1
            prev = [v2 for t2, v2, c2 in items if c2 and t2 <= t]
            assert a[t] == (prev[-1] if prev else None)
