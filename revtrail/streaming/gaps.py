"""Revisions that arrive out of order, released in order.

Revisions of an origin are dense, 1, 2, 3, ...  A stream of them, in any
order, is grouped by origin; the state of an origin is the last revision
released and the ones that wait behind a gap, no more.  A revision that
closes the gap releases itself and all that follow without another gap.  One
at or below the last released is late: it says that the history was altered,
and is passed on as such, for a reload of the origin.  The state lives in
Spark's state store, so a batch that runs again after a failure starts from
the state before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from revtrail.session import ensure_checkpoint_dir, path_exists

REVISIONS = "origin string, rev long, payload string"
RELEASED = "origin string, rev long, payload string, late boolean"
STATE = "last long, waiting string"


def release(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One origin's new revisions against its state."""
    last, waiting = 0, {}
    if state.exists:
        last, held = state.get
        waiting = {int(k): v for k, v in json.loads(held).items()}
    out = []
    for frame in frames:
        for rev, payload in zip(frame["rev"].tolist(), frame["payload"].tolist()):
            if rev <= last:
                out.append((rev, payload, True))
                continue
            if rev in waiting and waiting[rev] != payload:
                out.append((rev, payload, True))  # two versions of one revision
                continue
            waiting[rev] = payload
            while last + 1 in waiting:
                last += 1
                out.append((last, waiting.pop(last), False))
    state.update((last, json.dumps(waiting)))
    if out:
        rev, payload, late = zip(*out)
        yield pd.DataFrame({"origin": [key[0]] * len(out), "rev": rev, "payload": payload, "late": late})


class GapBuffer:
    """Arrivals are Parquet files of ``REVISIONS`` below ``incoming``; what is
    released, with the number of the batch that did it, is below ``released``."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/revtrail-gaps-{uuid.uuid4().hex}"
        self.incoming, self.out, self.checkpoint = f"{self.root}/incoming", f"{self.root}/released", f"{self.root}/checkpoint"

    def _put(self, rows: DataFrame, batch_id: int) -> None:
        rows.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.out)

    def run_once(self) -> None:
        """Everything that has arrived since the last time, one file folder per batch at most."""
        arrived = self.spark.readStream.schema(REVISIONS).option("recursiveFileLookup", "true").parquet(self.incoming)
        freed = arrived.groupBy("origin").applyInPandasWithState(release, RELEASED, STATE, "append", GroupStateTimeout.NoTimeout)
        q = (freed.writeStream.foreachBatch(self._put).option("checkpointLocation", self.checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    def arrive(self, rows: DataFrame, name: str) -> None:
        rows.select("origin", "rev", "payload").write.mode("overwrite").parquet(f"{self.incoming}/{name}")
        self.run_once()

    def released(self) -> DataFrame:
        """origin, rev, payload, late, batch."""
        if not path_exists(self.spark, self.out):
            return self.spark.createDataFrame([], f"{RELEASED}, batch long")
        return self.spark.read.schema(f"{RELEASED}, batch long").parquet(self.out)
