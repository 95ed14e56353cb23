"""Revisions that arrive in any order are released in order."""

import json
import random

import pandas as pd

from revtrail.streaming import gaps


class State:
    def __init__(self):
        self.value = None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_any_permutation_is_released_in_order():
    rng = random.Random(1)
    for _ in range(40):
        revs = list(range(1, 30))
        rng.shuffle(revs)
        state, out, arrived = State(), [], set()
        while revs:
            n = rng.randint(1, 6)
            part, revs = revs[:n], revs[n:]
            arrived |= set(part)
            for frame in gaps.release(("o",), iter([pd.DataFrame({"rev": part, "payload": [str(r) for r in part]})]), state):
                out += frame["rev"].tolist()
                assert not frame["late"].any()
            last, waiting = state.value
            # the state is what waits behind the gap, no more
            assert out == list(range(1, last + 1)) and {int(k) for k in json.loads(waiting)} == {r for r in arrived if r > last}
        assert out == list(range(1, 30))


def test_late_and_changed_revisions_are_told():
    state = State()
    rows = pd.DataFrame({"rev": [1, 2, 4, 2, 4], "payload": ["a", "b", "d", "b2", "d2"]})
    found = pd.concat(gaps.release(("o",), iter([rows]), state))
    assert [tuple(r) for r in found[["rev", "payload", "late"]].itertuples(index=False)] == [(1, "a", False), (2, "b", False), (2, "b2", True), (4, "d2", True)]
    assert state.value == (2, '{"4": "d"}')
    assert list(gaps.release(("o",), iter([rows.iloc[2:3]]), state)) == []


def test_stream_releases_and_visits_follow(spark):
    """Through Spark's state store; the visits fed by it have the ids of a full load."""
    from pyspark.sql import functions as F

    from paths import SF_SMALL
    from revtrail.plans import jobs
    from revtrail.sources import adapters
    from revtrail.sources.tables import read_table
    from revtrail.streaming.visits import VisitStream
    ev = adapters.events_base(spark, SF_SMALL)
    events = read_table(spark, SF_SMALL, "events")
    buffer, visits = gaps.GapBuffer(spark), VisitStream(spark, buckets=4)
    part = F.pmod(F.hash("event_id"), F.lit(3))
    for i in range(3):
        buffer.arrive(ev.where(part == i).select("origin", "rev", F.col("event_id").cast("string").alias("payload")), f"p{i}")
        free = buffer.released().where(F.col("batch") == i)
        assert free.where("late").count() == 0
        visits.process_batch(events.join(free.select(F.col("payload").cast("long").alias("event_id")), "event_id", "left_semi"), i)
    got = {(r.origin, r.rev): r.revision_id for r in visits.read_revisions().collect()}
    assert got == {(r.origin, r.rev): r.revision_id for r in jobs.events_load(spark, SF_SMALL).revisions.collect()}
