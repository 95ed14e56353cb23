"""Headline timings: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
The JVM is warmed up first by running every headline query once on the
smallest input (code generation and JIT), then each query is timed end
to end on BENCH_SF_DIR (plan + execution, result written to the ``noop``
sink).  Loads are timed on their own (``full_load`` for the event log,
``orders_load`` for the copy-heavy orders log, ``export_load`` with
properties, ``externals``) and reused by the queries that read them; what a
query computes besides them is dropped before every run.  A figure is the
median of five runs, of three for steps of more than two seconds, and one run
for those of more than ten, and for all that begin after four minutes.  ``baseline`` holds the comparison line of
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Queries, and what they keep for a session besides the loads.
HEADLINE = {
    "build_snapshot": [], "tree_ids": [], "revision_chain": [], "replay_state": [], "crawl_tree": [],
    "rev_at_date": [], "object_stats": [], "content_ids": [], "anti_archive": [], "diff_stat": [],
    "conv_revision_chain": ["conversations_load"], "url_quote": [], "parse_external": [], "static_tree": ["nations_load"],
    "expand_copies": [], "orders_tree_ids": [], "tree_diff": ["tree_diff", "entries"], "visit_outcome": ["dumps", "history_check", "events_visits"],
    "incremental_equals_full": ["incremental"], "dump_frames": ["dumps"], "export_tree": [], "prop_state": ["prop_state"],
    "externals_tree": ["externals_trees"], "batch_limits": [], "append_new_objects": ["archive"], "stream_visits": ["stream_visits"],
}
#: Seconds after which nothing is repeated any more.
ENOUGH = 240
LOADS = {"full_load": "events_load", "orders_load": "orders_load", "export_load": "export_load", "externals": "externals"}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from revtrail.plans import catalog, jobs
    from revtrail.session import get_spark

    spark = get_spark(cpus)

    def drop(folder, names):
        for key in [k for k in jobs._CACHE if k[1] == folder.rstrip("/") and k[2] in names]:
            del jobs._CACHE[key]

    def done(df):
        df.write.format("noop").mode("overwrite").save()

    began = time.time()

    def timed(run, before):
        took = []
        while len(took) < (5 if not took or took[0] < 2 else 3 if took[0] < 10 else 1):
            if took and time.time() - began > ENOUGH:
                break
            before()
            t = time.time()
            run()
            took.append(time.time() - t)
        return round(statistics.median(took), 3)

    def load(folder, name):
        made = getattr(jobs, LOADS[name])(spark, folder)
        done(made["nodes"] if isinstance(made, dict) else made.snapshots)

    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and warm_dir.rstrip("/") != sf_dir.rstrip("/"):
        for name in HEADLINE:
            done(catalog.QUERIES[name](spark, warm_dir))
    times = {name: timed(lambda: load(sf_dir, name), lambda: drop(sf_dir, [LOADS[name]])) for name in LOADS}  # noqa: B023
    for name, kept in HEADLINE.items():
        times[name] = timed(lambda: done(catalog.QUERIES[name](spark, sf_dir)), lambda: drop(sf_dir, kept))  # noqa: B023
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    spark.stop()
    baseline = {}
    if os.environ.get("BENCH_BASELINE", "1") == "1":
        baseline["sequential_event_fold"] = sequential_event_fold(sf_dir)
        baseline["spark_full_load"] = times["full_load"]
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "baseline": baseline}))


def sequential_event_fold(sf_dir: str) -> float:
    """The comparison line: one process replays the event log revision by
    revision, re-hashing the whole tree each time (pure Python)."""
    import pandas as pd
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))
    import naive
    t = time.time()
    naive.replay_events(pd.read_parquet(f"{sf_dir}/events.parquet"))
    return round(time.time() - t, 3)


if __name__ == "__main__":
    main()
