"""Benchmark: warm seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and fully executed once to warm up (JVM, code
generation, file listing), then timed over ``BENCH_REPEAT`` runs (median);
execution goes to the ``noop`` sink so every row is produced but nothing is
collected to the driver.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trellis.plans.registry import load_all  # noqa: E402
from trellis.session import build_session  # noqa: E402

HEADLINE = [
    "placed_top10",          # M5 A2 R7: one hop + group + top-k
    "two_hop_chain",         # M6: customer → order → part roll-up
    "row_match",             # M13 M14: row-driven match + consecutive MATCH
    "merge_set",             # G3 G5: keyed upsert with duplicate keys collapsed
    "merge_rels",            # G6: relationship upsert
    "set_edge_distance",     # G7 F5: derived edge property
    "trails_1_3",            # M11: variable-length trails
    "bfs_all_from",          # P1
    "shortest_path_weighted",  # P2
    "k_paths",               # P7
    "page_rank_top10",       # P9 P10
    "subscriptions",         # J1-J5
    "activity_1_7_28",       # A11
    "write_back",            # S10
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [a for a in sys.argv[1:]] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    q, _ = load_all()
    times = {}
    for name in names:
        q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_warm_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))


if __name__ == "__main__":
    main()
