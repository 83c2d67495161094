"""Write the physical plans of the headline relational queries to docs/PLANS.md.

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from trellis.plans.registry import TAGS, load_all  # noqa: E402
from trellis.session import build_session  # noqa: E402

QUERIES = ["placed_top10", "inline_filter", "two_hop_chain", "merge_set", "event_backfill", "subscriptions",
           "set_edge_distance", "row_match"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    q, _ = load_all()
    out = ["# Physical plans of headline queries", "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf)}` (local[8], 8 shuffle partitions,",
           "AQE on; the plan shown is the initial adaptive plan, before run-time re-planning).", ""]
    for name in QUERIES:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q[name](spark, sf).explain()
        out += [f"## {name} ({TAGS[name]})", "", "```", buf.getvalue().rstrip(), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
