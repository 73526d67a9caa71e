"""Summarise the physical plan of every registered query.

    python tools/plan_audit.py [--sf /root/testdata/sf0.01] [name ...]

Per query: shuffles (Exchange), broadcast and sort-merge joins, windows with a
partial top-k (WindowGroupLimit), single-partition exchanges, nested-loop or
cartesian joins and Python nodes, from the plan before adaptive re-planning
(at run time AQE may still turn sort-merge into broadcast joins and reuse identical
shuffles, so repeated sub-plans are counted once per occurrence here).  Uses only
``DataFrame.explain('formatted')`` (no plan execution).
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Patterns over the operator tree (first block of the formatted plan) unless
# marked "details" (the per-node argument listing that follows it).
COUNTS = {
    "shuffles": (r"(?<!Broadcast)Exchange \(", "tree"),
    "single_partition": (r"Arguments: SinglePartition", "details"),
    "broadcast_joins": (r"BroadcastHashJoin", "tree"),
    "sort_merge_joins": (r"SortMergeJoin", "tree"),
    "nested_loop_or_cartesian": (r"BroadcastNestedLoopJoin|CartesianProduct", "tree"),
    "window_group_limits": (r"WindowGroupLimit", "tree"),
    "python": (r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", "tree"),
}
SIDE_EFFECT = {"land_raw_roundtrip", "append_ods", "materialize", "file_arrival_stream", "read_holdings_csv"}


def audit(df) -> dict[str, int]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n")
    return {k: len(re.findall(p, tree if where == "tree" else details)) for k, (p, where) in COUNTS.items()}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from ledgerflow.session import local_session
    from ledgerflow.plans import catalog

    spark = local_session()
    qs = catalog.queries()
    names = args.names or [n for n in qs if n not in SIDE_EFFECT]
    cols = list(COUNTS)
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for n in names:
        a = audit(qs[n](spark, args.sf))
        print(f"| {n} | " + " | ".join(str(a[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
