"""Write PLANS.md: executed physical-plan shape of every registered key.

Counts are of the physical plan before adaptive re-planning: exchanges
(shuffles) and broadcasts of the main query. Scalar subqueries (calendar
bounds, sampled segment bounds, row counts) are small plans of their own,
computed once per query and reused wherever referenced; they are counted
as distinct subqueries, not in the shuffle columns. Joins Catalyst
broadcasts here because a side is small at this scale become sort-merge
joins on large data; the explicit broadcasts in the code are only of tables
bounded by construction.

CLI: ``python tests/plan_report.py [sf_dir] [out.md]``
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")


def _depth(line: str) -> int:
    m = re.search(r"[A-Za-z*(]", line)
    return m.start() if m else len(line)


def main_plan_lines(plan: str) -> list[str]:
    """Plan lines without the subtrees of scalar subqueries (printed nested inside the tree)."""
    out, skip_below = [], None
    for line in plan.splitlines():
        d = _depth(line)
        if skip_below is not None:
            if d > skip_below:
                continue
            skip_below = None
        if re.match(r"^[\s:+\-]*Subquery subquery#", line):       # a subquery node, not a mention
            skip_below = d
            continue
        out.append(line)
    return out


def shape(plan: str) -> dict:
    lines = main_plan_lines(plan)
    main = "\n".join(lines)
    exchanges = [ln for ln in lines if re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                                                 r"RoundRobinPartitioning)", ln)]
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                  r"CartesianProduct)", main)))
    return {
        "shuffles": len(exchanges),
        "single_partition": sum(1 for ln in exchanges if "SinglePartition" in ln),
        "broadcasts": sum(1 for ln in lines if "BroadcastExchange" in ln),
        "subqueries": len(set(re.findall(r"Subquery subquery#(\d+)", plan))),
        "joins": ", ".join(joins) or "-",
        "window_group_limit": "WindowGroupLimit" in plan,
        "take_ordered": "TakeOrderedAndProject" in plan,
    }


def main() -> None:
    from riskspark.session import local_session
    from riskspark.plans import catalog

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session()
    rows = []
    for key, fn in sorted(catalog.query_callables().items()):
        rows.append((key, shape(fn(spark, sf)._jdf.queryExecution().executedPlan().toString())))
    with open(out, "w") as f:
        f.write("# Plan shapes\n\n")
        f.write(__doc__.split("CLI:")[0].strip().replace("Write PLANS.md: executed", "Executed") + "\n\n")
        f.write(f"Scale factor: `{sf}`, `local[8]`, `spark.sql.shuffle.partitions=8`. "
                "Generated by `python tests/plan_report.py`.\n\n")
        f.write("| Key | Shuffles | of which single-partition (over aggregates) | Broadcasts | Scalar subqueries | "
                "Joins | Partial top-n | TakeOrdered |\n")
        f.write("| --- | --- | --- | --- | --- | --- | --- | --- |\n")
        for key, s in rows:
            f.write(f"| `{key}` | {s['shuffles']} | {s['single_partition']} | {s['broadcasts']} | {s['subqueries']} | "
                    f"{s['joins']} | {'yes' if s['window_group_limit'] else ''} | {'yes' if s['take_ordered'] else ''} |\n")


if __name__ == "__main__":
    main()
