"""Plan audit: run each registered query and summarise its final physical plan.

    python -m lamina.plans.audit [sf_dir] > PLANS.md

For every query: scans per input table, shuffles (hash exchanges), reused
exchanges, broadcast and sort-merge joins, windows, map-side partial
aggregation, and any Python evaluation node. The final plan is the adaptive
plan after execution (runtime re-planning included).
"""

from __future__ import annotations

import re
import sys
import time

SKIP = {"train_logistic", "train_forest", "train_boosted", "model_benchmark",
        "tune_random_search", "score_batch", "model_roundtrip", "attribution_sampled"}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "MapInArrow",
                "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow")


STAGES = ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage",
          "ResultQueryStage")


def final_plan(df):
    """The final physical plan (a JVM node) after running ``df``; no row reaches the driver."""
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    return plan


def nodes(plan) -> list[tuple[str, str]]:
    """(node name, one-line description) of every operator this query runs:
    query stages are entered, cached relations are not (computed once per
    session by another plan)."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name in STAGES:
            todo.append(node.plan())
            continue
        out.append((name, node.simpleString(40)))
        if name == "InMemoryTableScan":
            continue
        kids = node.children()
        todo.extend(kids.apply(i) for i in range(kids.size()))
    return out


def summarize(plan) -> dict:
    ops = nodes(plan)
    scans: dict[str, int] = {}
    for name, desc in ops:
        if not name.startswith("Scan"):
            continue
        m = (re.search(r"/([a-z_]+)\.parquet", desc)
             or re.search(r"/lamina/([a-z-]+)-[0-9a-f]{12}", desc))
        label = m.group(1) if m else "other"
        scans[label] = scans.get(label, 0) + 1
    names = [n for n, _ in ops]
    return {
        "scans": ", ".join(f"{t}×{n}" for t, n in sorted(scans.items())),
        "shuffles": sum(1 for n, d in ops if n == "Exchange"),
        "reused": names.count("ReusedExchange"),
        "bhj": names.count("BroadcastHashJoin"),
        "smj": names.count("SortMergeJoin"),
        "window": names.count("Window"),
        "partial_agg": "yes" if any("partial_" in d for n, d in ops if "Aggregate" in n) else "",
        "python": ", ".join(sorted({n for n in names if any(p in n for p in PYTHON_NODES)})),
        "cached": names.count("InMemoryTableScan"),
    }


def main(argv: list[str]) -> None:
    from lamina.plans import registry
    from lamina.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    registry.load_all()
    qs, oracle = registry.QUERIES, registry.ORACLE
    print(f"# Plan audit ({sf_dir}, final adaptive plans)\n")
    print("Generated by `python -m lamina.plans.audit`. Columns: file scans per input table; "
          "hash/range/single-partition exchanges (shuffles); exchanges reused within the "
          "query; broadcast-hash and sort-merge joins; window operators; map-side partial "
          "aggregation present; reads of cached (persisted) relations, whose own plans are not "
          "counted (computed once per session); Python evaluation nodes (none expected). Queries that write "
          "and re-read files show the plan of the final read. The model-training queries are "
          "left out (Spark ML jobs).\n")
    print("| query | oracle | scans | shuffles | reused | BHJ | SMJ | windows | partial agg | cached reads | python | sec |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in sorted(qs):
        if name in SKIP:
            continue
        t0 = time.time()
        s = summarize(final_plan(qs[name](spark, sf_dir)))
        print(f"| {name} | {'O' if name in oracle else 'R'} | {s['scans']} | {s['shuffles']} | "
              f"{s['reused']} | {s['bhj']} | {s['smj']} | {s['window']} | {s['partial_agg']} | "
              f"{s['cached']} | {s['python']} | {time.time() - t0:.1f} |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
