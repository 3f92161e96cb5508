"""Summarise the final adaptive plan of every registered query (PLANS.md).

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
Each query runs once; its executed plan is read back with ``explain()``
(the "Final Plan" sections of adaptive plans, subqueries included).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_sections(text: str) -> str:
    parts = text.split("== Final Plan ==")
    if len(parts) == 1:
        return text
    return "\n".join(p.split("== Initial Plan ==")[0] for p in parts[1:])


def summarise(plan: str) -> dict:
    # subquery plans are printed again at every reference: count unique lines
    lines = {re.sub(r"^[\s:|+\-]*", "", ln) for ln in plan.splitlines()}
    lines.discard("")

    def n(pattern):
        return sum(1 for ln in lines if re.search(pattern, ln))
    real = [ln for ln in lines if "PushedFilters" in ln and re.search(
        r"PushedFilters: \[[^\n]*(GreaterThan|LessThan|EqualTo|In\(|StringStartsWith|Or\(|Not\()",
        ln.split("ReadSchema")[0])]
    return {
        "shuffles": n(r"^(\*\(\d+\) )?(AQEShuffleRead.*)?Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        "broadcasts": n(r"BroadcastExchange"),
        "bhj": n(r"BroadcastHashJoin"),
        "smj": n(r"SortMergeJoin"),
        "shj": n(r"ShuffledHashJoin"),
        "fact_scans": n(r"(Scan parquet|FileScan parquet) \[[^\]]*l_orderkey"),
        "filter_pushdown": "yes" if real else "-",
        "codegen_stages": len({m for ln in lines for m in re.findall(r"\*\((\d+)\)", ln)}),
        "windows": n(r"^(\*\(\d+\) )?Window \["),
        "subqueries": n(r"^Subquery subquery"),
        "reused": n(r"Reused(Exchange|Subquery)"),
    }


def main():
    from starkpi.catalog import QUERIES
    from starkpi.session import local_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    cols = ["shuffles", "broadcasts", "bhj", "smj", "shj", "fact_scans", "filter_pushdown", "codegen_stages",
            "windows", "subqueries", "reused"]
    print(f"# Final plans of the registered queries ({os.path.basename(sf_dir)}, local[*], AQE on)\n")
    print("Generated by `scripts/plan_report.py`. shuffles = non-broadcast exchanges; bhj/smj/shj = broadcast-hash, "
          "sort-merge, shuffled-hash joins; fact_scans = lineitem scans; filter_pushdown = a scan with pushed "
          "predicates beyond IS NOT NULL; codegen_stages = whole-stage-codegen spans; reused = exchanges and "
          "subqueries whose output another part of the plan has made.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.toPandas()  # runs the DataFrame's own plan (Arrow), so explain() shows the final plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        s = summarise(final_sections(buf.getvalue()))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    print("\nReading notes: unique plan lines are counted. A query that reads the raw facts scans them once (0: "
          "below an exchange that the final plan shows only as reused; 2: the dirtied star's union, one side pruned "
          "to its copies); the distributed rank reads its aggregate several times through reused exchanges. Broadcasts are sides that "
          "Catalyst or AQE measured as small, none is hinted. windows counts partitioned windows (by line key, rank "
          "bucket, month) and bounded ones (one row per month, category or country, the first n rows).")


if __name__ == "__main__":
    main()
