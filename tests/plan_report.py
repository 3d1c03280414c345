"""Print a per-query summary of executed physical plans (after AQE).

    python tests/plan_report.py /root/testdata/sf0.01 > PLANS.md

For each registered query: shuffle exchanges, broadcast exchanges, joins by
kind, whole-stage-codegen stages, Python evaluation nodes and unpartitioned
(single-partition) windows, plus the scan's pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SIDE_EFFECTS = {"labels_csv", "partition_counts", "file_inventory", "reconcile", "lr_batch_score", "cv_grid",
                "coefficient_table", "stream_features", "stream_dedupe", "stream_score", "run_audit",
                "stream_enrich", "cv_time_folds", "cv_repeated", "write_predictions", "unlabeled_windows",
                "labels_csv_damaged", "label_stamp_report",
                "incremental_features", "stream_sessions", "stream_labels",
                "stream_late_rows", "stream_model_versions", "window_sketches", "window_features_approx", "distinct_sketches",
                "reconcile_dates", "first_lines", "lineage_runs"}


def summary(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)",
                                   plan)),
        "single_partition_shuffles": plan.count("Exchange SinglePartition"),
        "broadcasts": plan.count("BroadcastExchange"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
        "python_nodes": sum(plan.count(n) for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                                                    "FlatMapGroupsInPandas")),
        "reused_exchanges": plan.count("ReusedExchange"),
        "pushed_filters": sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""}),
    }


def main() -> None:
    from windowlens.session import build_session
    from windowlens.plans.registry import all_queries
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("| query | shuffles | of which to one partition | broadcast joins | sort-merge joins | "
          "codegen stages | Python nodes | pushed filters |")
    print("|---|---|---|---|---|---|---|---|")
    for key, query in sorted(all_queries().items()):
        if key in SIDE_EFFECTS:
            continue
        df = query(spark, data_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # adaptive plans print both; keep the final one
        s = summary(plan)
        print(f"| {key} | {s['shuffles']} | {s['single_partition_shuffles']} | {s['bhj']} | {s['smj']} | "
              f"{s['codegen_stages']} | {s['python_nodes']} | {'; '.join(s['pushed_filters'])[:80]} |",
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
