"""Headline queries at one scale factor; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from stepstone.plans import load_all
from stepstone.plans.registry import QUERIES
from stepstone.session import local_session

HEADLINE = (
    "m1_overlay_merge", "m7_published_graph", "m9_dimension_visibility", "m14_ego_view",
    "a3_directory_tree", "a13_gold_quality", "a19_degrees",
    "w1_age_chain", "w3_row_windows", "w5_exact_duplicates", "w8_merge_votes", "w11_next_topics",
    "g1_reach_counts", "g2_centrality", "g4_components", "g6_break_cycles", "g8_unsortable", "g9_topic_sequence",
    "t1_bigrams", "t2_pair_similarity", "t4_recall_topics", "t6_lint_terms", "t10_reclassify",
    "c4_edge_decisions", "d5_apply_audit", "q12_provenance", "s5_content_manifest", "st2_learner_state",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "stepstone-bench")
    load_all()
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/part.parquet").groupBy("p_brand").count().collect()  # start the executor threads
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
