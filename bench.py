"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trackloom.queries import QUERIES  # noqa: E402
from trackloom.session import local_session  # noqa: E402

HEADLINE = [
    "nearest_asof", "forward_asof", "complete_set_asof", "burst_instants", "coverage_window", "scene_yield", "interp_value",
    "slerp_pose", "interval_fanout", "fixed_scenes", "moving_average_same", "off_grid_frames", "delivery_stats", "clock_fit",
    "percentile_table", "runlength_timeline", "build_sample_data", "prune_cascade", "fk_audit", "content_dedup", "components",
    "greedy_overlap", "grid_occupancy", "box_flags", "iou_pairs", "geodetic_enu",
    "stream_scenes", "pair_cover", "contiguous_fill", "clock_steps", "percentiles_overall",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="trackloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start-up is not part of any query
    seconds = {}
    for n in names:
        start = time.perf_counter()
        QUERIES[n](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[n] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
