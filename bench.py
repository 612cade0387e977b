"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES
(comma-separated names, default the headline list).
"""

from __future__ import annotations

import json
import os
import time

from roadloom import catalog
from roadloom.session import local_session

HEADLINE = [
    "driver_top5_maxsim",
    "driver_top5",
    "driver_score_ratio",
    "lsh_refined_top5",
    "driver_ideal_pairvec",
    "driver_mean_distance_cosine",
    "medoid_by_sroute",
    "driver_pairs_jaccard",
    "lsh_candidates",
    "divergence_summary",
    "kmeans_clustroids",
    "ideal_route",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, "roadloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["route_profile"](spark, folder).collect()  # start the JVM and warm the file cache
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
