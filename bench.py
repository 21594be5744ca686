"""Headline-query benchmark.

Runs the report queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is executed in full
through the ``noop`` sink (no driver collection).  One untimed pass over the whole
headline set comes first, so the timed pass measures steady-state plans rather than
JVM start-up and first-use code generation; ``$BENCH_WARMUP=0`` skips it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.registry import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = {
    "q1_age_groups": "age_bucket_count_lineitem",
    "q1_age_groups_part": "age_bucket_count",
    "q2_closed_rate_rank": "closed_rate_rank",
    "q2_closed_rate_rank_sql": "closed_rate_rank_sql",
    "q3_income_crime_per_capita": "income_crime_per_capita",
    "q4_top_bottom_profile": "top_bottom_profile",
    "q5_nearest_station": "nearest_station",
    "q5k_nearest_3": "nearest_k",
    "g3_points_in_blocks": "points_in_blocks",
    "e1_word_count": "word_count",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="tessera-bench")
    if os.environ.get("BENCH_WARMUP", "1") != "0":
        for name in HEADLINE.values():
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    else:
        QUERIES["bottom_k"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for label, name in HEADLINE.items():
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[label] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
