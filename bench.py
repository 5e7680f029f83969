"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_ALL=1 (every
registered query). Each query runs to completion through the ``noop`` sink
(every column computed, nothing collected); wall time per query.

``ingest`` is timed on its own: events → JSON trace documents → parse →
stored point table (Parquet in the checkpoint folder). The analytics
queries after it read that table, as they would in production;
``trace_flatten`` times the parse path alone.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["trace_flatten", "window_stats", "zone_unique_aircraft", "tracks", "zone_visits",
            "hourly_counts", "legs", "movements"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from skytrace.plans.queries import QUERIES
    from skytrace.session import local_session

    names = HEADLINE
    if os.environ.get("BENCH_QUERIES"):
        names = [n.strip() for n in os.environ["BENCH_QUERIES"].split(",") if n.strip()]
    if os.environ.get("BENCH_ALL") == "1":
        names = list(QUERIES)

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2))
    spark = local_session(cpus, shuffle_partitions=shuffle, app="skytrace-bench")
    # JVM warm-up (class loading, JIT) on a smaller scale; not timed.
    for warm in ("sf0.001", "sf0.01"):
        small = re.sub(r"sf[0-9.]+$", warm, sf_dir.rstrip("/"))
        if os.path.isdir(small) and small != sf_dir.rstrip("/"):
            QUERIES["zone_unique_aircraft"](spark, small).write.format("noop").mode("overwrite").save()

    from skytrace.plans.queries import points

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    points(spark, sf_dir)  # writes the stored point table once
    times["ingest"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
