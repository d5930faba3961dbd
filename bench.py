"""Wall time of every registered query on one table set.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma separated
names, default all). Each query is planned and run once into the no-op sink after a short warm-up; the result
is ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetmart import session  # noqa: E402
from fleetmart.plans.catalog import all_queries  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = session.build(
        "bench", f"local[{cpus}]", shuffle_partitions=int(cpus), spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"), spark__driver__host="127.0.0.1"
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {n: q for n, q in all_queries().items() if not chosen or n in chosen}
    for name in ("reti_savings_by_reason", "counter_delta"):  # warm-up, not counted
        if name in queries:
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name, q in queries.items():
        start = time.perf_counter()
        try:
            q.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        except Exception as e:  # noqa: BLE001 - one broken query must not hide the others' times
            failed[name] = str(e)[:200]
    line = {
        "metric": "total_query_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
