"""Times every registered query once and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import queries  # noqa: E402
from evergreen.session import build_session  # noqa: E402


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    spark = build_session(f"local[{cpus}]", partitions=int(cpus) if cpus.isdigit() else 8)
    # Small local tables: keep every core busy after a shuffle.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    spark.sparkContext.setLogLevel("ERROR")
    todo = queries()
    if wanted:
        todo = {n: todo[n] for n in wanted.split(",")}
    spark.range(1).count()
    times = {}
    for name, query in todo.items():
        start = time.perf_counter()
        query(spark, d).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": d.rstrip("/").split("/sf")[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
