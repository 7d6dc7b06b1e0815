"""Benchmark: build the trip tables from the driver's tables, then run every registered query.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
``build_tables`` (landing raw trips, station tables and the year/month-partitioned
trips_clean) and ``build_tables_from_csv`` (landing the same rows as header-group CSV files and
loading them through the CSV front door) are timed on their own; every query then reads the
built tables, as the dashboard exports do after a load.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ridestat.plans.registry import queries
    from ridestat.plans.store import TripStore
    from ridestat.session import get_spark

    t0 = time.time()
    spark = get_spark(
        app="ridestat-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    startup = time.time() - t0

    times: dict[str, float] = {}
    t0 = time.time()
    store = TripStore(spark, sf_dir)
    times["build_tables"] = round(time.time() - t0, 3)
    t0 = time.time()
    store.csv_database()
    times["build_tables_from_csv"] = round(time.time() - t0, 3)

    # Each result is fully computed (every row and column) into Spark's no-op sink, so the
    # timing is the engine's, not the cost of turning result rows into Python objects.
    for name, fn in queries().items():
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "spark_startup_sec": round(startup, 3),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
