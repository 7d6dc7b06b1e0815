"""Write PLANS.md: physical plans of the load step and of representative reports.

    python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SHOWN = [
    "monthly_trips",
    "top_start_stations",
    "station_flow_balance",
    "top_routes",
    "quality_by_file",
    "historical_files_summary",
    "missing_station_usage",
    "invalid_start_value_counts",
    "longest_trips",
]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    text = re.sub(r"file:/\S+?/ridestat-store/\w+/", "<store>/", text)
    return re.sub(r"#\d+L?", "", text)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ridestat.operators.clean import clean_trips
    from ridestat.operators.row_index import index_by_key
    from ridestat.plans.registry import queries
    from ridestat.plans.store import TripStore
    from ridestat.session import get_spark
    from ridestat.sources import proxy

    spark = get_spark(master="local[8]", shuffle_partitions=8)
    store = TripStore(spark, sf_dir)
    parts = [
        "# Physical plans\n",
        "Generated by `scripts/explain_plans.py` (local[8], AQE on; `AdaptiveSparkPlan` shows the",
        "initial plan, AQE may still coalesce partitions or turn a small join side into a broadcast).",
        "Store paths are shortened to `<store>/`.\n",
        "## Load: raw rows -> row index (landing step)\n",
        "```\n" + plan_text(index_by_key(proxy.raw_trips(spark, sf_dir), "source_file", "row_key")) + "```\n",
        "## Load: raw rows -> trips_clean\n",
        "```\n" + plan_text(clean_trips(store.raw(), store.dim())) + "```\n",
    ]
    q = queries()
    for name in SHOWN:
        parts.append(f"## {name}\n")
        parts.append("```\n" + plan_text(q[name](spark, sf_dir)) + "```\n")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(parts))
    print(out)


if __name__ == "__main__":
    main()
