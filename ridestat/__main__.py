"""Command line: run the pipeline steps on landed files.

    python -m ridestat catalog  --station-information landing/station_information.json \\
                                --catalog processed/station_catalog [--raw-dir raw] [--discovery landing/gbfs.json]
    python -m ridestat audit    --trips raw/trips --out validation
    python -m ridestat validate --trips raw/trips --catalog processed/station_catalog --out validation
    python -m ridestat missing  --trips raw/trips --catalog processed/station_catalog --out validation
    python -m ridestat load     --trips raw/trips --catalog processed/station_catalog --db db
    python -m ridestat quality  --db db --out validation
    python -m ridestat triage   --trips raw/trips/2022-09.csv --out validation --tag 2022_09
    python -m ridestat export   --db db --out exports

Each step prints its summary rows (small, aggregated results only).
"""

from __future__ import annotations

import argparse
import sys

from .plans import pipeline
from .session import get_spark


SHOWN = 50


def _show(name: str, df) -> None:
    print(f"== {name}")
    rows = df.limit(SHOWN + 1).collect()
    for row in rows[:SHOWN]:
        print(row.asDict())
    if len(rows) > SHOWN:
        print(f"... only the first {SHOWN} of {df.count()} rows are shown")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ridestat", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("step", choices=["catalog", "audit", "validate", "missing", "load", "quality", "triage", "export"])
    ap.add_argument("--trips", help="folder of monthly CSV files, or one CSV file")
    ap.add_argument("--catalog", help="station catalog CSV folder")
    ap.add_argument("--station-information", help="landed GBFS station_information JSON")
    ap.add_argument("--discovery", help="landed GBFS discovery JSON (feed must be listed)")
    ap.add_argument("--raw-dir", help="where to keep the raw JSON snapshot")
    ap.add_argument("--db", help="database folder (stations, trips_clean)")
    ap.add_argument("--out", help="output folder for reports")
    ap.add_argument("--tag", default="triage", help="name part for triage outputs")
    a = ap.parse_args(argv)

    spark = get_spark()
    if a.step == "catalog":
        _show("catalog summary", pipeline.build_station_catalog(
            spark, a.station_information, a.catalog, raw_dir=a.raw_dir, discovery_json=a.discovery))
    elif a.step == "audit":
        _show("csv columns audit", pipeline.audit_trip_files(spark, a.trips, a.out))
    elif a.step == "validate":
        res = pipeline.validate_trip_files(spark, a.trips, a.catalog, a.out)
        _show("files summary", res["summary"])
        _show("totals", res["totals"])
        _show("missing and extra columns", res["schema"])
    elif a.step == "missing":
        res = pipeline.missing_station_report(spark, a.trips, a.catalog, a.out)
        _show("totals", res["totals"])
        _show("top missing stations", res["top"])
    elif a.step == "load":
        _show("load validation", pipeline.build_database(spark, a.trips, a.catalog, a.db))
    elif a.step == "quality":
        res = pipeline.quality_report(spark, a.db, a.out)
        _show("quality summary", res["quality_summary"])
        _show("top invalid start files", res["top_invalid_start_files"])
        _show("clean summary", res["clean_summary"])
    elif a.step == "triage":
        res = pipeline.triage_datetimes(spark, a.trips, a.out, a.tag)
        _show("datetime triage", res["summary"])
        _show("invalid start value counts", res["value_counts"])
        _show("duration describe", res["describe"])
    elif a.step == "export":
        for name, path in pipeline.export_dashboards(spark, a.db, a.out).items():
            print(f"exported {name}: {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
