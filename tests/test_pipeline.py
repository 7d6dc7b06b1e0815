"""End-to-end jobs on landed files: GBFS JSON -> catalog CSV -> load -> quality / validation / exports."""

import csv
import glob
import json
import os

import pytest

from ridestat.functions.fixed import CANONICAL_COLUMNS
from ridestat.plans import pipeline
from ridestat.sinks.csv import read_report_csv
from ridestat.sources import gbfs


def _station_json(path):
    doc = {
        "last_updated": 1700000000,
        "data": {
            "stations": [
                {"station_id": "1", "external_id": "e1", "short_name": "072", "name": "Reforma\nNorte",
                 "lat": 19.43, "lon": -99.14, "capacity": 20, "rental_methods": ["KEY", "CREDITCARD"],
                 "has_kiosk": True},
                {"station_id": "2", "external_id": "e2", "short_name": "3", "name": " Centro ",
                 "lat": "n/a", "lon": -99.1, "capacity": 0, "has_kiosk": False},
                {"station_id": "3", "external_id": "e3", "short_name": None, "name": "Sin numero",
                 "lat": 19.4, "lon": -99.2, "capacity": 5},
                {"station_id": "4", "external_id": "e4", "short_name": "390-391", "name": "Doble",
                 "lat": 19.41, "lon": -99.21, "capacity": 15, "rental_methods": ["KEY"], "has_kiosk": True},
            ]
        },
    }
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)


def _discovery_json(path):
    doc = {"last_updated": 1, "data": {"es": {"feeds": [
        {"name": "system_information", "url": "http://x/si.json"},
        {"name": "station_information", "url": "http://x/station_information.json"},
    ]}}}
    with open(path, "w") as f:
        json.dump(doc, f)


def _trips(d):
    os.makedirs(d)
    rows = []
    for i in range(60):
        rows.append([["M", "F", "O", "?", ""][i % 5], str(18 + i % 50), str(i), ["072", "3", "999", "", "390-391"][i % 5],
                     f"{1 + i % 27:02d}/09/2022", f"{i % 24:02d}:00:00", ["3", "072", "390-391", "55", "3"][i % 5],
                     f"{1 + i % 27:02d}/09/2022", f"{i % 24:02d}:{10 + i % 40:02d}:00"])
    rows[7][4] = "31/02/2022"  # invalid start
    rows[8][7] = "01/10/22"  # two-digit year end: valid for the load, invalid for the strict triage
    with open(os.path.join(d, "2022-09.csv"), "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(CANONICAL_COLUMNS)
        w.writerows(rows)
    return rows


@pytest.fixture()
def landed(tmp_dir):
    sj, dj = os.path.join(tmp_dir, "station_information.json"), os.path.join(tmp_dir, "gbfs.json")
    _station_json(sj)
    _discovery_json(dj)
    rows = _trips(os.path.join(tmp_dir, "trips"))
    return tmp_dir, sj, dj, rows


def test_gbfs_and_catalog(spark, landed):
    root, sj, dj, _ = landed
    assert gbfs.feed_url(spark, dj, "station_information") == "http://x/station_information.json"
    with pytest.raises(ValueError):
        gbfs.feed_url(spark, dj, "nope")
    summary = pipeline.build_station_catalog(
        spark, sj, os.path.join(root, "catalog"), raw_dir=os.path.join(root, "raw"), discovery_json=dj
    ).first()
    assert (summary["total_stations"], summary["missing_coordinates"], summary["capacity_zero"]) == (4, 1, 1)
    assert len(glob.glob(os.path.join(root, "raw", "station_information_raw_*"))) == 1
    cat = read_report_csv(spark, os.path.join(root, "catalog")).collect()
    assert [r["station_number"] for r in cat] == ["072", "3", "390-391", None]  # sorted, nulls last
    assert cat[0]["station_name"] == "Reforma Norte" and cat[0]["rental_methods"] == "KEY,CREDITCARD"
    assert gbfs.feed_last_updated(spark, sj).first()["last_updated_utc"].year == 2023


def test_load_quality_validation_exports(spark, landed):
    root, sj, _, rows = landed
    cat = os.path.join(root, "catalog")
    pipeline.build_station_catalog(spark, sj, cat)
    db_root, out = os.path.join(root, "db"), os.path.join(root, "out")
    lv = pipeline.build_database(spark, os.path.join(root, "trips"), cat, db_root).first()
    assert lv["total_trips"] == 60 and lv["invalid_start_datetime"] == 1 and lv["invalid_end_datetime"] == 0
    # start keys: 072, 3, 999, "", 390-391 -> 999 and "" are not found
    assert lv["missing_start_station_trips"] == 24
    q = pipeline.quality_report(spark, db_root, out)
    assert q["quality_summary"].first()["total_trips"] == 60
    assert os.path.isdir(os.path.join(out, "quality_by_file"))
    v = pipeline.validate_trip_files(spark, os.path.join(root, "trips"), cat, out)
    s = v["summary"].first()
    assert s["rows"] == 60 and s["unique_start_stations"] == 4 and s["missing_start_stations"] == 1
    assert s["invalid_fecha_retiro"] == 1 and s["gender_unknown"] == 24  # "?" and empty (missing)
    m = pipeline.missing_station_report(spark, os.path.join(root, "trips"), cat, out)
    usage = {(r["role"], r["station_key"]): r["affected_trips"] for r in m["usage"].collect()}
    assert usage == {("start", "999"): 12, ("end", "55"): 12}
    t = pipeline.triage_datetimes(spark, os.path.join(root, "trips", "2022-09.csv"), out, "2022_09")
    ts = t["summary"].first()
    assert (ts["total_rows"], ts["invalid_start_datetime"], ts["invalid_end_datetime"]) == (60, 1, 1)
    assert t["sample"].count() == 2
    paths = pipeline.export_dashboards(spark, db_root, os.path.join(out, "exports"))
    assert sorted(paths) == sorted(pipeline.EXPORTS)
    monthly = read_report_csv(spark, paths["monthly_trips"]).collect()
    assert sum(int(r["total_trips"]) for r in monthly) == pipeline.Database(spark, db_root).analysis().count()
    with open(glob.glob(os.path.join(out, "quality_by_file", "*.csv"))[0], "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"  # BOM header


def test_sql_views(spark, landed):
    root, sj, _, _ = landed
    cat = os.path.join(root, "catalog")
    pipeline.build_station_catalog(spark, sj, cat)
    db_root = os.path.join(root, "db")
    pipeline.build_database(spark, os.path.join(root, "trips"), cat, db_root)
    pipeline.Database(spark, db_root).register()
    n_clean = spark.sql("SELECT count(*) FROM trips_analysis").first()[0]
    assert n_clean == pipeline.Database(spark, db_root).analysis().count() > 0
    # the joined view keeps every clean trip and names known start stations
    r = spark.sql(
        "SELECT count(*) AS n, count(start_station_name) AS named FROM trips_with_station_info"
    ).first()
    assert r.n == n_clean and 0 < r.named < r.n
    # the table keeps every catalog row (the missing short_name becomes a blank key, never joined)
    assert spark.sql("SELECT count(*) FROM stations WHERE station_number = ''").first()[0] == 1


def test_command_line_steps(spark, landed, capsys):
    from ridestat.__main__ import main

    root, sj, dj, _ = landed
    cat, db, out = (os.path.join(root, n) for n in ("catalog", "db", "out"))
    trips = os.path.join(root, "trips")
    assert main(["catalog", "--station-information", sj, "--catalog", cat, "--discovery", dj]) == 0
    assert main(["audit", "--trips", trips, "--out", out]) == 0
    assert main(["load", "--trips", trips, "--catalog", cat, "--db", db]) == 0
    assert main(["quality", "--db", db, "--out", out]) == 0
    assert main(["export", "--db", db, "--out", os.path.join(out, "exports")]) == 0
    text = capsys.readouterr().out
    assert "'total_stations': 4" in text and "'total_trips': 60" in text and "exported top_routes" in text
