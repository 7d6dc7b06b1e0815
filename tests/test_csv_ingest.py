"""Raw CSV front door: header audit, header groups, encodings, delimiters, row numbers, contract."""

import os

import pytest

from ridestat.functions.fixed import CANONICAL_COLUMNS
from ridestat.operators.clean import clean_trips
from ridestat.operators.stations import StationDim
from ridestat.sources import trip_csv

CANON = CANONICAL_COLUMNS


def _row(i):
    return {
        "Genero_Usuario": ["M", "f", " O ", "", "x"][i % 5],
        "Edad_Usuario": ["34", "34.0", "NA", "abc", "20"][i % 5],
        "Bici": str(1000 + i),
        "Ciclo_Estacion_Retiro": ["072", "3", "99", "", "5.0"][i % 5],
        "Fecha_Retiro": f"{1 + i % 28:02d}/01/2022",
        "Hora_Retiro": f"{i % 24:02d}:15:30",
        "Ciclo_EstacionArribo": ["3", "390-391", "072", "7", "null"][i % 5],
        "Fecha_Arribo": f"{1 + i % 28:02d}/01/22",
        "Hora_Arribo": f"{i % 24:02d}:45:00",
    }


def _write(path, header, rows, sep, encoding, bom=False):
    with open(path, "w", encoding=encoding, newline="") as f:
        if bom:
            f.write("\ufeff")
        f.write(sep.join(header) + "\n")
        for r in rows:
            f.write(sep.join(r) + "\n")


@pytest.fixture()
def trip_files(tmp_dir):
    d = os.path.join(tmp_dir, "trips")
    os.makedirs(d)
    # 2022-01: canonical, comma, UTF-8 with BOM, enough rows for several splits
    rows1 = [_row(i) for i in range(400)]
    _write(os.path.join(d, "2022-01.csv"), CANON, [[r[c] for c in CANON] for r in rows1], ",", "utf-8", bom=True)
    # 2022-02: semicolon, Latin-1, alias / accented / padded headers and an extra column
    hdr2 = [" Género_usuario", "Edad_usuario ", "Bici", "CE_retiro", "Fecha_retiro", "Hora_retiro",
            "CE_arribo", "Fecha Arribo", "Hora_arribo", "Extra"]
    rows2 = [_row(i) for i in range(150)]
    _write(os.path.join(d, "2022-02.csv"), hdr2,
           [[r[c] for c in CANON] + ["é"] for r in rows2], ";", "latin-1")
    # 2022-03: canonical columns in another order
    order3 = list(reversed(CANON))
    rows3 = [_row(i) for i in range(120)]
    _write(os.path.join(d, "2022-03.csv"), order3, [[r[c] for c in order3] for r in rows3], ",", "utf-8")
    # 2022-05: tab separated, header only
    _write(os.path.join(d, "2022-05.csv"), CANON, [], "\t", "utf-8")
    return d, {"2022-01.csv": rows1, "2022-02.csv": rows2, "2022-03.csv": rows3, "2022-05.csv": []}


def test_audit(spark, trip_files):
    d, _ = trip_files
    audit = trip_csv.audit_headers(spark, d)
    rows = {r["file"]: r for r in audit.collect()}
    assert rows["2022-01.csv"]["encoding"] == "UTF-8" and rows["2022-01.csv"]["separator"] == ","
    assert rows["2022-01.csv"]["header"][0] == "Genero_Usuario"  # BOM removed
    assert rows["2022-02.csv"]["encoding"] == "ISO-8859-1" and rows["2022-02.csv"]["separator"] == ";"
    assert rows["2022-02.csv"]["header"][0] == "Género_usuario"  # decoded + stripped
    assert rows["2022-05.csv"]["separator"] == "\t"
    assert rows["2022-01.csv"]["data_lines"] == 400
    rep = {r["file"]: r for r in trip_csv.audit_report(audit).collect()}
    assert rep["2022-05.csv"]["separator"] == "'\\t'"
    assert rep["2022-03.csv"]["columns"] == " | ".join(reversed(CANON))
    diff = {r["file"]: r for r in trip_csv.schema_report(audit)}
    assert diff["2022-02.csv"]["missing_columns"] == [] and diff["2022-02.csv"]["extra_columns"] == ["Extra"]


def test_read_groups_and_row_index(spark, trip_files):
    d, expected = trip_files
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")  # many splits per file
    try:
        raw = trip_csv.read_raw_trips(spark, d)
        got = raw.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by_file = {}
    for r in got:
        by_file.setdefault(r["source_file"], []).append(r)
    assert sorted(by_file) == ["2022-01.csv", "2022-02.csv", "2022-03.csv"]
    for name, rows in by_file.items():
        rows.sort(key=lambda r: r["row_index"])
        assert [r["row_index"] for r in rows] == list(range(len(expected[name])))
        for r, e in zip(rows, expected[name]):
            for c in CANON:
                want = e[c]
                want = None if want in ("", "NA", "null") else want
                assert r[c] == want, (name, r["row_index"], c)


def test_contract_missing_column(spark, tmp_dir):
    d = os.path.join(tmp_dir, "bad")
    os.makedirs(d)
    hdr = [c for c in CANON if c != "Hora_Arribo"]
    _write(os.path.join(d, "2022-04.csv"), hdr, [[_row(0)[c] for c in hdr]], ",", "utf-8")
    with pytest.raises(ValueError, match="Hora_Arribo"):
        trip_csv.read_raw_trips(spark, d)
    raw = trip_csv.read_raw_trips(spark, d, require_all_columns=False)
    r = raw.first()
    assert r["Hora_Arribo"] is None and r["__has_Hora_Arribo"] is False and r["__has_Bici"] is True


def test_csv_to_trips_clean(spark, trip_files):
    d, expected = trip_files
    stations = spark.createDataFrame(
        [("3", "Three"), ("72", "Seventy-two"), ("390-391", "Pair")], "station_number string, station_name string"
    ).selectExpr("station_number", "station_name", "19.0 as latitude", "-99.0 as longitude", "10 as capacity")
    dim = StationDim.of(stations)
    trips = clean_trips(trip_csv.read_raw_trips(spark, d), dim)
    rows = {r["trip_id"]: r for r in trips.collect()}
    assert len(rows) == 400 + 150 + 120
    r = rows["2022-02_1"]  # row 1 of the Latin-1 file
    assert r["gender"] == "F" and r["age"] == 34 and r["start_station_number"] == "3"
    assert r["start_station_found"] and r["end_station_number"] == "390-391" and r["end_station_found"]
    r = rows["2022-01_0"]
    assert r["start_station_number"] == "72" and r["start_station_found"]
    assert r["duration_minutes"] == 29.5 and r["year"] == 2022 and r["weekday"] == 5 and r["is_weekend"]
    r = rows["2022-03_3"]
    assert r["start_station_number"] == "" and not r["start_station_found"] and r["gender"] == "?"


def test_quoted_fields(spark, tmp_dir):
    d = os.path.join(tmp_dir, "q")
    os.makedirs(d)
    row = dict(_row(0), Bici='"12, ""A"""')
    _write(os.path.join(d, "2022-06.csv"), CANON, [[row[c] for c in CANON]], ",", "utf-8")
    r = trip_csv.read_raw_trips(spark, d).first()
    assert r["Bici"] == '12, "A"' and r["Hora_Arribo"] == row["Hora_Arribo"]


def test_quoted_line_breaks_stay_in_their_row(spark, tmp_dir):
    d = os.path.join(tmp_dir, "breaks")
    os.makedirs(d)
    rows = [[_row(i)[c] for c in CANON] for i in range(4)]
    rows[1][2] = '"a\nb"'
    _write(os.path.join(d, "2022-06.csv"), CANON, rows, ",", "utf-8")
    got = sorted(trip_csv.read_raw_trips(spark, d).collect(), key=lambda r: r["row_index"])
    assert [r["row_index"] for r in got] == [0, 1, 2, 3]
    assert got[1]["Bici"] == "a\nb" and got[2]["Bici"] == "1002"


def test_reports_on_dirty_dates_and_files_without_rows(spark, tmp_dir):
    from ridestat.operators import validation

    d = os.path.join(tmp_dir, "dirty")
    os.makedirs(d)
    dates = ["abc", "3", "01/2022", "", "05/01/2022", "05/01/2022"]
    times = ["10:00:00", "10:00:00", "10:00:00", "10:00:00", "x", "10"]
    rows = [[{**_row(i), "Fecha_Retiro": dates[i], "Hora_Retiro": times[i]}[c] for c in CANON] for i in range(6)]
    _write(os.path.join(d, "2022-01.csv"), CANON, rows, ",", "utf-8")
    _write(os.path.join(d, "2022-05.csv"), CANON, [], ",", "utf-8")
    audit = trip_csv.audit_headers(spark, d)
    dim = StationDim.of(spark.createDataFrame([("3", "a", 1.0, 2.0, 3)], "station_number string, station_name string, latitude double, longitude double, capacity int"))
    raw = trip_csv.read_raw_trips(spark, d, audit, require_all_columns=False, with_row_index=False)
    summary = {r["file"]: r for r in validation.historical_files_summary(raw, dim, audit.select("file")).collect()}
    assert (summary["2022-01.csv"]["rows"], summary["2022-01.csv"]["invalid_fecha_retiro"], summary["2022-01.csv"]["invalid_hora_retiro"]) == (6, 4, 2)
    assert summary["2022-05.csv"]["rows"] == 0 and summary["2022-05.csv"]["gender_M"] == 0
    by_file = {r["file"]: r for r in validation.missing_station_usage_by_file(raw, dim, audit.select("file")).collect()}
    assert by_file["2022-05.csv"]["rows"] == 0 and by_file["2022-05.csv"]["missing_start_percentage"] == 0.0
    plan = validation.missing_station_usage_by_file(raw, dim)._jdf.queryExecution().optimizedPlan().toString()
    assert "Fecha_Retiro" not in plan.split("Relation")[0]
    audited = audit._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in audited
    diff = {r["file"]: r for r in trip_csv.schema_report(audit)}
    assert diff["2022-05.csv"]["missing_columns"] == []


def _malformed(d):
    """Two files: rows too long and too short; the same with quoted line breaks and separators inside fields."""
    full = [_row(0)[c] for c in CANON]
    rows = [full, [*full, "9"], full[:4], [*full, "9", "8", "7"], full]
    _write(os.path.join(d, "2023-01.csv"), CANON, rows, ",", "utf-8")
    quoted = ['"a\nb"' if c == "Bici" else ('"x;""y"' if c == "Edad_Usuario" else v) for c, v in zip(CANON, full, strict=True)]
    _write(os.path.join(d, "2023-02.csv"), CANON, [quoted, [*quoted, "9"], quoted[:6], quoted], ";", "utf-8")


def test_rows_that_do_not_fit_their_header(spark, tmp_dir):
    d = os.path.join(tmp_dir, "bad")
    os.makedirs(d)
    _malformed(d)
    _write(os.path.join(d, "2023-03.csv"), CANON, [], ",", "utf-8")
    audit = trip_csv.audit_headers(spark, d).checkpoint()
    raw = trip_csv.read_raw_trips(spark, d, audit, require_all_columns=False)
    got = {r["file"]: tuple(r)[1:] for r in trip_csv.malformed_rows(raw, audit.select("file")).collect()}
    assert got == {"2023-01.csv": (5, 1, 2, 1), "2023-02.csv": (4, 1, 1, 1), "2023-03.csv": (0, 0, 0, None)}
    rows = {(r["source_file"], r["row_index"]): r for r in raw.collect()}
    assert rows["2023-01.csv", 2]["Fecha_Retiro"] is None and rows["2023-01.csv", 2]["Ciclo_Estacion_Retiro"] is not None
    assert rows["2023-02.csv", 3]["Bici"] == "a\nb" and rows["2023-02.csv", 3]["__surplus"] == 0
    assert rows["2023-01.csv", 3]["__surplus"] == 3 and rows["2023-02.csv", 2]["__surplus"] == -3
    with pytest.raises(Exception, match=r"2023-0[12]\.csv row [13]: [13] fields more than the header"):
        trip_csv.read_raw_trips(spark, d).collect()


def test_headers_are_found_without_moving_lines(spark, trip_files):
    d, _ = trip_files
    plan = trip_csv.audit_headers(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
