"""Station reports on a small fixture, unique and duplicated catalogs, against trips counted one by one."""

import random

import pandas as pd
import pytest

from ridestat.operators import demand, reports
from ridestat.operators.stations import StationDim


def _catalog(duplicated: bool):
    rows = [
        ("1", "Uno", 19.1, -99.1, 10),
        ("2", "Dos", 19.2, -99.2, 0),
        ("3", "Tres", None, -99.3, 5),
        ("4", "Cuatro", 19.4, -99.4, 7),
    ]
    if duplicated:
        rows.append(("1", "Uno bis", 19.11, -99.11, 12))
    return pd.DataFrame(rows, columns=["station_number", "station_name", "latitude", "longitude", "capacity"])


def _trips():
    rnd = random.Random(3)
    out = []
    for _ in range(600):
        s = rnd.choice(["1", "2", "3", "4", "9"])
        e = rnd.choice(["1", "2", "3", "4", "8"])
        out.append((s, e, s != "9", e != "8", rnd.randint(1, 10_800) / 60))
    return pd.DataFrame(
        out, columns=["start_station_number", "end_station_number", "start_station_found", "end_station_found",
                      "duration_minutes"]
    )


def _expected(name, cat, trips):
    """The report as rows, counted trip by trip: a trip counts once for each catalog row of its station."""
    named = {}
    for row in cat.itertuples(index=False):
        named.setdefault(row.station_number, []).append(tuple(row))
    unknown = {k: [(None,) * 5] for k in ("8", "9")}
    at = lambda number: named.get(number) or unknown[number]
    groups = {}
    net = {}
    for t in trips.itertuples(index=False):
        for a in at(t.start_station_number):
            for b in at(t.end_station_number):
                if name == "top_start_stations":
                    key = (t.start_station_number, *a[1:]) if t.start_station_found else None
                elif name == "top_end_stations":
                    key = (t.end_station_number, *b[1:]) if t.end_station_found else None
                elif name == "top_routes":
                    both = t.start_station_found and t.end_station_found and t.start_station_number != t.end_station_number
                    key = (t.start_station_number, a[1], t.end_station_number, b[1]) if both else None
                else:
                    key = (t.start_station_number, *a[1:4]) if t.start_station_found else None
                    if t.end_station_found:
                        net[t.end_station_number] = net.get(t.end_station_number, 0) + 1
                if key:
                    groups.setdefault(key, []).append(t.duration_minutes)
    if name == "station_flow_balance":
        return [(*k, len(v), net.get(k[0], 0), len(v) - net.get(k[0], 0)) for k, v in groups.items()]
    return [(*k, len(v), sum(v) / len(v)) for k, v in groups.items()]


COLUMNS = {
    "top_start_stations": "start_station_number start_station_name start_latitude start_longitude start_capacity total_departures avg_duration_minutes",
    "top_end_stations": "end_station_number end_station_name end_latitude end_longitude end_capacity total_arrivals avg_duration_minutes",
    "station_flow_balance": "station_number station_name latitude longitude total_departures total_arrivals net_departures",
    "top_routes": "start_station_number start_station_name end_station_number end_station_name total_trips avg_duration_minutes",
}


def _canon(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    return sorted(
        tuple("null" if pd.isna(x) else repr(round(float(x), 9) if isinstance(x, float) else x) for x in row)
        for row in df.itertuples(index=False)
    )


@pytest.mark.parametrize("duplicated", [False, True])
@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_station_report_matches_counted_rows(spark, name, duplicated):
    cat, trips = _catalog(duplicated), _trips()
    want = pd.DataFrame(_expected(name, cat, trips), columns=COLUMNS[name].split())
    dim = StationDim.of(spark.createDataFrame(cat).selectExpr(
        "station_number", "station_name", "latitude", "longitude", "cast(capacity as int) as capacity"))
    assert dim.unique is (not duplicated)
    rows = spark.createDataFrame(trips)
    others = "2024 as year", "1 as month", "0 as weekday", "8 as hour", "'M' as gender", "30 as age"
    counts = demand.demand_counts(rows.selectExpr("*", *others))
    for df in (getattr(reports, name)(rows, dim), getattr(demand, name)(counts, dim)):
        got = df.toPandas()
        assert sorted(got.columns) == sorted(want.columns)
        assert _canon(got) == _canon(want[got.columns])


def test_blank_catalog_numbers_are_no_duplicates(spark):
    rows = [("1", "a"), (None, "b"), (None, "c"), ("", "d"), ("", "e")]
    assert StationDim.of(spark.createDataFrame(rows, "station_number string, station_name string")).unique
