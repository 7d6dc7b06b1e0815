"""Published reconciliation figures for the trip proxy at sf 0.01 (FIXTURES.md section 4)."""

import pytest

from ridestat.plans.registry import queries

from .conftest import SF_CHECK


@pytest.fixture(scope="module")
def q(spark):
    qs = queries()
    return lambda name: qs[name](spark, SF_CHECK)


def test_quality_counts(q):
    r = q("quality_summary").first()
    assert r.total_trips == 10_000
    assert (r.invalid_start_datetime, r.invalid_end_datetime) == (100, 0)
    assert (r.negative_duration_trips, r.zero_duration_trips) == (198, 200)
    assert (r.trips_over_3_hours, r.trips_over_24_hours) == (616, 198)
    assert (r.missing_start_station_trips, r.missing_end_station_trips) == (1626, 1754)
    # invariant: total = valid + trips with an invalid start or end (no invalid end here)
    assert r.valid_datetime_trips == r.total_trips - r.invalid_start_datetime


def test_per_file_quality_sums_to_summary(q):
    total = q("quality_summary").first().asDict()
    by_file = q("quality_by_file").collect()
    for col in ("total_trips", "invalid_start_datetime", "invalid_end_datetime", "negative_duration_trips",
                "trips_over_3_hours", "missing_start_station_trips", "missing_end_station_trips"):
        assert sum(r[col] for r in by_file) == total[col], col
    lv = q("load_validation").first().asDict()
    assert all(lv[k] == total[k] for k in lv)


def test_clean_and_calendar(q):
    assert q("clean_summary").first().clean_trips == 8886
    monthly = q("monthly_trips").collect()
    assert len(monthly) == 24
    first = monthly[0]
    assert (first.year, first.month, first.total_trips) == (2024, 1, 184)
    assert round(first.avg_duration_minutes, 6) == 42.973007 and first.median_duration_minutes == 33.7
    hourly = q("hourly_trips").collect()
    assert len(hourly) == 24 and hourly[0].total_trips == 360 and round(hourly[0].avg_duration_minutes, 6) == 46.690556
    assert q("hourly_weekday_trips").count() == 168
    # every clean trip lands in exactly one month and one hour
    assert sum(r.total_trips for r in monthly) == sum(r.total_trips for r in hourly) == 8886


def test_station_reports(q):
    top = q("top_start_stations").collect()
    assert len(top) == 25
    assert (top[0].start_station_number, top[0].start_station_name, top[0].total_departures) == ("15", "NATION_15", 338)
    assert round(top[0].avg_duration_minutes, 6) == 47.489645
    assert q("station_flow_balance").count() == 25
    assert q("top_routes").count() == 500
    assert q("user_profile_summary").count() == 32


def test_missing_stations_and_durations(spark, q):
    from ridestat.operators.triage import describe_durations
    from ridestat.plans.store import TripStore

    assert q("missing_station_totals").first().unique_missing_stations == 5
    # published figures: durations of every trip whose datetimes load (two-digit years accepted)
    d = describe_durations(TripStore(spark, SF_CHECK).trips()).first()
    assert d["count"] == 9900 and d["min"] == -5 and d["max"] == 1560
    assert round(d["mean"], 6) == 81.516827 and d["std"] == 218.260968
    assert (round(d["p25"], 6), round(d["p50"], 6), round(d["p75"], 6)) == (13.016667, 34.675, 73.291667)


def test_validation_reconciles(q):
    by_file = q("missing_station_usage_by_file").collect()
    tot = q("missing_station_totals").first()
    assert sum(r.rows for r in by_file) == tot.rows == 10_000
    assert sum(r.missing_start_rows for r in by_file) == tot.missing_start_rows
    quality_files = q("quality_by_file").collect()
    assert sum(r.total_trips for r in quality_files) == 10_000


def test_strict_triage_counts(q):
    # the triage parse accepts four-digit years only: two-digit-year rows are invalid there
    # brute force over event ids 0..9999: start invalid when id % 101 == 0 (31/02) or id % 11 == 0
    # (two-digit year); end invalid when id % 11 == 0
    ids = range(10_000)
    bad_start = sum(1 for i in ids if i % 101 == 0 or i % 11 == 0)
    bad_end = sum(1 for i in ids if i % 11 == 0)
    valid = sum(1 for i in ids if i % 101 != 0 and i % 11 != 0)
    t = q("datetime_triage_summary").first()
    assert (t.total_rows, t.invalid_start_datetime, t.invalid_end_datetime) == (10_000, bad_start, bad_end)
    assert q("duration_describe").first()["count"] == valid == 9000


def test_report_orders(q):
    ms = [(r.file, r.missing_in != "Ciclo_Estacion_Retiro", r.station_key) for r in q("missing_stations_summary").collect()]
    assert ms == sorted(ms)  # per file: start-column keys first, then end-column keys, each by key
    usage = [r.affected_trips for r in q("missing_station_usage").collect()]
    assert usage == sorted(usage, reverse=True)
    flow = [abs(r.net_departures) for r in q("station_flow_balance").collect()]
    assert flow == sorted(flow, reverse=True)
    months = [(r.year, r.month) for r in q("monthly_trips").collect()]
    assert months == sorted(months)
    routes = [r.total_trips for r in q("top_routes").collect()]
    assert routes == sorted(routes, reverse=True)
