"""Scalar rules against the unit tables (expected values follow the source system's behaviour)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridestat.functions import datetimes as D
from ridestat.functions import rules as R
from ridestat.functions.text import normalize_header, py_strip


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_station_key(spark):
    vals = [None, "022", "22", "22.0", "390-391", "000", "0.0.0", "12345678901234567890123", " 07 ", "\t5\n", ""]
    assert _one(spark, vals, R.station_key) == [
        "", "22", "22", "22", "390-391", "0", "0.0", "12345678901234567890123", "7", "5", ""
    ]


def test_gender(spark):
    assert _one(spark, [None, "m", " F ", "O", "?", "x", "\tf"], R.gender) == ["?", "M", "F", "O", "?", "?", "F"]


def test_raw_gender_keeps_case(spark):
    assert _one(spark, [None, "m", " M ", "?"], R.raw_gender) == ["?", "m", "M", "?"]


def test_age(spark):
    vals = ["34", "34.0", " 34 ", "1e2", "-5", "abc", "", None, "34.5", "inf", "NaN", "99999999999"]
    assert _one(spark, vals, R.age) == [34, 34, 34, 100, -5, None, None, None, None, None, None, None]


def test_age_group(spark):
    vals = [None, 17, -5, 18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, 120]
    assert _one(spark, vals, R.age_group, "int") == [
        "Unknown", "Under 18", "Under 18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44",
        "45-54", "45-54", "55-64", "55-64", "65+", "65+",
    ]


@pytest.mark.parametrize(
    "date,time,expected",
    [
        ("01/02/2022", "10:20:30", dt.datetime(2022, 2, 1, 10, 20, 30)),
        ("1/2/2022", "1:2:3", dt.datetime(2022, 2, 1, 1, 2, 3)),
        ("01/02/22", "10:20:30", dt.datetime(2022, 2, 1, 10, 20, 30)),
        ("01/02/68", "10:20:30", dt.datetime(2068, 2, 1, 10, 20, 30)),
        ("01/02/69", "10:20:30", dt.datetime(1969, 2, 1, 10, 20, 30)),
        (" 01/02/2022 ", "  10:20:30", dt.datetime(2022, 2, 1, 10, 20, 30)),
        ("01/02/2022", "10:20:60", dt.datetime(2022, 2, 1, 10, 21, 0)),
        ("31/02/2022", "10:20:30", None),
        ("01/02/2022", "24:00:00", None),
        ("01/02/2022", "10:20", None),
        ("001/02/2022", "10:20:30", None),
        ("01/02/0022", "10:20:30", None),
        (None, None, None),
        ("01/02/2022", None, None),
    ],
)
def test_parse_trip_datetime(spark, date, time, expected):
    df = spark.createDataFrame([(date, time)], "d string, t string")
    got = df.select(D.parse_trip_datetime("d", "t")).first()[0]
    assert got == expected


def test_strict_parse_rejects_two_digit_years(spark):
    df = spark.createDataFrame([("01/02/22", "10:20:30"), ("01/02/2022", "10:20:30")], "d string, t string")
    got = [r[0] for r in df.select(D.parse_trip_datetime("d", "t", two_digit_years=False)).collect()]
    assert got == [None, dt.datetime(2022, 2, 1, 10, 20, 30)]


def test_date_and_time_only_validity(spark):
    dates = ["1/9/2022", "01/09/2022", "01/09/22", " 01/09/2022", "01/09/2022 ", None, "31/02/2022"]
    assert _one(spark, dates, D.valid_date_only) == [True, True, False, False, False, False, False]
    times = ["1:2:3", "10:20:30", " 10:20:30", "10:20", "24:00:00", None]
    assert _one(spark, times, D.valid_time_only) == [True, True, False, False, False, False]


def test_weekday_and_weekend(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 6, 0, 0),), (dt.datetime(2024, 1, 7, 0, 0),), (dt.datetime(2024, 1, 8, 0, 0),), (None,)],
        "ts timestamp_ntz",
    )
    rows = df.select(D.weekday("ts").alias("w")).select("w", D.is_weekend("w"), D.weekday_name("w")).collect()
    assert [tuple(r) for r in rows] == [(5, True, "Saturday"), (6, True, "Sunday"), (0, False, "Monday"), (None, False, None)]


def test_clean_filter(spark):
    from ridestat.plans.views import clean_trip_filter

    durations = [0.0, -1.0, 0.02, 180.0, 180.02, None]
    df = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), d) for i, d in enumerate(durations)],
        "i int, start_datetime timestamp_ntz, end_datetime timestamp_ntz, duration_minutes double",
    )
    kept = [r.i for r in df.where(clean_trip_filter()).orderBy("i").collect()]
    assert kept == [2, 3]


def test_duration_is_exact_minutes(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 1, 40))], "s timestamp_ntz, e timestamp_ntz"
    )
    assert df.select(D.duration_minutes("s", "e")).first()[0] == 100 / 60


def test_header_normalisation(spark):
    names = [" Género_Usuario ", "Fecha Arribo", "CE_retiro", "EDAD_USUARIO", "Ciclo_EstacionArribo"]
    want = ["generousuario", "fechaarribo", "ceretiro", "edadusuario", "cicloestacionarribo"]
    assert _one(spark, names, normalize_header) == want


def test_py_strip_matches_python(spark):
    vals = ["\t a \n", " b　", "c\x1f", None]
    assert _one(spark, vals, py_strip) == [None if v is None else v.strip() for v in vals]
