"""Randomised agreement with pandas parsing semantics (the behaviour the rules reproduce)."""

import random
import warnings

import pandas as pd
from pyspark.sql import functions as F

from ridestat.functions import datetimes as D
from ridestat.functions import rules as R

N = 3000


def _num(rnd, lo, hi, pad):
    v = rnd.randint(lo, hi)
    return f"{v:02d}" if pad and rnd.random() < 0.7 else str(v)


def _datetime_texts(rnd):
    out = []
    for _ in range(N):
        d, m = _num(rnd, 0, 33, True), _num(rnd, 0, 13, True)
        y = rnd.choice([str(rnd.randint(1600, 2300)), f"{rnd.randint(0, 99):02d}", str(rnd.randint(0, 9)),
                        f"{rnd.randint(0, 99):03d}"])
        hh, mm, ss = _num(rnd, 0, 25, True), _num(rnd, 0, 61, True), _num(rnd, 0, 62, True)
        date = f"{d}/{m}/{y}"
        time = f"{hh}:{mm}:{ss}"
        r = rnd.random()
        if r < 0.05:
            time = f"{hh}:{mm}"
        elif r < 0.08:
            date = date.replace("/", "-")
        elif r < 0.10:
            date = " " + date + "  "
        elif r < 0.12:
            date = None
        out.append((date, time))
    return out


def _pandas_parse(dates, times):
    txt = pd.Series(dates, dtype=object).astype(str).str.strip() + " " + pd.Series(times, dtype=object).astype(str).str.strip()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        first = pd.to_datetime(txt, format="%d/%m/%Y %H:%M:%S", errors="coerce")
        second = pd.to_datetime(txt, format="%d/%m/%y %H:%M:%S", errors="coerce")
    return first.fillna(second)


def test_trip_datetime_matches_pandas(spark):
    rnd = random.Random(11)
    rows = _datetime_texts(rnd)
    want = _pandas_parse([d for d, _ in rows], [t for _, t in rows])
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "i int, d string, t string")
    got = [r[0] for r in df.orderBy("i").select(D.parse_trip_datetime("d", "t")).collect()]
    bad = [
        (rows[i], got[i], want.iloc[i])
        for i in range(N)
        if not ((got[i] is None and pd.isna(want.iloc[i])) or (got[i] is not None and got[i] == want.iloc[i]))
    ]
    assert not bad, bad[:10]
    assert sum(g is not None for g in got) > N // 4  # the sample exercises both outcomes


def test_date_only_validity_matches_pandas(spark):
    rnd = random.Random(5)
    texts = [d for d, _ in _datetime_texts(rnd)]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = pd.to_datetime(pd.Series(texts, dtype=object), format="%d/%m/%Y", errors="coerce").notna().tolist()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(D.valid_date_only("t")).collect()]
    bad = [(texts[i], got[i], want[i]) for i in range(len(texts)) if got[i] != want[i]]
    assert not bad, bad[:10]


def test_time_only_validity_matches_pandas(spark):
    rnd = random.Random(6)
    texts = [t for _, t in _datetime_texts(rnd)] + ["1:2:3", " 10:20:30", "10:20:61", "10:20:62", None]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = pd.to_datetime(pd.Series(texts, dtype=object), format="%H:%M:%S", errors="coerce").notna().tolist()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(D.valid_time_only("t")).collect()]
    bad = [(texts[i], got[i], want[i]) for i in range(len(texts)) if got[i] != want[i]]
    assert not bad, bad[:10]


def test_age_matches_numeric_coercion(spark):
    rnd = random.Random(9)
    pool = ["34", "34.0", " 34 ", "1e2", "-5", "abc", "", "007", "+12", "12.", ".5e1", "1,000", "0x10", "NaN", "inf"]
    texts = [rnd.choice(pool) if rnd.random() < 0.5 else str(rnd.randint(-20, 120)) for _ in range(N)]
    num = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    # integral finite values must agree; the rest are null here (the source aborts on them)
    want = [int(v) if pd.notna(v) and float(v).is_integer() else None for v in num]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(R.age("t")).collect()]
    bad = [(texts[i], got[i], want[i]) for i in range(N) if got[i] != want[i]]
    assert not bad, bad[:10]


STATION_KEYS = [
    (None, ""), ("", ""), ("  ", ""), ("072", "72"), ("72", "72"), ("72.0", "72"), (" 072.0 ", "72"), ("000", "0"),
    ("0.0", "0"), (".0", ""), ("390-391", "390-391"), ("72.5", "72.5"), ("72.00", "72.00"), ("a.0", "a"), ("0a", "0a"),
    ("7 2", "7 2"), ("\t5\n", "5"), ("-5", "-5"), ("1.0.0", "1.0"), ("00123456789012345678901", "123456789012345678901"),
]
GENDERS = [
    (None, "?"), ("m", "M"), ("M", "M"), (" f ", "F"), ("F", "F"), ("o", "O"), ("O", "O"), ("?", "?"), ("x", "?"),
    ("", "?"), ("  ", "?"), ("MF", "?"), ("\tm\n", "M"), ("male", "?"), ("0", "?"),
]
AGES = [
    ("34", 34), ("34.0", 34), (" 34 ", 34), ("1e2", 100), ("+5", 5), ("-1", -1), ("34d", None), ("34f", None), ("34D", None),
    ("3L", None), ("0x1A", None), ("34.5", None), ("", None), ("abc", None), ("NaN", None), ("Infinity", None), (None, None),
]


def _applied(spark, rule, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("t"))).collect()]


def test_station_keys(spark):
    assert _applied(spark, R.station_key, [t for t, _ in STATION_KEYS]) == [k for _, k in STATION_KEYS]


def test_genders(spark):
    assert _applied(spark, R.gender, [t for t, _ in GENDERS]) == [g for _, g in GENDERS]


def test_ages_have_no_number_suffixes(spark):
    assert _applied(spark, R.age, [t for t, _ in AGES]) == [a for _, a in AGES]


def test_dirty_dates_and_times_do_not_stop_a_query(spark):
    texts = ["abc", "3", "01/2022", "", None, "10", "x", "01/02/2022", "31/02/2022", "1/2/3/4/5"]
    assert _applied(spark, D.valid_date_only, texts) == [t == "01/02/2022" for t in texts]
    times = ["10", "x", "", None, "10:20", "10:20:30", "25:00:00", "::"]
    assert _applied(spark, D.valid_time_only, times) == [t == "10:20:30" for t in times]
