"""The dashboard datasets from one scan of ``trips_analysis``.

:func:`demand_counts` counts the clean trips and sums their whole seconds by month and duration, by weekday and
hour, by route and by rider profile in one aggregate with partial sums before its shuffle. A clean trip lasts
three hours at most, so a month has 10,800 durations at most, and the counts stay small beside the trips. Every
dataset is then a roll-up of that table: the median of a month is the percentile of its durations weighted by
their counts, and station names meet routes instead of trips. Joins come before the final grouping, so a catalog
that repeats a station number multiplies routes as the joined view multiplies trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import duration_seconds, weekday_name
from ..functions.fixed import TOP_ROUTES
from ..functions.rules import age_group
from ..plans.views import trips_with_station_info
from .stations import StationDim

#: What the counts are about, and the columns that tell its groups apart.
SUBJECTS = {
    "month": ["year", "month", "seconds"],
    "hour": ["weekday", "hour"],
    "route": ["start_station_number", "end_station_number", "start_station_found", "end_station_found"],
    "profile": ["gender", "age_group"],
}
KEYS = [c for columns in SUBJECTS.values() for c in columns]


def demand_counts(analysis: DataFrame) -> DataFrame:
    """(subject, keys of all subjects, trips, total_seconds); keys of other subjects are null."""
    seconds = duration_seconds("duration_minutes").cast("bigint")
    plain = [c for c in KEYS if c not in ("seconds", "age_group")]
    rows = analysis.select(*plain, age_group("age").alias("age_group"), seconds.alias("seconds"), seconds.alias("lasted"))
    # a bit of grouping_id is set for each key that a subject does not have
    ids = {name: sum(1 << (len(KEYS) - 1 - i) for i, c in enumerate(KEYS) if c not in columns) for name, columns in SUBJECTS.items()}
    subject = F.coalesce(*[F.when(F.col("__set") == i, F.lit(name)) for name, i in ids.items()])
    counts = rows.groupingSets([[F.col(c) for c in columns] for columns in SUBJECTS.values()], *KEYS).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("trips"), F.coalesce(F.sum("lasted"), F.lit(0)).alias("total_seconds")
    )
    return counts.select(subject.alias("subject"), *KEYS, "trips", "total_seconds")


def _of(counts: DataFrame, subject: str) -> DataFrame:
    return counts.where(F.col("subject") == subject).select(*SUBJECTS[subject], "trips", "total_seconds")


def _trips(name: str = "total_trips") -> F.Column:
    return F.sum("trips").alias(name)


def _avg() -> F.Column:
    mean = F.sum("total_seconds").cast("double") / (F.sum("trips") * F.lit(60)).cast("double")
    return mean.alias("avg_duration_minutes")


def _last(*names: str) -> list[F.Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def monthly_trips(counts: DataFrame) -> DataFrame:
    median = F.percentile("seconds", F.lit(0.5), F.col("trips")) / F.lit(60.0)
    out = _of(counts, "month").groupBy("year", "month").agg(_trips(), _avg(), median.alias("median_duration_minutes"))
    return out.orderBy(*_last("year", "month"))


def weekday_trips(counts: DataFrame) -> DataFrame:
    out = _of(counts, "hour").groupBy("weekday").agg(_trips(), _avg())
    return out.select("weekday", weekday_name("weekday").alias("weekday_name"), "total_trips", "avg_duration_minutes").orderBy(*_last("weekday"))


def hourly_trips(counts: DataFrame) -> DataFrame:
    return _of(counts, "hour").groupBy("hour").agg(_trips(), _avg()).orderBy(*_last("hour"))


def hourly_weekday_trips(counts: DataFrame) -> DataFrame:
    out = _of(counts, "hour").select("weekday", weekday_name("weekday").alias("weekday_name"), "hour", F.col("trips").alias("total_trips"))
    return out.orderBy(*_last("weekday", "hour"))


def user_profile_summary(counts: DataFrame) -> DataFrame:
    return _of(counts, "profile").groupBy("gender", "age_group").agg(_trips(), _avg()).orderBy(*_last("gender", "age_group"))


def _named_routes(counts: DataFrame, dim: StationDim) -> DataFrame:
    return trips_with_station_info(_of(counts, "route"), dim)


def _station_totals(counts: DataFrame, dim: StationDim, role: str, total: str) -> DataFrame:
    columns = [f"{role}_{c}" for c in ("station_number", "station_name", "latitude", "longitude", "capacity")]
    out = _named_routes(counts, dim).where(f"{role}_station_found").groupBy(*columns).agg(_trips(total), _avg())
    return out.orderBy(F.col(total).desc(), *_last(columns[0]))


def top_start_stations(counts: DataFrame, dim: StationDim) -> DataFrame:
    return _station_totals(counts, dim, "start", "total_departures")


def top_end_stations(counts: DataFrame, dim: StationDim) -> DataFrame:
    return _station_totals(counts, dim, "end", "total_arrivals")


def station_flow_balance(counts: DataFrame, dim: StationDim) -> DataFrame:
    """Departures and arrivals per catalog row of a station that has departures; largest imbalance first."""
    routes = _named_routes(counts, dim)
    start = [F.col(f"start_{c}").alias(c) for c in ("station_number", "station_name", "latitude", "longitude")]
    left = routes.where("start_station_found").groupBy(*start).agg(_trips("total_departures"))
    came = routes.where("end_station_found").groupBy(F.col("end_station_number").alias("station_number")).agg(_trips("arrivals"))
    arrivals = F.coalesce("arrivals", F.lit(0).cast("bigint"))
    out = left.join(came, "station_number", "left").select(
        "station_number", "station_name", "latitude", "longitude", "total_departures",
        arrivals.alias("total_arrivals"), (F.col("total_departures") - arrivals).alias("net_departures"),
    )
    return out.orderBy(F.abs("net_departures").desc(), *_last("station_number"))


def top_routes(counts: DataFrame, dim: StationDim, n: int = TOP_ROUTES) -> DataFrame:
    columns = ["start_station_number", "start_station_name", "end_station_number", "end_station_name"]
    routes = _named_routes(counts, dim).where("start_station_found AND end_station_found AND start_station_number <> end_station_number")
    out = routes.groupBy(*columns).agg(_trips(), _avg())
    names = "start_station_number", "end_station_number", "start_station_name", "end_station_name"
    return out.orderBy(F.col("total_trips").desc(), *_last(*names)).limit(n)
