"""Dashboard reports over ``trips_analysis``.

Station reports aggregate on the station key first and attach names/coordinates to the few
hundred result rows afterwards. That is only equal to "join, then group by name" when
``stations.station_number`` is unique, which :class:`StationDim` measures; otherwise the
reports fall back to grouping the joined view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import avg_minutes, median_minutes, weekday_name
from ..functions.fixed import TOP_ROUTES
from ..functions.rules import age_group
from ..plans.views import trips_with_station_info
from .stations import StationDim



def _n():
    return F.count(F.lit(1))


def _avg():
    return avg_minutes().alias("avg_duration_minutes")


def monthly_trips(analysis: DataFrame) -> DataFrame:
    """Per (year, month): trips, mean and exact median duration."""
    return (
        analysis.groupBy("year", "month")
        .agg(_n().alias("total_trips"), _avg(), median_minutes().alias("median_duration_minutes"))
        .orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())
    )


def weekday_trips(analysis: DataFrame) -> DataFrame:
    return (
        analysis.groupBy("weekday")
        .agg(_n().alias("total_trips"), _avg())
        .select("weekday", weekday_name("weekday").alias("weekday_name"), "total_trips", "avg_duration_minutes")
        .orderBy(F.col("weekday").asc_nulls_last())
    )


def hourly_trips(analysis: DataFrame) -> DataFrame:
    return analysis.groupBy("hour").agg(_n().alias("total_trips"), _avg()).orderBy(F.col("hour").asc_nulls_last())


def hourly_weekday_trips(analysis: DataFrame) -> DataFrame:
    return (
        analysis.groupBy("weekday", "hour")
        .agg(_n().alias("total_trips"))
        .select("weekday", weekday_name("weekday").alias("weekday_name"), "hour", "total_trips")
        .orderBy(F.col("weekday").asc_nulls_last(), F.col("hour").asc_nulls_last())
    )


def _attach(df: DataFrame, dim: StationDim, key: str, prefix: str, with_capacity: bool = True) -> DataFrame:
    a = dim.attrs()
    cols = [
        F.col("station_number").alias(f"__key_{prefix}"),
        F.col("station_name").alias(f"{prefix}station_name"),
        F.col("latitude").alias(f"{prefix}latitude"),
        F.col("longitude").alias(f"{prefix}longitude"),
    ]
    if with_capacity:
        cols.append(F.col("capacity").alias(f"{prefix}capacity"))
    return df.join(a.select(*cols), F.col(key) == F.col(f"__key_{prefix}"), "left").drop(f"__key_{prefix}")


def _station_totals(analysis: DataFrame, dim: StationDim, role: str, total_name: str) -> DataFrame:
    key = f"{role}_station_number"
    found = F.col(f"{role}_station_found")
    names = [f"{role}_station_name", f"{role}_latitude", f"{role}_longitude", f"{role}_capacity"]
    if dim.unique:
        agg = analysis.where(found).groupBy(key).agg(_n().alias(total_name), _avg())
        out = _attach(agg, dim, key, f"{role}_")
    else:
        out = (
            trips_with_station_info(analysis, dim)
            .where(found)
            .groupBy(key, *names)
            .agg(_n().alias(total_name), _avg())
        )
    return out.select(key, *names, total_name, "avg_duration_minutes").orderBy(
        F.col(total_name).desc(), F.col(key).asc_nulls_last()
    )


def top_start_stations(analysis: DataFrame, dim: StationDim) -> DataFrame:
    """Departures per known start station, most used first (no limit)."""
    return _station_totals(analysis, dim, "start", "total_departures")


def top_end_stations(analysis: DataFrame, dim: StationDim) -> DataFrame:
    """Arrivals per known end station, most used first (no limit)."""
    return _station_totals(analysis, dim, "end", "total_arrivals")


def station_flow_balance(analysis: DataFrame, dim: StationDim) -> DataFrame:
    """Departures - arrivals per station that has departures; largest imbalance first.

    Stations with arrivals but no departures are not listed (as a left join from departures).
    With a unique catalog both counts come from one scan: every trip yields a departure row
    for its start and an arrival row for its end, aggregated map-side per station.
    """
    if dim.unique:
        roles = analysis.select(
            F.inline(
                F.array(
                    F.struct(
                        F.col("start_station_number").alias("station_number"),
                        F.col("start_station_found").alias("found"),
                        F.lit(1).alias("dep"),
                        F.lit(0).alias("arr"),
                    ),
                    F.struct(
                        F.col("end_station_number").alias("station_number"),
                        F.col("end_station_found").alias("found"),
                        F.lit(0).alias("dep"),
                        F.lit(1).alias("arr"),
                    ),
                )
            )
        )
        counts = (
            roles.where("found")
            .groupBy("station_number")
            .agg(F.sum("dep").cast("bigint").alias("total_departures"), F.sum("arr").cast("bigint").alias("__arrivals"))
            .where(F.col("total_departures") > 0)
        )
        out = _attach(counts, dim, "station_number", "", with_capacity=False)
    else:
        src = trips_with_station_info(analysis, dim)
        dep = (
            src.where("start_station_found")
            .groupBy(
                F.col("start_station_number").alias("station_number"),
                F.col("start_station_name").alias("station_name"),
                F.col("start_latitude").alias("latitude"),
                F.col("start_longitude").alias("longitude"),
            )
            .agg(_n().alias("total_departures"))
        )
        arr = (
            src.where("end_station_found")
            .groupBy(F.col("end_station_number").alias("__arr_key"))
            .agg(_n().alias("__arrivals"))
        )
        out = dep.join(arr, F.col("station_number") == F.col("__arr_key"), "left")
    arrivals = F.coalesce(F.col("__arrivals"), F.lit(0)).cast("bigint")
    net = F.col("total_departures") - arrivals
    return out.select(
        "station_number",
        "station_name",
        "latitude",
        "longitude",
        "total_departures",
        arrivals.alias("total_arrivals"),
        net.alias("net_departures"),
    ).orderBy(F.abs(F.col("net_departures")).desc(), F.col("station_number").asc_nulls_last())


def top_routes(analysis: DataFrame, dim: StationDim, n: int = TOP_ROUTES) -> DataFrame:
    """Most frequent origin -> destination pairs between known, different stations (top ``n``).

    Ties at the cut are broken by origin then destination number, then by their names (a catalog may list a number twice).
    """
    cond = (
        F.col("start_station_found")
        & F.col("end_station_found")
        & (F.col("start_station_number") != F.col("end_station_number"))
    )
    keys = ["start_station_number", "end_station_number"]
    order = [F.col("total_trips").desc(), F.col(keys[0]).asc_nulls_last(), F.col(keys[1]).asc_nulls_last()]
    by_name = [F.col(f"{role}_station_name").asc_nulls_last() for role in ("start", "end")]
    if dim.unique:
        top = analysis.where(cond).groupBy(*keys).agg(_n().alias("total_trips"), _avg()).orderBy(*order).limit(n)
        a = dim.attrs()
        for role in ("start", "end"):
            side = a.select(
                F.col("station_number").alias(f"__{role}_k"), F.col("station_name").alias(f"{role}_station_name")
            )
            top = top.join(side, F.col(f"{role}_station_number") == F.col(f"__{role}_k"), "left").drop(
                f"__{role}_k"
            )
    else:
        top = (
            trips_with_station_info(analysis, dim)
            .where(cond)
            .groupBy("start_station_number", "start_station_name", "end_station_number", "end_station_name")
            .agg(_n().alias("total_trips"), _avg())
            .orderBy(*order, *by_name)
            .limit(n)
        )
    return top.select(
        "start_station_number",
        "start_station_name",
        "end_station_number",
        "end_station_name",
        "total_trips",
        "avg_duration_minutes",
    ).orderBy(*order, *by_name)


def user_profile_summary(analysis: DataFrame) -> DataFrame:
    """Trips and mean duration per (gender, age group)."""
    return (
        analysis.select("gender", age_group("age").alias("age_group"), "duration_minutes")
        .groupBy("gender", "age_group")
        .agg(_n().alias("total_trips"), _avg())
        .orderBy(F.col("gender").asc_nulls_last(), F.col("age_group").asc_nulls_last())
    )


# ---- dashboard figures described for the BI pages (marginals of the reports above) ---------


def headline(analysis: DataFrame) -> DataFrame:
    """Total clean trips and average duration."""
    return analysis.agg(_n().alias("total_trips"), _avg())


def weekday_weekend(analysis: DataFrame) -> DataFrame:
    """Weekday vs weekend comparison."""
    return (
        analysis.groupBy("is_weekend")
        .agg(_n().alias("total_trips"), _avg())
        .orderBy(F.col("is_weekend").asc_nulls_last())
    )


def station_capacity_demand(analysis: DataFrame, dim: StationDim) -> DataFrame:
    """Departures per dock: top start stations with ``total_departures / start_capacity``."""
    t = top_start_stations(analysis, dim)
    return t.withColumn(
        "departures_per_dock", F.try_divide(F.col("total_departures"), F.col("start_capacity"))
    ).orderBy(F.col("total_departures").desc(), F.col("start_station_number").asc_nulls_last())


def trips_by_gender(analysis: DataFrame) -> DataFrame:
    return (
        analysis.groupBy("gender")
        .agg(_n().alias("total_trips"), _avg())
        .orderBy(F.col("gender").asc_nulls_last())
    )


def trips_by_age_group(analysis: DataFrame) -> DataFrame:
    return (
        analysis.groupBy(age_group("age").alias("age_group"))
        .agg(_n().alias("total_trips"), _avg())
        .orderBy(F.col("age_group").asc_nulls_last())
    )


def net_flow_summary(flow: DataFrame) -> DataFrame:
    """Stations with positive / negative / zero net departures, from the flow balance."""
    s = F.signum(F.col("net_departures"))
    label = F.when(s > 0, F.lit("positive")).when(s < 0, F.lit("negative")).otherwise(F.lit("balanced"))
    return (
        flow.groupBy(label.alias("flow_direction"))
        .agg(_n().alias("stations"), F.sum("net_departures").alias("total_net_departures"))
        .orderBy("flow_direction")
    )
