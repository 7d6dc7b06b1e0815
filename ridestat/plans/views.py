"""The two analysis views: ``trips_analysis`` and ``trips_with_station_info``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CLEAN_MAX_INCLUSIVE, CLEAN_MIN_EXCLUSIVE
from ..operators.stations import StationDim


def clean_trip_filter() -> F.Column:
    """Both datetimes present and 0 < duration <= 180 minutes."""
    d = F.col("duration_minutes")
    return (
        F.col("start_datetime").isNotNull()
        & F.col("end_datetime").isNotNull()
        & (d > CLEAN_MIN_EXCLUSIVE)
        & (d <= CLEAN_MAX_INCLUSIVE)
    )


def trips_analysis(trips_clean: DataFrame) -> DataFrame:
    """Clean trips only. On a year/month-partitioned table the folder without a date is not opened."""
    return trips_clean.where(F.col("year").isNotNull() & clean_trip_filter())


def _station_side(dim: StationDim, role: str) -> DataFrame:
    a = dim.attrs()
    return a.select(
        F.col("station_number").alias(f"__{role}_key"),
        F.col("station_name").alias(f"{role}_station_name"),
        F.col("latitude").alias(f"{role}_latitude"),
        F.col("longitude").alias(f"{role}_longitude"),
        F.col("capacity").alias(f"{role}_capacity"),
    )


def trips_with_station_info(analysis: DataFrame, dim: StationDim) -> DataFrame:
    """Clean trips with start/end station name, coordinates and capacity (two left joins).

    Both station sides are broadcast when the catalog's measured size allows it, so the view
    adds no shuffle. A station number listed twice in the catalog repeats the trip, exactly as
    a plain left join does.
    """
    out = analysis
    for role in ("start", "end"):
        side = _station_side(dim, role)
        out = out.join(side, F.col(f"{role}_station_number") == F.col(f"__{role}_key"), "left").drop(
            f"__{role}_key"
        )
    return out


def register_views(spark: SparkSession, trips_clean: DataFrame, dim: StationDim) -> None:
    """Replaceable temp views for SQL users: trips_clean, stations, and the two analysis views."""
    trips_clean.createOrReplaceTempView("trips_clean")
    dim.table.createOrReplaceTempView("stations")
    analysis = trips_analysis(trips_clean)
    analysis.createOrReplaceTempView("trips_analysis")
    trips_with_station_info(analysis, dim).createOrReplaceTempView("trips_with_station_info")
