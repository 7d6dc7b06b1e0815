"""Data-quality aggregates over ``trips_clean`` / ``trips_analysis`` (one partial+final agg each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import avg_minutes
from ..functions.fixed import LONG_TRIP_MINUTES, TOP_INVALID_FILES, VERY_LONG_TRIP_MINUTES

def _s():
    return F.col("start_datetime")


def _e():
    return F.col("end_datetime")


def _d():
    return F.col("duration_minutes")


def _n():
    return F.count(F.lit(1))


def _missing(role: str):
    return F.count_if(F.col(f"{role}_station_found") == F.lit(False))


def quality_summary(trips: DataFrame) -> DataFrame:
    """One row, ten metrics over every loaded trip."""
    return trips.agg(
        _n().alias("total_trips"),
        F.count_if(_s().isNull()).alias("invalid_start_datetime"),
        F.count_if(_e().isNull()).alias("invalid_end_datetime"),
        F.count_if(_s().isNotNull() & _e().isNotNull()).alias("valid_datetime_trips"),
        F.count_if(_d() < 0).alias("negative_duration_trips"),
        F.count_if(_d() == 0).alias("zero_duration_trips"),
        F.count_if(_d() > LONG_TRIP_MINUTES).alias("trips_over_3_hours"),
        F.count_if(_d() > VERY_LONG_TRIP_MINUTES).alias("trips_over_24_hours"),
        _missing("start").alias("missing_start_station_trips"),
        _missing("end").alias("missing_end_station_trips"),
    )


def quality_by_file(trips: DataFrame) -> DataFrame:
    """Per source file: totals and the problem counts, ordered by file name."""
    return (
        trips.groupBy("source_file")
        .agg(
            _n().alias("total_trips"),
            F.count_if(_s().isNull()).alias("invalid_start_datetime"),
            F.count_if(_e().isNull()).alias("invalid_end_datetime"),
            F.count_if(_d() < 0).alias("negative_duration_trips"),
            F.count_if(_d() > LONG_TRIP_MINUTES).alias("trips_over_3_hours"),
            _missing("start").alias("missing_start_station_trips"),
            _missing("end").alias("missing_end_station_trips"),
        )
        .orderBy(F.col("source_file").asc_nulls_last())
    )


def top_invalid_start_files(by_file: DataFrame, n: int = TOP_INVALID_FILES) -> DataFrame:
    """Files with the most invalid start datetimes (ties by file name)."""
    return by_file.orderBy(F.col("invalid_start_datetime").desc(), F.col("source_file").asc_nulls_last()).limit(n)


def load_validation(trips: DataFrame) -> DataFrame:
    """The six checks printed right after a load."""
    return trips.agg(
        _n().alias("total_trips"),
        F.count_if(_s().isNull()).alias("invalid_start_datetime"),
        F.count_if(_e().isNull()).alias("invalid_end_datetime"),
        F.count_if(_d() < 0).alias("negative_duration_trips"),
        _missing("start").alias("missing_start_station_trips"),
        _missing("end").alias("missing_end_station_trips"),
    )


def clean_summary(analysis: DataFrame) -> DataFrame:
    """Clean-trip count, missing stations among them, start range and average duration."""
    return analysis.agg(
        _n().alias("clean_trips"),
        _missing("start").alias("clean_missing_start_station"),
        _missing("end").alias("clean_missing_end_station"),
        F.min(_s()).alias("min_start_datetime"),
        F.max(_s()).alias("max_start_datetime"),
        avg_minutes().alias("avg_duration_minutes"),
    )
