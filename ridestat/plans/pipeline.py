"""End-to-end jobs over landed files: catalog, load, quality, validation, triage, exports.

Each job is a plain function over a SparkSession and folder paths; tables are Parquet under
one database folder (``<db>/stations``, ``<db>/trips_clean`` partitioned by year/month).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import TRIPS_CLEAN_COLUMNS
from ..operators import demand, quality, stations, triage, validation
from ..operators.clean import clean_trips
from ..operators.stations import StationDim, as_stations_table, clean_station_information
from ..sinks.csv import write_csv
from ..sinks.tables import read_table, write_table
from ..sources import gbfs, trip_csv
from ..sources.presence import require_inputs
from ..sources.stations_csv import read_station_catalog, write_station_catalog
from .views import register_views, trips_analysis


# ---- station catalog ----------------------------------------------------------------------


def build_station_catalog(
    spark: SparkSession,
    station_information_json: str,
    catalog_csv: str,
    raw_dir: str | None = None,
    discovery_json: str | None = None,
    language: str = "es",
) -> DataFrame:
    """Landed GBFS JSON -> cleaned catalog CSV (+ raw snapshot); returns the catalog summary with the feed's UTC time."""
    if discovery_json:
        gbfs.feed_url(spark, discovery_json, "station_information", language)  # feed must be listed
    if raw_dir:
        gbfs.save_raw_snapshot(spark, station_information_json, raw_dir)
    catalog = clean_station_information(gbfs.station_records(spark, station_information_json))
    write_station_catalog(catalog, catalog_csv)
    updated = gbfs.feed_last_updated(spark, station_information_json).agg(F.max("last_updated_utc")).first()[0]
    summary = stations.station_catalog_summary(read_station_catalog(spark, catalog_csv))
    return summary.withColumn("feed_last_updated_utc", F.lit(updated).cast("timestamp_ntz"))


# ---- load -----------------------------------------------------------------------------------


@dataclass
class Database:
    spark: SparkSession
    root: str
    _dim: StationDim | None = field(default=None, repr=False)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def stations(self) -> DataFrame:
        return read_table(self.spark, self.path("stations"))

    def dim(self) -> StationDim:
        """Stations plus their measured size / key uniqueness (measured once per handle)."""
        if self._dim is None:
            self._dim = StationDim.of(self.stations())
        return self._dim

    def trips(self) -> DataFrame:
        return read_table(self.spark, self.path("trips_clean")).select(*TRIPS_CLEAN_COLUMNS)

    def analysis(self) -> DataFrame:
        return trips_analysis(self.trips())

    def register(self) -> None:
        """``trips_clean``, ``stations``, ``trips_analysis``, ``trips_with_station_info`` temp views."""
        register_views(self.spark, self.trips(), self.dim())


def build_database(spark: SparkSession, trips_source: str | list[str], catalog_csv: str, db_root: str) -> DataFrame:
    """Raw monthly CSVs + catalog CSV -> ``stations`` and ``trips_clean`` tables.

    Returns the post-load validation row. An input that is not there raises an error naming it. Files missing a canonical column stop the load, as does a
    row with more fields than its header.
    """
    require_inputs(spark, trips_source, catalog_csv)
    db = Database(spark, db_root)
    catalog = read_station_catalog(spark, catalog_csv)
    write_table(as_stations_table(catalog), db.path("stations"))
    raw = trip_csv.read_raw_trips(spark, trips_source, require_all_columns=True)
    trips = clean_trips(raw, db.dim())
    # monthly files read split by split: each task holds one or two start months, so the
    # partitioned write needs no shuffle (pass cluster_by for unclustered inputs)
    write_table(trips, db.path("trips_clean"), partition_by=["year", "month"])
    return quality.load_validation(db.trips())


# ---- quality ------------------------------------------------------------------------------


def quality_report(spark: SparkSession, db_root: str, out_dir: str) -> dict[str, DataFrame]:
    db = Database(spark, db_root)
    by_file = quality.quality_by_file(db.trips())
    write_csv(by_file, f"{out_dir}/quality_by_file", bom=True)
    return {
        "quality_summary": quality.quality_summary(db.trips()),
        "quality_by_file": by_file,
        "top_invalid_start_files": quality.top_invalid_start_files(by_file),
        "clean_summary": quality.clean_summary(db.analysis()),
    }


# ---- validation of raw files ------------------------------------------------------------


def audit_trip_files(spark: SparkSession, trips_source: str | list[str], out_dir: str) -> DataFrame:
    require_inputs(spark, trips_source)
    report = trip_csv.audit_report(trip_csv.audit_headers(spark, trips_source))
    write_csv(report, f"{out_dir}/csv_columns_audit", bom=True)
    return report


def _raw_for_validation(spark: SparkSession, trips_source, with_row_index: bool = False, audit: DataFrame | None = None) -> DataFrame:
    return trip_csv.read_raw_trips(spark, trips_source, audit, require_all_columns=False, with_row_index=with_row_index)


def validate_trip_files(
    spark: SparkSession, trips_source: str | list[str], catalog_csv: str, out_dir: str
) -> dict[str, DataFrame]:
    require_inputs(spark, trips_source, catalog_csv)
    dim = StationDim.of(as_stations_table(read_station_catalog(spark, catalog_csv)))
    audit = trip_csv.audit_headers(spark, trips_source).checkpoint()  # one row per file, read several times
    raw = _raw_for_validation(spark, trips_source, with_row_index=True, audit=audit)
    write_table(validation.file_and_station_counts(raw, dim), f"{out_dir}/file_and_station_counts")  # the one pass over the rows
    counts = read_table(spark, f"{out_dir}/file_and_station_counts")
    summary = validation.files_summary_of(counts, audit.select("file"))
    missing = validation.missing_stations_of(counts)
    write_csv(summary, f"{out_dir}/historical_files_summary", bom=True)
    write_csv(missing, f"{out_dir}/missing_stations_summary", bom=True)
    return {
        "summary": summary,
        "missing": missing,
        "totals": validation.validation_totals(summary),
        "schema": trip_csv.schema_table(audit),
        "malformed": trip_csv.malformed_rows(raw, audit.select("file")),
    }


def missing_station_report(
    spark: SparkSession, trips_source: str | list[str], catalog_csv: str, out_dir: str
) -> dict[str, DataFrame]:
    require_inputs(spark, trips_source, catalog_csv)
    dim = StationDim.of(as_stations_table(read_station_catalog(spark, catalog_csv)))
    audit = trip_csv.audit_headers(spark, trips_source).checkpoint()  # one row per file, read several times
    raw = _raw_for_validation(spark, trips_source, audit=audit)
    write_table(validation.file_and_station_counts(raw, dim, ()), f"{out_dir}/station_counts")  # the one pass over the rows
    counts = read_table(spark, f"{out_dir}/station_counts")
    usage = validation.usage_of(counts)
    by_file = validation.usage_by_file_of(counts, audit.select("file"))
    write_csv(usage, f"{out_dir}/missing_station_usage", bom=True)
    write_csv(by_file, f"{out_dir}/missing_station_usage_by_file", bom=True)
    return {
        "usage": usage,
        "by_file": by_file,
        "totals": validation.missing_totals_of(counts),
        "top": validation.top_missing_stations(usage),
    }


def triage_datetimes(spark: SparkSession, trips_file: str | list[str], out_dir: str, tag: str) -> dict[str, DataFrame]:
    """Datetime triage of one month (or any files): summary, samples, value counts, describe."""
    require_inputs(spark, trips_file)
    raw = _raw_for_validation(spark, trips_file, with_row_index=True)
    sample = triage.invalid_datetime_sample(raw)
    longest = triage.longest_trips(raw)
    write_csv(sample, f"{out_dir}/invalid_datetime_{tag}_sample", bom=True)
    write_csv(longest, f"{out_dir}/longest_trips_{tag}", bom=True)
    return {
        "summary": triage.datetime_triage_summary(raw),
        "value_counts": triage.invalid_start_value_counts(raw),
        "describe": triage.duration_describe(raw),
        "sample": sample,
        "longest": longest,
    }


# ---- dashboard exports ----------------------------------------------------------------------

EXPORTS = {
    "monthly_trips": lambda counts, dim: demand.monthly_trips(counts),
    "weekday_trips": lambda counts, dim: demand.weekday_trips(counts),
    "hourly_trips": lambda counts, dim: demand.hourly_trips(counts),
    "hourly_weekday_trips": lambda counts, dim: demand.hourly_weekday_trips(counts),
    "top_start_stations": demand.top_start_stations,
    "top_end_stations": demand.top_end_stations,
    "station_flow_balance": demand.station_flow_balance,
    "top_routes": demand.top_routes,
    "user_profile_summary": lambda counts, dim: demand.user_profile_summary(counts),
}


def export_dashboards(spark: SparkSession, db_root: str, out_dir: str) -> dict[str, str]:
    """The nine dashboard datasets as CSV folders (each one sorted part file), from one pass over the trips.

    The pass leaves its counts as the table ``demand_counts`` beside the trips.
    """
    db = Database(spark, db_root)
    write_table(demand.demand_counts(db.analysis()), db.path("demand_counts"))
    counts = read_table(spark, db.path("demand_counts"))
    return {name: write_csv(fn(counts, db.dim()), f"{out_dir}/{name}") for name, fn in EXPORTS.items()}


__all__ = [
    "Database",
    "build_station_catalog",
    "build_database",
    "quality_report",
    "audit_trip_files",
    "validate_trip_files",
    "missing_station_report",
    "triage_datetimes",
    "export_dashboards",
]
