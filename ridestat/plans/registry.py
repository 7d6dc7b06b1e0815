"""Registered queries: name -> (spark, sf_dir) -> DataFrame, over the driver's tables.

Each query opens the :class:`~ridestat.plans.store.TripStore` for the folder (built from the
folder's tables on first use) and runs one operator over the stored tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CANONICAL_COLUMNS
from ..functions.rules import age, gender, station_key
from ..operators import quality, reports, stations, triage, validation
from ..plans.views import trips_with_station_info
from ..sinks.csv import read_report_csv
from ..sources import gbfs, trip_csv
from ..sources.presence import input_presence
from .store import TripStore

Query = Callable[[SparkSession, str], DataFrame]


def _on_store(fn: Callable[[TripStore], DataFrame], doc: str = "") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(TripStore(spark, sf_dir))

    run.__doc__ = doc
    return run


def _raw(s: TripStore) -> DataFrame:
    return s.raw().select("source_file", "row_index", *CANONICAL_COLUMNS)


def _station_key_map(s: TripStore) -> DataFrame:
    """Raw station text -> normalised key and catalog match, with trip counts (both roles)."""
    raw = s.raw()
    pairs = F.array(
        F.struct(F.lit("start").alias("role"), F.col("Ciclo_Estacion_Retiro").alias("raw_value")),
        F.struct(F.lit("end").alias("role"), F.col("Ciclo_EstacionArribo").alias("raw_value")),
    )
    keyed = raw.select(F.inline(pairs)).withColumn("station_key", station_key("raw_value"))
    counts = keyed.groupBy("role", "raw_value", "station_key").agg(F.count(F.lit(1)).alias("trips"))
    keys = s.dim().keys().select(F.col("station_key").alias("__k"), F.lit(True).alias("__hit"))
    return (
        counts.join(keys, F.col("station_key") == F.col("__k"), "left")
        .select("role", "raw_value", "station_key", F.coalesce("__hit", F.lit(False)).alias("found"), "trips")
        .orderBy("role", "raw_value")
    )


def _value_map(raw_col: str, out_col: str, rule) -> Callable[[TripStore], DataFrame]:
    def fn(s: TripStore) -> DataFrame:
        return (
            s.raw()
            .groupBy(F.col(raw_col).alias("raw_value"))
            .agg(F.count(F.lit(1)).alias("trips"))
            .select("raw_value", rule("raw_value").alias(out_col), "trips")
            .orderBy(F.col("raw_value").asc_nulls_first())
        )

    return fn


def _schema_diff(s: TripStore) -> DataFrame:
    """Missing and extra columns of every landed file, as text."""
    table = trip_csv.schema_table(trip_csv.audit_headers(s.spark, s.csv_files()).checkpoint())
    return table.select("file", *[F.array_join(c, " | ").alias(c) for c in ("missing_columns", "extra_columns")])


def _csv_files_summary(s: TripStore) -> DataFrame:
    """The validation summary over the dirty files, those without rows included."""
    raw, files = s.dirty_raw()
    return validation.historical_files_summary(raw, s.dim(), files)


def _input_presence(s: TripStore) -> DataFrame:
    """The months of the trips and one more against the files of the dirty folder, which holds a file of no month."""
    expected = s.raw().select(F.col("source_file").alias("file")).unionByName(s.spark.createDataFrame([("2099-02.csv",)], "file string"))
    return input_presence(s.spark, s.dirty_csv(), expected)


def _exported(name: str, like: Callable[[TripStore], DataFrame]) -> Query:
    """The CSV file of a report as its job wrote it, with the column types of the report."""

    def fn(s: TripStore) -> DataFrame:
        text = read_report_csv(s.spark, s.report_file(name))
        return text.select(*[F.col(f.name).cast(f.dataType) for f in like(s).schema])

    return _on_store(fn)


QUERIES: dict[str, Query] = {
    # ---- load: trips_clean and the station tables ----------------------------------------
    "trips_clean": _on_store(lambda s: s.trips(), "20-column fact table built from raw trips"),
    "station_catalog": _on_store(lambda s: s.catalog(), "cleaned GBFS station catalog"),
    "stations_table": _on_store(lambda s: s.stations(), "stations table (normalised keys)"),
    "station_catalog_summary": _on_store(lambda s: stations.station_catalog_summary(s.catalog())),
    "station_key_map": _on_store(_station_key_map),
    "gender_map": _on_store(_value_map("Genero_Usuario", "gender", gender)),
    "age_map": _on_store(_value_map("Edad_Usuario", "age", age)),
    # ---- landed GBFS documents -------------------------------------------------------------
    "gbfs_feed_lookup": _on_store(lambda s: gbfs.feed_lookup(s.spark, s.gbfs()[0])),
    "gbfs_station_records": _on_store(lambda s: gbfs.station_records(s.spark, s.gbfs()[1])),
    "gbfs_station_catalog": _on_store(lambda s: stations.clean_station_information(gbfs.station_records(s.spark, s.gbfs()[1]))),
    "raw_snapshots": _on_store(lambda s: gbfs.raw_snapshots(s.spark, s.gbfs()[2])),
    # ---- quality -------------------------------------------------------------------------
    "load_validation": _on_store(lambda s: quality.load_validation(s.trips())),
    "quality_summary": _on_store(lambda s: quality.quality_summary(s.trips())),
    "quality_by_file": _on_store(lambda s: quality.quality_by_file(s.trips())),
    "top_invalid_start_files": _on_store(lambda s: quality.top_invalid_start_files(quality.quality_by_file(s.trips()))),
    "clean_summary": _on_store(lambda s: quality.clean_summary(s.analysis())),
    # ---- views ---------------------------------------------------------------------------
    "trips_analysis": _on_store(lambda s: s.analysis()),
    "trips_with_station_info": _on_store(lambda s: trips_with_station_info(s.analysis(), s.dim())),
    # ---- dashboard exports ---------------------------------------------------------------
    "monthly_trips": _on_store(lambda s: reports.monthly_trips(s.analysis())),
    "weekday_trips": _on_store(lambda s: reports.weekday_trips(s.analysis())),
    "hourly_trips": _on_store(lambda s: reports.hourly_trips(s.analysis())),
    "hourly_weekday_trips": _on_store(lambda s: reports.hourly_weekday_trips(s.analysis())),
    "top_start_stations": _on_store(lambda s: reports.top_start_stations(s.analysis(), s.dim())),
    "top_end_stations": _on_store(lambda s: reports.top_end_stations(s.analysis(), s.dim())),
    "station_flow_balance": _on_store(lambda s: reports.station_flow_balance(s.analysis(), s.dim())),
    "top_routes": _on_store(lambda s: reports.top_routes(s.analysis(), s.dim())),
    "user_profile_summary": _on_store(lambda s: reports.user_profile_summary(s.analysis())),
    # ---- dashboard figures ---------------------------------------------------------------
    "headline": _on_store(lambda s: reports.headline(s.analysis())),
    "weekday_weekend": _on_store(lambda s: reports.weekday_weekend(s.analysis())),
    "station_capacity_demand": _on_store(lambda s: reports.station_capacity_demand(s.analysis(), s.dim())),
    "trips_by_gender": _on_store(lambda s: reports.trips_by_gender(s.analysis())),
    "trips_by_age_group": _on_store(lambda s: reports.trips_by_age_group(s.analysis())),
    "net_flow_summary": _on_store(
        lambda s: reports.net_flow_summary(reports.station_flow_balance(s.analysis(), s.dim()))
    ),
    # ---- validation of raw files ---------------------------------------------------------
    "historical_files_summary": _on_store(lambda s: validation.historical_files_summary(_raw(s), s.dim())),
    "validation_totals": _on_store(
        lambda s: validation.validation_totals(validation.historical_files_summary(_raw(s), s.dim()))
    ),
    "missing_stations_summary": _on_store(lambda s: validation.missing_stations_summary(_raw(s), s.dim())),
    "missing_station_usage": _on_store(lambda s: validation.missing_station_usage(_raw(s), s.dim())),
    "top_missing_stations": _on_store(
        lambda s: validation.top_missing_stations(validation.missing_station_usage(_raw(s), s.dim()))
    ),
    "missing_station_usage_by_file": _on_store(
        lambda s: validation.missing_station_usage_by_file(_raw(s), s.dim())
    ),
    "missing_station_totals": _on_store(lambda s: validation.missing_station_totals(_raw(s), s.dim())),
    # ---- the same trips loaded through the CSV front door (header groups, encodings) ------
    # files of several splits, some with line breaks inside fields: trip ids come from split offsets
    "csv_trips_clean": _on_store(lambda s: s.csv_database().trips()),
    "csv_quality_summary": _on_store(lambda s: quality.quality_summary(s.csv_database().trips())),
    "csv_monthly_trips": _on_store(lambda s: reports.monthly_trips(s.csv_database().analysis())),
    "csv_top_start_stations": _on_store(
        lambda s: reports.top_start_stations(s.csv_database().analysis(), s.csv_database().dim())
    ),
    # ---- the files themselves: headers, malformed rows, files without rows -----------------
    "csv_columns_audit": _on_store(lambda s: trip_csv.audit_report(trip_csv.audit_headers(s.spark, s.csv_files()))),
    "schema_diff": _on_store(_schema_diff),
    "csv_malformed_rows": _on_store(lambda s: trip_csv.malformed_rows(*s.dirty_raw())),
    "csv_files_summary": _on_store(_csv_files_summary),
    # ---- datetime triage -----------------------------------------------------------------
    "datetime_triage_summary": _on_store(lambda s: triage.datetime_triage_summary(_raw(s))),
    "invalid_datetime_sample": _on_store(lambda s: triage.invalid_datetime_sample(_raw(s))),
    "invalid_start_value_counts": _on_store(lambda s: triage.invalid_start_value_counts(_raw(s))),
    "duration_describe": _on_store(lambda s: triage.duration_describe(_raw(s))),
    "longest_trips": _on_store(lambda s: triage.longest_trips(_raw(s))),
}


# ---- presence of files ----------------------------------------------------------------------
QUERIES["input_presence"] = _on_store(_input_presence)

# ---- a catalog that lists numbers twice: the joined view repeats a trip for each row of its stations ----
QUERIES["repeated_trips_with_station_info"] = _on_store(lambda s: trips_with_station_info(s.analysis(), s.repeated_dim()))
for _name in ("top_start_stations", "top_end_stations", "station_flow_balance", "top_routes"):
    QUERIES[f"repeated_{_name}"] = _on_store(lambda s, report=getattr(reports, _name): report(s.analysis(), s.repeated_dim()))

# ---- report files of the export and validation jobs, which finish them from counts of one pass ----
for _name in (
    "monthly_trips weekday_trips hourly_trips hourly_weekday_trips top_start_stations top_end_stations station_flow_balance "
    "top_routes user_profile_summary historical_files_summary missing_stations_summary missing_station_usage missing_station_usage_by_file"
).split():
    QUERIES[f"exported_{_name}"] = _exported(_name, lambda s, name=_name: QUERIES[name](s.spark, s.sf_dir))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
