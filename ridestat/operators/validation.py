"""Per-file validation of raw (standardised, untyped) trip rows.

Input: ``source_file`` + the nine canonical text columns, optionally with ``__has_<column>``
flags (the CSV reader adds them; a column a file does not have is null there and is skipped
by every check, as if absent).

Each report scans the raw rows once. :func:`file_and_station_counts` holds per-file stats
(rows, invalid dates / times, gender counts) and per (file, role, station key) trips in one
map-side-combined aggregate, so a file holding a third of all rows costs no more than any
other; distinct station counts, missing-station lists, usage and totals are computed from that
small aggregate (after one broadcast existence mark against the catalog keys) with a second
aggregate -- never by splitting it into filtered branches, which would re-scan the raw rows.
The ``*_of`` functions take those counts themselves, so that a job writes them once and finishes
all its reports from the written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import valid_date_only, valid_time_only
from ..functions.fixed import TOP_MISSING_STATIONS
from ..functions.rules import percentage, raw_gender, station_key
from .stations import StationDim

ROLE_COLUMNS = {"start": "Ciclo_Estacion_Retiro", "end": "Ciclo_EstacionArribo"}


def present(raw: DataFrame, column: str) -> F.Column:
    flag = f"__has_{column}"
    return F.col(flag) if flag in raw.columns else F.lit(True)


def station_role_counts(raw: DataFrame, dim: StationDim) -> DataFrame:
    """(source_file, role, station_key, trips, found) for every non-blank station reference.

    Keys are aggregated before the catalog mark, so the mark sees one row per distinct key
    per file and role.
    """
    row = raw.select(
        "source_file",
        *[station_key(col).alias(f"{role}_key") for role, col in ROLE_COLUMNS.items()],
        *[present(raw, col).alias(f"{role}_ok") for role, col in ROLE_COLUMNS.items()],
    )
    pairs = [
        F.struct(F.lit(role).alias("role"), F.col(f"{role}_key").alias("station_key"), F.col(f"{role}_ok").alias("ok"))
        for role in ROLE_COLUMNS
    ]
    counts = (
        row.select("source_file", F.inline(F.array(*pairs)))
        .where(F.col("ok") & (F.col("station_key") != ""))
        .groupBy("source_file", "role", "station_key")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    keys = dim.keys().select(F.col("station_key").alias("__k"), F.lit(True).alias("__hit"))
    return (
        counts.join(keys, F.col("station_key") == F.col("__k"), "left")
        .withColumn("found", F.coalesce(F.col("__hit"), F.lit(False)))
        .drop("__k", "__hit")
    )


CHECKS = ("inv_date", "inv_time", "g_m", "g_f", "g_o", "g_u")


def file_and_station_counts(raw: DataFrame, dim: StationDim, flags: tuple[str, ...] = CHECKS) -> DataFrame:
    """Per-file stats and per-(file, role, key) counts in ONE aggregate over the raw rows.

    Every raw row yields a stats row (role null) carrying its flags plus one row per station
    role; one map-side-combined aggregate on (file, role, key) holds both kinds of result,
    then station keys are marked against the catalog (broadcast). Reports consume it with a
    further aggregate (conditional sums / counts), never by filtering it into two branches:
    a filter on a grouping column would be pushed below the aggregate and make each branch
    scan and parse the raw files again.

    Columns: source_file, role (null for the stats row), station_key, n, inv_date, inv_time,
    g_m, g_f, g_o, g_u, found. ``flags`` names the checks a report needs; the columns behind the
    others are neither read nor parsed.
    """
    # per-row values in a projection first (common subexpressions are evaluated once there);
    # the generator below only rearranges columns
    g = raw_gender("Genero_Usuario")
    has_g = present(raw, "Genero_Usuario")
    as_int = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0))
    checks = {
        "inv_date": present(raw, "Fecha_Retiro") & ~valid_date_only("Fecha_Retiro"),
        "inv_time": present(raw, "Hora_Retiro") & ~valid_time_only("Hora_Retiro"),
        "g_m": has_g & (g == "M"),
        "g_f": has_g & (g == "F"),
        "g_o": has_g & (g == "O"),
        "g_u": has_g & (g == "?"),
    }
    row = raw.select(
        "source_file",
        *[as_int(checks[c]).alias(c) for c in flags],
        *[station_key(col).alias(f"{role}_key") for role, col in ROLE_COLUMNS.items()],
        *[present(raw, col).alias(f"{role}_ok") for role, col in ROLE_COLUMNS.items()],
    )
    null_s = F.lit(None).cast("string")
    zero = F.lit(0)
    stats = F.struct(
        null_s.alias("role"), null_s.alias("station_key"), F.lit(True).alias("ok"), *[F.col(c) for c in flags]
    )
    roles = [
        F.struct(
            F.lit(role).alias("role"),
            F.col(f"{role}_key").alias("station_key"),
            F.col(f"{role}_ok").alias("ok"),
            *[zero.alias(c) for c in flags],
        )
        for role in ROLE_COLUMNS
    ]
    agg = (
        row.select("source_file", F.inline(F.array(stats, *roles)))
        .where(F.col("role").isNull() | (F.col("ok") & (F.col("station_key") != "")))
        .groupBy("source_file", "role", "station_key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(c).cast("bigint").alias(c) for c in flags],
        )
    )
    keys = dim.keys().select(F.col("station_key").alias("__k"), F.lit(True).alias("__hit"))
    return (
        agg.join(keys, F.col("station_key") == F.col("__k"), "left")
        .withColumn("found", F.coalesce(F.col("__hit"), F.lit(False)))
        .drop("__k", "__hit")
    )


def _is(role: str | None) -> F.Column:
    return F.col("role").isNull() if role is None else (F.col("role") == role)


def _missing(role: str) -> F.Column:
    return _is(role) & ~F.col("found")


def _with_empty_files(report: DataFrame, files: DataFrame | None) -> DataFrame:
    """The per-file report plus a zero row for each of ``files`` (column file) that has no data row."""
    if files is None:
        return report
    zeros = {c: F.coalesce(c, F.lit(0).cast(t)) for c, t in report.dtypes if c != "file"}
    return files.select("file").distinct().join(report, "file", "full").withColumns(zeros)


def historical_files_summary(raw: DataFrame, dim: StationDim, files: DataFrame | None = None) -> DataFrame:
    """One row per file: rows, distinct / missing station counts, invalid date/time, genders."""
    return files_summary_of(file_and_station_counts(raw, dim), files)


def files_summary_of(counts: DataFrame, files: DataFrame | None = None) -> DataFrame:
    stat = lambda col: F.sum(F.when(_is(None), F.col(col))).cast("bigint")
    out = counts.groupBy(F.col("source_file").alias("file")).agg(
        stat("n").alias("rows"),
        F.count_if(_is("start")).alias("unique_start_stations"),
        F.count_if(_is("end")).alias("unique_end_stations"),
        F.count_if(_missing("start")).alias("missing_start_stations"),
        F.count_if(_missing("end")).alias("missing_end_stations"),
        stat("inv_date").alias("invalid_fecha_retiro"),
        stat("inv_time").alias("invalid_hora_retiro"),
        stat("g_m").alias("gender_M"),
        stat("g_f").alias("gender_F"),
        stat("g_o").alias("gender_O"),
        stat("g_u").alias("gender_unknown"),
    )
    return _with_empty_files(out, files).orderBy(F.col("file").asc_nulls_last())


def missing_stations_summary(raw: DataFrame, dim: StationDim) -> DataFrame:
    """Distinct unknown station keys per file: start-column ones first, then end, each by key."""
    return missing_stations_of(station_role_counts(raw, dim))


def missing_stations_of(counts: DataFrame) -> DataFrame:
    roles = counts.where(F.col("role").isNotNull() & ~F.col("found"))
    return roles.select(
        F.col("source_file").alias("file"),
        "station_key",
        F.when(F.col("role") == "start", F.lit(ROLE_COLUMNS["start"]))
        .otherwise(F.lit(ROLE_COLUMNS["end"]))
        .alias("missing_in"),
        F.when(F.col("role") == "start", F.lit(0)).otherwise(F.lit(1)).alias("__role_order"),
    ).orderBy(
        F.col("file").asc_nulls_last(), "__role_order", F.col("station_key").asc_nulls_last()
    ).drop("__role_order")


def missing_station_usage(raw: DataFrame, dim: StationDim) -> DataFrame:
    """Trips per (file, role, unknown station key), most affected first."""
    return usage_of(station_role_counts(raw, dim).withColumnRenamed("trips", "n"))


def usage_of(counts: DataFrame) -> DataFrame:
    roles = counts.where(F.col("role").isNotNull() & ~F.col("found"))
    return roles.select(
        F.col("source_file").alias("file"), "role", "station_key", F.col("n").alias("affected_trips")
    ).orderBy(
        F.col("affected_trips").desc(),
        F.col("file").asc_nulls_last(),
        F.col("role").asc_nulls_last(),
        F.col("station_key").asc_nulls_last(),
    )


def top_missing_stations(usage: DataFrame, n: int = TOP_MISSING_STATIONS) -> DataFrame:
    return usage.limit(n)


def missing_station_usage_by_file(raw: DataFrame, dim: StationDim, files: DataFrame | None = None) -> DataFrame:
    """Per file: rows, trips with an unknown start / end station, and their percentages."""
    return usage_by_file_of(file_and_station_counts(raw, dim, ()), files)


def usage_by_file_of(counts: DataFrame, files: DataFrame | None = None) -> DataFrame:
    trips_if = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")
    out = counts.groupBy(F.col("source_file").alias("file")).agg(
        trips_if(_is(None)).alias("rows"),
        trips_if(_missing("start")).alias("missing_start_rows"),
        trips_if(_missing("end")).alias("missing_end_rows"),
    )
    return _with_empty_files(out, files).withColumns(
        {
            "missing_start_percentage": percentage("missing_start_rows", "rows"),
            "missing_end_percentage": percentage("missing_end_rows", "rows"),
        }
    ).orderBy(F.col("file").asc_nulls_last())


def missing_station_totals(raw: DataFrame, dim: StationDim) -> DataFrame:
    """All files together: rows, unknown-station trips, percentages, distinct unknown keys."""
    return missing_totals_of(file_and_station_counts(raw, dim, ()))


def missing_totals_of(counts: DataFrame) -> DataFrame:
    trips_if = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")
    sums = counts.agg(
        trips_if(_is(None)).alias("rows"),
        trips_if(_missing("start")).alias("missing_start_rows"),
        trips_if(_missing("end")).alias("missing_end_rows"),
        F.count_distinct(F.when(F.col("role").isNotNull() & ~F.col("found"), F.col("station_key"))).alias(
            "unique_missing_stations"
        ),
    )
    return sums.select(
        "rows",
        "missing_start_rows",
        "missing_end_rows",
        percentage("missing_start_rows", "rows").alias("missing_start_percentage"),
        percentage("missing_end_rows", "rows").alias("missing_end_percentage"),
        "unique_missing_stations",
    )


def validation_totals(summary: DataFrame) -> DataFrame:
    """Sums over :func:`historical_files_summary` (missing counts are station-file pairs)."""
    return summary.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_analyzed"),
        F.coalesce(F.sum("missing_start_stations"), F.lit(0)).alias("missing_start_station_references"),
        F.coalesce(F.sum("missing_end_stations"), F.lit(0)).alias("missing_end_station_references"),
    )
