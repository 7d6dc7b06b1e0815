"""Standardised raw trip rows -> the typed 20-column ``trips_clean`` fact table.

One projection of native expressions (no Python on trip rows) followed by two broadcast
existence marks against the station keys. No shuffle except the optional row-index step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import datetime_text, duration_minutes, is_weekend, weekday, with_parsed_datetime
from ..functions.fixed import TRIPS_CLEAN_COLUMNS
from ..functions.rules import age, gender, station_key
from ..functions.text import py_strip
from .stations import StationDim


def trip_id(source_file: str | F.Column, row_index: str | F.Column) -> F.Column:
    """``<file name without every '.csv'>_<0-based row index in the file>``."""
    f = F.col(source_file) if isinstance(source_file, str) else source_file
    r = F.col(row_index) if isinstance(row_index, str) else row_index
    return F.concat(F.replace(f, F.lit(".csv"), F.lit("")), F.lit("_"), r.cast("string"))


def mark_found(df: DataFrame, key_col: str, out_col: str, dim: StationDim) -> DataFrame:
    """``out_col`` = key is a (non-blank) catalog key; never null.

    Left join against the *distinct* key set, so no trip row can be duplicated.
    """
    k_name, hit = f"__k_{out_col}", f"__hit_{out_col}"
    keys = dim.keys().select(F.col("station_key").alias(k_name), F.lit(True).alias(hit))
    return (
        df.join(keys, F.col(key_col) == F.col(k_name), "left")
        .withColumn(out_col, F.coalesce(F.col(hit), F.lit(False)))
        .drop(k_name, hit)
    )


def clean_trips(raw: DataFrame, dim: StationDim) -> DataFrame:
    """Typed trips from raw text columns.

    ``raw`` has ``source_file``, the nine canonical text columns and, when trip ids are
    wanted, ``row_index`` (see :mod:`.row_index`). Without ``row_index`` the result has
    no ``trip_id`` column (reports never read it, and it costs a shuffle to build).
    """
    has_index = "row_index" in raw.columns
    first = []
    if has_index:
        first.append(trip_id("source_file", "row_index").alias("trip_id"))
    # The joined datetime text is its own column: the parse reads it several times, and the
    # optimizer keeps a non-trivial column that is read more than once in its own projection.
    t = raw.select(
        *first,
        F.col("source_file"),
        gender("Genero_Usuario").alias("gender"),
        age("Edad_Usuario").alias("age"),
        py_strip("Bici").alias("bike_id"),
        station_key("Ciclo_Estacion_Retiro").alias("start_station_number"),
        station_key("Ciclo_EstacionArribo").alias("end_station_number"),
        datetime_text("Fecha_Retiro", "Hora_Retiro").alias("__start_text"),
        datetime_text("Fecha_Arribo", "Hora_Arribo").alias("__end_text"),
    )
    t = with_parsed_datetime(t, "__start_text", "start_datetime")
    t = with_parsed_datetime(t, "__end_text", "end_datetime").drop("__start_text", "__end_text")
    s = F.col("start_datetime")
    t = t.withColumns(
        {
            "duration_minutes": duration_minutes("start_datetime", "end_datetime"),
            "start_date": F.to_date(s),
            "end_date": F.to_date("end_datetime"),
            "year": F.year(s),
            "month": F.month(s),
            "day": F.dayofmonth(s),
            "hour": F.hour(s),
            "weekday": weekday(s),
        }
    )
    t = t.withColumn("is_weekend", is_weekend("weekday"))
    t = mark_found(t, "start_station_number", "start_station_found", dim)
    t = mark_found(t, "end_station_number", "end_station_found", dim)
    cols = [c for c in TRIPS_CLEAN_COLUMNS if has_index or c != "trip_id"]
    return t.select(*cols)
