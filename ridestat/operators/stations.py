"""Station catalog: GBFS records -> catalog rows, key normalisation, dimension handle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import STATION_COLUMNS
from ..functions.rules import NUMBER_RE, station_key
from ..functions.text import py_strip, try_cast
from .joins import DEFAULT_MAX_BROADCAST_ROWS, maybe_broadcast


def _numeric(c: F.Column, to: str) -> F.Column:
    text = c.cast("string")
    d = F.when(text.rlike(NUMBER_RE), try_cast(text, "double"))
    if to == "double":
        return d
    return F.when((d == F.rint(d)) & d.between(-(2.0**31), 2.0**31 - 1), d.cast("int"))


def clean_station_information(records: DataFrame) -> DataFrame:
    """GBFS station records -> catalog (station_id ... has_kiosk), sorted by station_number.

    * station_number = short_name as text (kept as text: ``022`` and ``390-391`` matter)
    * station_name   = name with line breaks turned into spaces, stripped
    * latitude / longitude / capacity: numeric coercion, bad values -> null
    * rental_methods: list -> comma-joined text; other values unchanged
    * only columns present in the feed are kept (absent ones are dropped, not invented)
    """
    cols = set(records.columns)
    out = {}
    if "station_id" in cols:
        out["station_id"] = F.col("station_id").cast("string")
    if "external_id" in cols:
        out["external_id"] = F.col("external_id").cast("string")
    if "short_name" in cols:
        out["station_number"] = F.col("short_name").cast("string")
    if "name" in cols:
        out["station_name"] = py_strip(F.replace(F.col("name").cast("string"), F.lit("\n"), F.lit(" ")))
    if "lat" in cols:
        out["latitude"] = _numeric(F.col("lat"), "double")
    if "lon" in cols:
        out["longitude"] = _numeric(F.col("lon"), "double")
    if "capacity" in cols:
        out["capacity"] = _numeric(F.col("capacity"), "int")
    if "rental_methods" in cols:
        rm, kind = F.col("rental_methods"), records.schema["rental_methods"].dataType
        if isinstance(kind, T.StringType):  # JSON text of the field: a list, or a value kept as it is
            listed = F.from_json(rm, "array<string>")
            rm = F.when(F.startswith(F.ltrim(rm), F.lit("[")) & listed.isNotNull(), F.array_join(listed, ",")).otherwise(rm)
        out["rental_methods"] = F.array_join(rm, ",") if isinstance(kind, T.ArrayType) else rm
    if "has_kiosk" in cols:
        out["has_kiosk"] = F.col("has_kiosk").cast("boolean")
    present = [c for c in STATION_COLUMNS if c in out]
    df = records.select(*[out[c].alias(c) for c in present])
    if "station_number" in present:
        df = df.orderBy(F.col("station_number").asc_nulls_last())
    return df


def station_catalog_summary(catalog: DataFrame) -> DataFrame:
    """Total stations, stations missing a coordinate, stations with capacity 0."""
    return catalog.agg(
        F.count(F.lit(1)).alias("total_stations"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("missing_coordinates"),
        F.count_if(F.col("capacity") == 0).alias("capacity_zero"),
    )


def as_stations_table(catalog: DataFrame) -> DataFrame:
    """Catalog as loaded into the ``stations`` table: station_number normalised, fixed columns."""
    cols = []
    for c in STATION_COLUMNS:
        if c == "station_number":
            cols.append(station_key("station_number").alias(c))
        elif c in catalog.columns:
            cols.append(F.col(c))
        else:
            dtype = {"latitude": "double", "longitude": "double", "capacity": "int", "has_kiosk": "boolean"}
            cols.append(F.lit(None).cast(dtype.get(c, "string")).alias(c))
    return catalog.select(*cols)


@dataclass
class StationDim:
    """The ``stations`` table plus the facts the planner needs about it.

    ``rows`` and ``unique`` come from one small aggregate over the dimension (never over
    trips). ``unique`` (station_number has no duplicates) decides whether reports may
    aggregate trips on the key first and attach names afterwards.
    """

    table: DataFrame
    rows: int
    unique: bool
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS

    @classmethod
    def of(cls, stations: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> "StationDim":
        # blank numbers never match a trip, so only the others must be unique
        named = F.when(F.col("station_number") != "", F.col("station_number"))
        stats = stations.agg(
            F.count(F.lit(1)).alias("n"), F.count(named).alias("named"), F.count_distinct(named).alias("d")
        ).first()
        return cls(stations, int(stats["n"]), stats["named"] == stats["d"], max_broadcast_rows)

    def keys(self) -> DataFrame:
        """Distinct non-blank station keys (a blank catalog number never matches a blank trip key)."""
        k = self.table.select(F.col("station_number").alias("station_key")).where(F.col("station_key") != "").distinct()
        return maybe_broadcast(k, self.rows, self.max_broadcast_rows)

    def attrs(self) -> DataFrame:
        """Station attributes for the name/coordinate joins."""
        a = self.table.select("station_number", "station_name", "latitude", "longitude", "capacity").where(
            F.col("station_number") != ""
        )
        return maybe_broadcast(a, self.rows, self.max_broadcast_rows)
