"""Station catalog CSV (the processed catalog the loads read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sinks.csv import write_csv

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("station_number", T.StringType()),  # text: "022" and "390-391" matter
        T.StructField("station_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("capacity", T.IntegerType()),
        T.StructField("rental_methods", T.StringType()),
        T.StructField("has_kiosk", T.BooleanType()),
    ]
)


def read_station_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog CSV with an explicit schema (no inference; a quoted name may span lines)."""
    df = (
        spark.read.schema(CATALOG_SCHEMA)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')  # RFC 4180 doubled quotes, as the sink writes them
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    # a BOM written by the sink is part of the first header name; the schema is positional
    return df


def write_station_catalog(catalog: DataFrame, path: str) -> str:
    """The catalog as one UTF-8 CSV with a byte-order mark, sorted by station_number."""
    return write_csv(catalog, path, bom=True)
