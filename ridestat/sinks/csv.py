"""CSV sinks for reports and the station catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOM = "\ufeff"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_csv(df: DataFrame, path: str, bom: bool = False, single_file: bool = True, mode: str = "overwrite") -> str:
    """Header CSV, timestamps as ``yyyy-MM-dd HH:mm:ss``.

    ``single_file`` merges the (already small, aggregated) report into one part file without
    a shuffle, keeping its sort order. ``bom`` prefixes the header with a UTF-8 byte-order
    mark (the validation reports are written that way), via the first column's name.
    """
    if bom and df.columns:
        first = df.columns[0]
        df = df.withColumnRenamed(first, BOM + first)
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode(mode)
        .option("header", True)
        .option("escape", '"')  # RFC 4180: quotes inside quoted fields are doubled
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )
    return path


def read_report_csv(spark, path: str) -> DataFrame:
    """Read a report written by :func:`write_csv` back (all text; BOM removed from the header)."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    return df.select(*[F.col(f"`{c}`").alias(c.lstrip(BOM)) for c in df.columns])
