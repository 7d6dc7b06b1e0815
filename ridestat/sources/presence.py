"""Which inputs of a load are there: expected files against found ones, and named errors before any work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.tables import _fs, exists


class MissingInput(FileNotFoundError):
    """An input of a job is not there; the message names it."""


def input_presence(spark: SparkSession, folder: str, expected: DataFrame) -> DataFrame:
    """(file, status, has_bytes): the files named by ``expected`` (column file) and the CSV files of the folder.

    status: found, missing (expected alone) or unexpected (found alone). No file is read: the driver lists the folder, one
    name and length a file. A folder that is not there raises :class:`MissingInput`.
    """
    fs, path, make = _fs(spark, folder)
    if not fs.exists(path):
        raise MissingInput(f"trip folder {folder} does not exist")
    listed = fs.globStatus(make(folder.rstrip("/") + "/*.csv"))
    found = spark.createDataFrame([(f.getPath().getName(), f.getLen()) for f in listed], "file string, __length bigint")
    marked = expected.select("file").where("file IS NOT NULL").distinct().withColumn("__expected", F.lit(True))
    status = F.when(F.col("__length").isNull(), "missing").when(F.col("__expected"), "found").otherwise("unexpected")
    out = marked.join(found, "file", "full")
    return out.select("file", status.alias("status"), F.coalesce(F.col("__length") > 0, F.lit(False)).alias("has_bytes"))


def require_inputs(spark: SparkSession, trips_source: str | list[str], catalog: str | None = None) -> None:
    """Raises :class:`MissingInput` for the first input that is not there: trip folder, its files, a listed file, the catalog."""
    for source in [trips_source] if isinstance(trips_source, str) else trips_source:
        folder = isinstance(trips_source, str) and not source.endswith(".csv")
        fs, path, make = _fs(spark, source)
        if folder and not fs.exists(path):
            raise MissingInput(f"trip folder {source} does not exist")
        if not fs.globStatus(make(source.rstrip("/") + "/*.csv") if folder else path):
            raise MissingInput(f"trip folder {source} holds no CSV file" if folder else f"trip file {source} does not exist")
    if catalog is not None and not exists(spark, catalog):
        raise MissingInput(f"station catalog {catalog} does not exist")
