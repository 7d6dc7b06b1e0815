"""Parquet table sink / source with a stored schema (partition column types survive a round trip).

A table is a folder of versions. A write goes to a version folder of its own; when data and schema are
there, a marker file ``_versions/<number>=<folder>`` is created, which is what readers look for. A
failed or stopped write leaves the table as it was, a concurrent one comes as a version of its own, and
queries that already read a version keep it until the write after next (``KEPT_VERSIONS``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA_DIR = "_ridestat_schema"  # ignored by Spark's file listing (leading underscore)
VERSIONS_DIR = "_versions"
KEPT_VERSIONS = 2
_SCHEMAS: dict[str, T.StructType] = {}


def _fs(spark: SparkSession, path: str):
    """The path's own file system, the path, and a maker of paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p = make(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, make


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path's own file system has it."""
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder name) of the finished versions of a table, oldest first."""
    fs, p, _ = _fs(spark, f"{path}/{VERSIONS_DIR}")
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted((int(n.split("=", 1)[0]), n.split("=", 1)[1]) for n in names if "=" in n)


def table_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the newest version of a table (the path itself where there is none)."""
    found = versions(spark, path)
    return f"{path}/{found[-1][1]}" if found else path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether some write of the table finished."""
    return bool(versions(spark, path))


def _commit(spark: SparkSession, path: str, folder: str) -> None:
    """Makes ``folder`` the newest version; drops those before the ``KEPT_VERSIONS`` newest."""
    found = versions(spark, path)
    number = found[-1][0] + 1 if found else 1
    fs, marker, make = _fs(spark, f"{path}/{VERSIONS_DIR}/{number:012d}={folder}")
    fs.create(marker, False).close()
    for old, name in versions(spark, path)[:-KEPT_VERSIONS]:
        fs.delete(make(f"{path}/{VERSIONS_DIR}/{old:012d}={name}"), False)
        fs.delete(make(f"{path}/{name}"), True)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    max_records_per_file: int | None = None,
    cluster_by: list[str] | None = None,
) -> None:
    """Write a new version of the table as Parquet (optionally partitioned) with its schema, then make it current.

    Without ``cluster_by`` no shuffle is added: each task writes the partition folders its
    rows fall into (Spark sorts locally by the partition columns). That is the right plan when
    the input is already clustered by the partition columns -- monthly trip files read split
    by split produce one or two start months per task.

    With ``cluster_by`` (for inputs that are not clustered) the rows are first
    range-partitioned on the partition columns plus that row key: every task then writes one
    or two folders instead of all of them (no tasks x partitions small files), and a partition
    holding a third of the table (a hot month, the null-date partition) is split across tasks
    by the trailing key. The partition count is left to AQE's coalescing.
    """
    spark = df.sparkSession
    if partition_by and cluster_by:
        df = df.repartitionByRange(*partition_by, *cluster_by)
    folder = f"v-{uuid.uuid4().hex}"
    target = f"{path}/{folder}"
    w = df.write.mode("errorifexists")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    schema = spark.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1)
    schema.write.text(f"{target}/{SCHEMA_DIR}")
    _SCHEMAS[target] = df.schema
    _commit(spark, path, folder)


def table_schema(spark: SparkSession, target: str) -> T.StructType | None:
    if target not in _SCHEMAS:
        if not exists(spark, f"{target}/{SCHEMA_DIR}"):
            return None
        text = spark.read.text(f"{target}/{SCHEMA_DIR}").first()[0]
        _SCHEMAS[target] = T.StructType.fromJson(json.loads(text))
    return _SCHEMAS[target]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read the newest version of a table written by :func:`write_table`, with its original column types and order."""
    target = table_path(spark, path)
    schema = table_schema(spark, target)
    if schema is None:
        return spark.read.parquet(target)
    return spark.read.schema(schema).parquet(target).select(*schema.fieldNames())
