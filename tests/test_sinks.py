"""Parquet table and CSV sinks: round trips, partition types, null partitions, clustering, BOM."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ridestat.sinks.csv import read_report_csv, write_csv
from ridestat.sinks.tables import KEPT_VERSIONS, read_table, table_exists, table_path, versions, write_table


def _rows():
    out = []
    for i in range(200):
        year = None if i % 50 == 0 else 2022 + i % 2  # null partition, like trips with no start
        out.append((f"t_{i}", year, None if year is None else 1 + i % 12, dt.datetime(2022, 1, 1, 0, 0, i % 60), i / 7))
    return out


SCHEMA = "trip_id string, year int, month int, start_datetime timestamp_ntz, duration_minutes double"


def test_partitioned_round_trip_keeps_types_order_and_nulls(spark, tmp_dir):
    df = spark.createDataFrame(_rows(), SCHEMA)
    path = os.path.join(tmp_dir, "t")
    write_table(df, path, partition_by=["year", "month"])
    assert table_exists(spark, path)
    back = read_table(spark, path)
    assert back.columns == df.columns and back.schema == df.schema
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert back.where("year IS NULL").count() == 4
    # a filter on the partition columns prunes folders
    plan = back.where("year = 2022 AND month = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan


def test_cluster_by_bounds_files_per_task(spark, tmp_dir):
    df = spark.createDataFrame(_rows(), SCHEMA).repartition(8)  # scattered input
    path = os.path.join(tmp_dir, "c")
    write_table(df, path, partition_by=["year", "month"], cluster_by=["trip_id"])
    target = table_path(spark, path)
    files = glob.glob(os.path.join(target, "year=*", "month=*", "*.parquet"))
    folders = glob.glob(os.path.join(target, "year=*", "month=*"))
    # without clustering 8 scattered tasks would write up to 8 files into every folder
    assert len(files) < 8 * len(folders)
    assert read_table(spark, path).count() == 200


def test_csv_sink_bom_and_timestamps(spark, tmp_dir):
    df = spark.createDataFrame(_rows()[:5], SCHEMA).orderBy("trip_id")
    path = write_csv(df, os.path.join(tmp_dir, "r"), bom=True)
    (part,) = glob.glob(os.path.join(path, "*.csv"))
    with open(part, "rb") as f:
        head = f.read()
    assert head.startswith(b"\xef\xbb\xbftrip_id,year,month,start_datetime,duration_minutes")
    assert b"2022-01-01 00:00:01" in head and b"T00:" not in head
    back = read_report_csv(spark, path)
    assert back.columns[0] == "trip_id" and back.count() == 5


def test_csv_quotes_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("Estación \"Reforma\", norte", 1)], "station_name string, n int")
    path = write_csv(df, os.path.join(tmp_dir, "q"))
    (part,) = glob.glob(os.path.join(path, "*.csv"))
    with open(part, encoding="utf-8") as f:
        assert '"Estación ""Reforma"", norte"' in f.read()
    assert read_report_csv(spark, path).first()["station_name"] == 'Estación "Reforma", norte'


def test_failed_write_leaves_the_table_readable(spark, tmp_dir):
    path = os.path.join(tmp_dir, "v")
    assert not table_exists(spark, path)
    write_table(spark.range(10), path)
    held = read_table(spark, path)
    stops_midway = spark.range(1000).select(F.when(F.col("id") == 990, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stopped"):
        write_table(stops_midway, path)
    assert table_exists(spark, path) and read_table(spark, path).count() == 10
    write_table(spark.range(20).withColumn("more", F.lit("x")), path)
    assert read_table(spark, path).columns == ["id", "more"] and read_table(spark, path).count() == 20
    assert held.count() == 10  # a reader of the version before still has it
    write_table(spark.range(30), path)
    assert read_table(spark, path).count() == 30
    assert len(versions(spark, path)) == KEPT_VERSIONS


def test_concurrent_writes_each_leave_a_whole_table(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    path = os.path.join(tmp_dir, "w")
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda n: write_table(spark.range(n), path), (11, 22)))
    assert read_table(spark, path).count() in (11, 22)
