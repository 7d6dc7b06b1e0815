"""GBFS feeds landed as JSON files: discovery lookup, station_information scan, raw snapshots.

Downloading is outside Spark (a network client); these readers work on the landed files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEED = T.StructType([T.StructField("name", T.StringType()), T.StructField("url", T.StringType())])
DISCOVERY_SCHEMA = T.StructType(
    [
        T.StructField("last_updated", T.LongType()),
        T.StructField(
            "data",
            T.MapType(T.StringType(), T.StructType([T.StructField("feeds", T.ArrayType(FEED))])),
        ),
    ]
)

# numbers are read as text so that bad values become null in cleaning instead of failing the read
STATION = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("short_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.StringType()),
        T.StructField("lon", T.StringType()),
        T.StructField("capacity", T.StringType()),
        T.StructField("rental_methods", T.StringType()),  # JSON text: feeds publish lists and single values
        T.StructField("has_kiosk", T.BooleanType()),
    ]
)
STATION_INFORMATION_SCHEMA = T.StructType(
    [
        T.StructField("last_updated", T.LongType()),
        T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(STATION))])),
    ]
)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def feeds(spark: SparkSession, discovery_path: str) -> DataFrame:
    """language, position, name, url: every feed that the discovery document lists."""
    languages = _read(spark, discovery_path, DISCOVERY_SCHEMA).select(F.explode("data").alias("language", "listed"))
    return languages.select("language", F.posexplode("listed.feeds").alias("position", "feed")).select("language", "position", "feed.*")


def feed_lookup(spark: SparkSession, discovery_path: str) -> DataFrame:
    """language, name, url: where each feed is found (the first of those with one name)."""
    return feeds(spark, discovery_path).groupBy("language", "name").agg(F.min_by("url", "position").alias("url"))


def feed_url(spark: SparkSession, discovery_path: str, feed_name: str, language: str = "es") -> str:
    """URL of ``feed_name`` in the discovery document's ``data.<language>.feeds`` (first match)."""
    hit = feed_lookup(spark, discovery_path).where((F.col("language") == language) & (F.col("name") == feed_name)).collect()
    if not hit:
        raise ValueError(f"no {language} feed is named {feed_name!r} in {discovery_path}")
    return hit[0]["url"]


def station_records(spark: SparkSession, station_information_path: str) -> DataFrame:
    """One row per station from ``data.stations`` (fields as published)."""
    return _read(spark, station_information_path, STATION_INFORMATION_SCHEMA).select(
        F.inline("data.stations")
    )


def feed_last_updated(spark: SparkSession, station_information_path: str) -> DataFrame:
    """``last_updated`` epoch seconds as a UTC timestamp (one row per landed document)."""
    return _read(spark, station_information_path, STATION_INFORMATION_SCHEMA).select(
        F.col("last_updated"),
        epoch_utc("last_updated").alias("last_updated_utc"),
    )


def epoch_utc(seconds: str) -> F.Column:
    """Epoch seconds added to the zone-less epoch: UTC wall time whatever the session zone is."""
    return F.timestamp_add("SECOND", F.col(seconds), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def utc_stamp(now: dt.datetime | None = None) -> str:
    """``YYYY-mm-dd_HH-MM-SS`` in UTC, for snapshot names."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(dt.timezone.utc).strftime("%Y-%m-%d_%H-%M-%S")


def save_raw_snapshot(
    spark: SparkSession, json_path: str, raw_dir: str, prefix: str = "station_information_raw", now: dt.datetime | None = None
) -> str:
    """Keep the landed document as-is under a UTC-stamped name (append-only raw layer)."""
    out = f"{raw_dir.rstrip('/')}/{prefix}_{utc_stamp(now)}"
    spark.read.text(json_path, wholetext=True).write.mode("errorifexists").text(out)
    return out


def raw_snapshots(spark: SparkSession, raw_dir: str, prefix: str = "station_information_raw") -> DataFrame:
    """name, taken_utc, last_updated_utc, stations of every snapshot in the raw layer, oldest first."""
    documents = spark.read.text(f"{raw_dir.rstrip('/')}/{prefix}_*", wholetext=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    document = F.from_json("value", STATION_INFORMATION_SCHEMA)
    rows = documents.select(name.alias("name"), document.alias("doc")).select("name", "doc.last_updated", F.size("doc.data.stations").cast("bigint").alias("stations"))
    taken = F.try_to_timestamp(F.substring("name", -19, 19), F.lit("yyyy-MM-dd_HH-mm-ss")).cast("timestamp_ntz")
    return rows.select("name", taken.alias("taken_utc"), epoch_utc("last_updated").alias("last_updated_utc"), "stations").orderBy("name")
