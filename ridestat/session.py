"""SparkSession construction and shared-folder handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every ridestat job wants. None of the operators *depend* on them for
# correctness (all datetimes are TIMESTAMP_NTZ and dirty text goes through try_*),
# they only make plans faster and output easier to compare.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def get_spark(
    app: str = "ridestat",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with ridestat's defaults.

    ``master`` is only applied when given; on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or already set)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; invent a scratch one only in local mode (tests)."""
    sc = spark.sparkContext
    path = checkpoint_dir(spark)
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="ridestat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path
