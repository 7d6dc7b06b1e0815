"""Helpers of the operators: package shipping, checkpoints."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_SHIPPED: dict[str, str] = {}
#: Rows of an Arrow batch: texts are large, and a Python worker holds whole batches.
ARROW_ROWS = 2000


def ready(spark: SparkSession) -> SparkSession:
    """Makes this package importable on the executors and the checkpoint folder known, once per application."""
    sc = spark.sparkContext
    ensure_checkpoint_dir(spark)
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if rows > ARROW_ROWS or rows <= 0:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="ridestat-code-")) / "ridestat_code.zip"  # the driver serves it to the executors
        with zipfile.ZipFile(target, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, str(p.relative_to(package.parent)))
        sc.addPyFile(str(target))
        _SHIPPED[sc.applicationId] = str(target)
    return spark


def free_name(columns: list[str], name: str) -> str:
    """A name like ``name`` that is not among ``columns`` (whose case does not count)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """The frame, written to the shared checkpoint folder and read from there."""
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder."""
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame, written as Parquet to the shared checkpoint folder and read from there."""
    path = shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
