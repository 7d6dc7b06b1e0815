"""Exact, contiguous 0-based row numbers inside each source file, without sorting a file in one task.

Two inputs need this (trip ids are ``<file stem>_<row index>``):

* CSV scans (:func:`index_by_split`): rows of one input split are contiguous in
  ``monotonically_increasing_id`` order, and splits of a file are ordered by
  ``_metadata.file_block_start``. Index = rows in earlier splits of the file + position
  inside the split. The only aggregate is one row per split.
* Keyed rows (:func:`index_by_key`): rows ordered by an integral, unique key. Rows are cut
  into fixed-width key buckets, a bucket holds at most ``bucket_width`` rows (unique keys), and
  the index is rows in earlier buckets of the file + ``row_number`` inside the bucket. The
  width follows the key range, so a file has at most about a million buckets (the running
  sum over a file's bucket counts stays bounded too).

Neither ever places a whole file in one task; the per-split / per-bucket count tables are
small and joined back on their keys (AQE broadcasts them when they are small at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 16
MAX_BUCKETS_PER_GROUP = 1 << 20
# Offsets are broadcast up to this size (a row: file name and three numbers), so the rows stay
# where they were read; beyond it the join is planned normally.
OFFSET_ROW_BYTES, MAX_OFFSET_BYTES = 256, 256 << 20


def bucket_width_for(df: DataFrame, key_col: str) -> int:
    """Bucket width from the key range (one min/max aggregate).

    At least :data:`DEFAULT_BUCKET_WIDTH`, and wide enough that a group never has more than
    :data:`MAX_BUCKETS_PER_GROUP` buckets, so the per-group offset window stays bounded
    while a bucket holds at most ``width`` rows (keys are unique).
    """
    lo, hi = df.agg(F.min(key_col), F.max(key_col)).first()
    if lo is None:
        return DEFAULT_BUCKET_WIDTH
    span = int(hi) - int(lo) + 1
    return max(DEFAULT_BUCKET_WIDTH, -(-span // MAX_BUCKETS_PER_GROUP))


def _offsets(counts: DataFrame, group_col: str, order_col: str, n_col: str) -> DataFrame:
    w = Window.partitionBy(group_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__offset", F.coalesce(F.sum(n_col).over(w), F.lit(0))).drop(n_col)
    offsets = offsets.checkpoint()  # a row per split or bucket, measured here
    return F.broadcast(offsets) if offsets.count() * OFFSET_ROW_BYTES <= MAX_OFFSET_BYTES else offsets


def index_by_key(
    df: DataFrame,
    group_col: str,
    key_col: str,
    out_col: str = "row_index",
    bucket_width: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = 0-based position of the row within ``group_col`` ordered by ``key_col``.

    ``key_col`` is integral and unique. ``bucket_width`` defaults to :func:`bucket_width_for`.
    """
    if bucket_width is None:
        bucket_width = bucket_width_for(df, key_col)
    d = df.withColumn("__bucket", F.floor(F.col(key_col) / F.lit(bucket_width)))
    counts = d.groupBy(group_col, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = _offsets(counts, group_col, "__bucket", "__n")
    w = Window.partitionBy(group_col, "__bucket").orderBy(key_col)
    return (
        d.join(offsets, [group_col, "__bucket"], "inner")
        .withColumn(out_col, F.col("__offset") + F.row_number().over(w) - F.lit(1))
        .drop("__bucket", "__offset")
    )


def split_position_columns() -> dict[str, F.Column]:
    """Columns :func:`index_by_split` needs; select them directly on a file scan."""
    return {
        "__block": F.col("_metadata.file_block_start"),
        "__pos": F.monotonically_increasing_id(),
    }


def index_by_split(df: DataFrame, file_col: str = "source_file", out_col: str = "row_index") -> DataFrame:
    """Row index from :func:`split_position_columns` (``__block``, ``__pos``).

    Both sides of the join re-read the same files with the same split packing, so
    ``__pos`` is identical in both; after the join no position column is kept.
    """
    counts = df.groupBy(file_col, "__block").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first")
    )
    offsets = _offsets(counts, file_col, "__block", "__n")
    return (
        df.join(offsets, [file_col, "__block"], "inner")
        .withColumn(out_col, F.col("__offset") + F.col("__pos") - F.col("__first"))
        .drop("__block", "__pos", "__first", "__offset")
    )
