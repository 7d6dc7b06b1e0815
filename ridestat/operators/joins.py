"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A station catalog has a few hundred to a few thousand rows; anything above this is not a
# dimension we are willing to ship to every task.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def maybe_broadcast(df: DataFrame, rows: int, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the measured row count is within the bound.

    Above the bound the join is planned normally: sort-merge on the keys, or AQE's runtime
    conversion when the side turns out small after all.
    """
    return F.broadcast(df) if rows <= max_rows else df
