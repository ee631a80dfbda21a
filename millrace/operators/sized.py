"""Broadcasting behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import stable

BROADCAST_ROWS = 500_000


def if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` materialised once and, when it has few rows, marked for broadcast.

    For narrow results of unknown size that meet a large table: without the mark the
    large side is shuffled before Spark can see how small the other one is.  A
    result over the limit joins by shuffle.
    """
    df = stable(df)
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
