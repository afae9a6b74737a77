"""Broadcasts behind a measured size, and rows for every core."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 * 1024 * 1024


def broadcast_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its rows and the bytes of its text allow, else left to the planner.

    Measuring is one aggregate; call it on a table that is already written.
    """
    texts = [F.octet_length(F.coalesce(F.col(n), F.lit(""))) for n, t in df.dtypes if t == "string"]
    row_bytes = sum(texts, F.lit(16 * len(df.columns)))
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes).alias("bytes")).first()
    small = size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(df) if small else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores if it comes from fewer files, for work that takes far longer than its scan."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df
