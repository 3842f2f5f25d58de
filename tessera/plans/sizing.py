"""Size-checked broadcast.

A side is broadcast only when the optimizer's size estimate for it is below a
bound; otherwise the join stays a shuffle join and AQE may still turn it into
a broadcast at run time from the measured shuffle size.  Without CBO the
estimate for an aggregate is its input size, so the check errs on the side of
not broadcasting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer estimate of ``df``'s size in bytes (None when unavailable)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:  # Spark Connect or a plan without statistics
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only when the estimated size is within ``max_bytes``."""
    limit = DEFAULT_MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df
