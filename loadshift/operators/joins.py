"""Join helpers: broadcast only sides whose size is bounded before the job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row count that is broadcast on a config-derived bound (ids and keys only).
BROADCAST_ROW_LIMIT = 1_000_000


def broadcast_bounded(df: DataFrame, row_bound: int | None, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint a broadcast when ``row_bound`` (known from configuration, e.g. the sum of
    sample sizes or the number of scenarios) is at most ``limit``; otherwise leave
    the choice to AQE, which converts a join to broadcast only from measured sizes."""
    return F.broadcast(df) if row_bound is not None and row_bound <= limit else df
