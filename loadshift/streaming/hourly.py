"""

Over a stream of readings (``bldg_id, upgrade, timestamp, measures``):

* :func:`start_partials` is exact and stateless. Each micro-batch pre-aggregates its
  own readings to (arm, hour) sums and writes them to ``<out>/batch_id=<id>``,
  overwriting that folder, so a retried batch replaces its own output (exactly
  once). :func:`read_portfolio` merges all partials and finishes the measures.
  Late readings of any age simply add a partial row; no state store is kept.

It writes to paths under the cluster's shared folder; checkpoints make a restarted query
resume where it stopped.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import timecols as TC
from ..operators import rollup as R


def start_partials(readings: DataFrame, out_path: str, checkpoint: str, group_cols: Sequence[str] = (),
                   arm_col: str = "upgrade", trigger: dict | None = None) -> StreamingQuery:
    """Start the exact form; ``trigger`` e.g. ``{"availableNow": True}`` or
    ``{"processingTime": "1 minute"}``."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = R.portfolio_sums(batch, group_cols, arm_col)
        part.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = readings.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def read_portfolio(spark: SparkSession, out_path: str, n_buildings, zone: str = TC.DEFAULT_ZONE,
                   group_cols: Sequence[str] = (), arm_col: str = "upgrade",
                   arm_labels: dict[int, str] | None = None) -> DataFrame:
    """Merge the partials written so far and finish them into the D9 table."""
    partials = spark.read.parquet(out_path)
    merged = R.merge_portfolio_sums(partials.drop("batch_id"), group_cols, arm_col)
    return R.finish_portfolio(merged, n_buildings, zone, arm_col, group_cols, arm_labels)
