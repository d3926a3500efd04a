"""Global order without a single task (O1)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.files import checkpoint_table

_PART_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def numbered(df: DataFrame, keys: Sequence[str], name: str = "row_number") -> DataFrame:
    """``df`` with the position of every row in the order of ``keys``, from 1.

    The rows are dealt to range partitions of the keys, sorted within each and written with
    their place in the partition (a repeated attempt of a task replaces its file, so the
    numbers stand). The partitions' counts, one row each, give every partition's offset. Rows
    with equal keys are numbered in any order; a key that holds most rows is one partition's."""
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    rows = checkpoint_table(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                            .withColumns({"_part": F.shiftright(place, _PART_BITS),
                                          "_place": place.bitwiseAND((1 << _PART_BITS) - 1)}),
                            scratch_path(spark, "numbered"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", before.alias("_before"))
    # one row for each shuffle partition
    return (rows.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before"))
