"""Tables written in hash buckets, so that later joins and aggregates on the bucket columns read
matching buckets without an exchange."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` files by the hash of ``by`` (by default as many as
    shuffle partitions), sorted within each, and return a read that knows it. One exchange, at
    write time. The data belong to ``path``; the catalog
    entry that describes the buckets is dropped again (the files stay, and the returned table keeps
    what it read from the catalog)."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*by, *sort)
     .option("path", path).saveAsTable(name))
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out

