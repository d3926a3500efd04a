"""Structured Streaming forms of the portfolio roll-up."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from loadshift.functions import columns as C
from loadshift.operators import rollup as R
from loadshift.sources import files as IO
from loadshift.streaming import hourly as ST
import fixtures as FX

ZONE = "America/New_York"


def _stream(spark, fixture_dir, files_per_batch=1):
    """Stream the baseline files of state VA, ``files_per_batch`` files per micro-batch."""
    root = f"{fixture_dir}/series/upgrade=0/state=VA"
    schema = spark.read.parquet(f"{root}/1-0.parquet").schema
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
         .option("pathGlobFilter", "[0-9]-0.parquet")
         .option("ignoreCorruptFiles", "true").parquet(root))
    s = s.withColumn("bldg_id", F.regexp_extract(F.col("_metadata.file_name"), IO.FILE_ID_PATTERN, 1).cast("int"))
    return C.sanitize_columns(s).withColumn("upgrade", F.lit(0))


def _rows(df, cols):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(cols).collect())


def test_partials_merge_to_batch_result(spark, fixture_dir):
    d = tempfile.mkdtemp(prefix="loadshift-stream-")
    q = ST.start_partials(_stream(spark, fixture_dir), f"{d}/out", f"{d}/ck")
    q.awaitTermination()
    assert len([x for x in os.listdir(f"{d}/out") if x.startswith("batch_id=")]) >= 3   # several micro-batches
    got = ST.read_portfolio(spark, f"{d}/out", 3, ZONE)
    batch = R.hourly_portfolio(IO.read_series(spark, f"{fixture_dir}/series", (0,), "VA", schema=FX.SERIES_SCHEMA), 3, ZONE)
    assert _rows(got, batch.columns) == _rows(batch, batch.columns)


def test_retried_batch_is_idempotent(spark, fixture_dir):
    d = tempfile.mkdtemp(prefix="loadshift-stream-")
    q = ST.start_partials(_stream(spark, fixture_dir), f"{d}/out", f"{d}/ck")
    q.awaitTermination()
    first = _rows(ST.read_portfolio(spark, f"{d}/out", 3, ZONE), ["hour_utc", "total_electricity_mwh"])
    # rerun on the same checkpoint: nothing is processed twice
    q = ST.start_partials(_stream(spark, fixture_dir), f"{d}/out", f"{d}/ck")
    q.awaitTermination()
    assert _rows(ST.read_portfolio(spark, f"{d}/out", 3, ZONE), ["hour_utc", "total_electricity_mwh"]) == first


def test_scaled_flags_consistent(spark, fixture_dir):
    s = IO.read_series(spark, f"{fixture_dir}/series", (0,), "VA", schema=FX.SERIES_SCHEMA)
    assert [(m.name, m.per_building_mwh) for m in R.portfolio_measures(s)] == list(R.PORTFOLIO_SCALED)
