"""Scans and sinks.

* CSV in: explicit schema, header, ``NA`` and empty as NULL; dotted names are
  sanitized on the way in and restored on the way out.
* Series in (:func:`read_series`): the source's one file per building and arm, or the
  Spark-native table of :func:`write_series`; the caller names the layout. Only the folders
  of the requested arms and state are listed.
* A building and arm whose file cannot be read in full is dropped whole and reported with its
  cause (:func:`series_status`).
* :func:`checkpoint_table` writes a table to the shared folder and reads it back:
  the lineage cut used between job stages.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..session import scratch_path
from . import series_files as SF
from .series_files import FILE_ID_PATTERN


BAD_LINE = "_bad_line"


def input_status(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(input, path, present) of the named inputs, which are configuration."""
    return spark.createDataFrame([(name, p, path_exists(spark, p)) for name, p in paths.items()],
                                 "input string, path string, present boolean")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hp = _at(spark, path)
    return fs.exists(hp)


def _at(spark: SparkSession, path: str):
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, through the file system that Spark uses."""
    fs, hp = _at(spark, path)
    stream = fs.open(hp)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hp = _at(spark, path)
    stream = fs.create(hp, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _rewrite(spark: SparkSession, path: str, change) -> None:
    """Replace one small file by ``change`` of its bytes."""
    fs, hp = _at(spark, path)
    stream = fs.open(hp)
    data = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    out = fs.create(hp, True)
    out.write(bytearray(change(data)))
    out.close()


def truncate_file(spark: SparkSession, path: str) -> None:
    """Cut the second half off a file (a copy that broke off)."""
    _rewrite(spark, path, lambda b: b[:len(b) // 2])


def blot_file(spark: SparkSession, path: str) -> None:
    """Overwrite the pages of a parquet file but not its footer (a damaged disk block)."""
    def blot(b: bytes) -> bytes:
        body = len(b) - 8 - int.from_bytes(b[-8:-4], "little")
        return b[:4] + b"\xff" * (body - 4) + b[body:]
    _rewrite(spark, path, blot)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, hp = _at(spark, path)
    fs.delete(hp, True)


def require_paths(spark: SparkSession, *paths: str) -> None:
    """Fail early, with the path in the message, when an input is missing."""
    for p in paths:
        if not path_exists(spark, p):
            raise FileNotFoundError(f"Missing file: {p}")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return scratch_path(spark, name)


def read_csv(spark: SparkSession, path: str, schema, sanitize: bool = True) -> DataFrame:
    """CSV with header; ``NA`` and empty fields read as NULL."""
    df = (spark.read.schema(schema).option("header", True).option("nullValue", "NA")
          .option("emptyValue", None).csv(path))
    return C.sanitize_columns(df) if sanitize else df


def csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """The inferred schema of a CSV (a convenience for small files; give the schema for
    production runs)."""
    return spark.read.option("header", True).option("nullValue", "NA").option("inferSchema", True).csv(path).schema


def read_metadata(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Building metadata CSV. With no schema the types are inferred."""
    return read_csv(spark, path, csv_schema(spark, path) if schema is None else schema)


def bad_records(spark: SparkSession, path: str, schema) -> DataFrame:
    """(file, line, parsed) of the CSV lines that do not fit the schema: a field of another
    type, too few or too many fields. ``parsed`` shows what :func:`read_csv` keeps of the line,
    as JSON. All fields are parsed, so that no fault is pruned away."""
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    raw = (spark.read.schema(T.StructType([*fields, T.StructField(BAD_LINE, T.StringType())])).option("header", True)
           .option("nullValue", "NA").option("emptyValue", None).option("columnNameOfCorruptRecord", BAD_LINE).csv(path))
    parsed = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in fields]))
    return (raw.select(F.col("_metadata.file_name").alias("file"), F.col(BAD_LINE).alias("line"), parsed.alias("parsed"))
            .where(F.col("line").isNotNull() & (F.length("parsed") > 0)))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
              single_file: bool = False) -> str:
    """CSV with header, NULL written as ``NA``, dotted names restored.

    ``single_file`` is for small reports only (one task writes everything)."""
    out = C.restore_columns(df)
    if single_file:
        out = out.coalesce(1)
    w = out.write.mode("overwrite").option("header", True).option("nullValue", "NA")
    if partition_by:
        w = w.partitionBy(*[C.restore(p) for p in partition_by])
    w.csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def checkpoint_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet and return a read of what was written: a lineage cut
    that survives executor loss (the folder is shared). The written schema is given
    to the reader, so an empty result reads back as an empty table."""
    write_parquet(df, path, partition_by)
    parts = list(partition_by or [])
    fields = {f.name: f for f in df.schema.fields}
    schema = T.StructType([fields[c] for c in df.columns if c not in parts] + [fields[c] for c in parts])
    spark = df.sparkSession
    return spark.read.schema(schema).parquet(path).select(*df.columns)


def write_series(df: DataFrame, root: str) -> str:
    """Write readings in the Spark-native layout: ``upgrade=U/state=S/part-*.parquet`` with
    ``bldg_id`` as a column. Rows are dealt by ranges of (arm, state, building, time), so the
    number of files follows the session's shuffle partitions (coalesced to the data by
    adaptive execution), a building holding a large share of the rows is split by time, and
    row-group statistics prune by building."""
    keys = ("upgrade", "state", "bldg_id", "timestamp")
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out.write.mode("overwrite").partitionBy("upgrade", "state").parquet(root)
    return root


def write_source_series(df: DataFrame, root: str) -> str:
    """Write readings in the source layout, ``upgrade=U/state=S/<bldg_id>-<U>.parquet``: one
    file per building and arm, named by the task that writes it."""
    return SF.write_files(df, root)


def series_folders(spark: SparkSession, root: str, upgrades: Sequence[int], state: str | None) -> list[str]:
    """The folders of the arms (and state): only these are listed. A missing arm is left out;
    no folder at all is an error."""
    wanted = [f"{root.rstrip('/')}/upgrade={u}" + (f"/state={state}" if state is not None else "") for u in upgrades]
    found = [p for p in wanted if path_exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"Missing file: {', '.join(wanted)}")
    return found


def _id_table(spark: SparkSession, ids) -> DataFrame | None:
    return spark.createDataFrame([(int(i),) for i in ids], "bldg_id int") if isinstance(ids, (list, tuple)) else ids


def _open_series(spark, root, folders, layout, ids, schema, tolerant: bool) -> DataFrame:
    """Readings with ``bldg_id``, ``upgrade`` and ``state``. The schema is the given one, or
    that of the footers of the folders, whatever the ids. ``ids``: a list (configuration)
    becomes a literal filter; a table is joined with the listing of the files (source layout) or
    with the readings."""
    if layout not in ("source", "table"):
        raise ValueError(f"layout must be 'source' or 'table', not {layout!r}")
    if layout == "source":
        # a table of ids, or files whose types differ
        if isinstance(ids, DataFrame) or (schema is None and SF.merged_schema(spark, root, folders) is None):
            return SF.open_files(spark, root, folders, _id_table(spark, ids), schema).readings()
    reader = spark.read.option("basePath", root).option("ignoreCorruptFiles", "true" if tolerant else "false")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    df = reader.parquet(*folders)
    if layout == "source":
        fname = F.col("_metadata.file_name")
        if isinstance(ids, (list, tuple)):
            arms = [f.rstrip("/").split("/upgrade=")[1].split("/")[0] for f in folders]
            df = df.where(fname.isin([f"{i}-{u}.parquet" for i in ids for u in arms]))
        # a file whose name does not follow the pattern gets a NULL id (never a failed job)
        return df.withColumn("bldg_id", F.regexp_extract(fname, FILE_ID_PATTERN, 1).try_cast("int"))
    if isinstance(ids, (list, tuple)):
        df = df.where(F.col("bldg_id").isin(list(ids)))
    if isinstance(ids, DataFrame):
        df = df.join(ids.select(F.col("bldg_id").cast(df.schema["bldg_id"].dataType)).distinct(), "bldg_id", "left_semi")
    return df


def series_files(spark: SparkSession, root: str, upgrades: Sequence[int], state: str | None = None, ids=None,
                 schema=None) -> SF.SeriesFiles:
    """The source layout's files of the requested arms and buildings (:func:`series_files.open_files`)."""
    return SF.open_files(spark, root, series_folders(spark, root, upgrades, state), _id_table(spark, ids), schema)


def count_readings(readings: DataFrame) -> DataFrame:
    """(bldg_id, upgrade, n_read) of a scan that reads every column; write it before use."""
    touched = F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in readings.columns]))
    return readings.groupBy("bldg_id", "upgrade").agg(F.count(F.lit(1)).alias("n_read"), touched.alias("_touched"))


def series_status(spark: SparkSession, root: str, upgrades: Sequence[int], state: str | None, read: DataFrame,
                  ids=None, schema=None) -> DataFrame:
    """(bldg_id, upgrade, n_expected, n_read, cause) for every source file. ``read`` holds the
    counted readings (bldg_id, upgrade, n_read) of a tolerant scan of their data, as a written
    table (a lazy one would be pruned to the count and read no data); the
    expected count comes from the footers. A building and arm is loaded only when both
    agree: a scan that skips a damaged row group, or loses rows to a storage error, does not
    pass. ``cause`` is NULL where the file is whole."""
    return series_files(spark, root, upgrades, state, ids, schema).status(read)


def read_series(spark: SparkSession, root: str, upgrades: Sequence[int], state: str | None = None,
                ids=None, measures: Sequence[str] | None = None, schema=None, layout: str = "source",
                check: bool = True) -> DataFrame:
    """Readings of the requested buildings and arms, with ``bldg_id`` and ``upgrade``.

    ``layout="source"``: one file per building and arm. A file that cannot be read in full is
    dropped whole (a damaged page of a column that is not asked for harms nothing): small files are read whole
    by their task or not at all; where others are among them, with ``check`` a probe first reads the asked-for columns
    of the requested files and compares the counted rows with the footers (:func:`series_status`). A caller that counts
    the readings itself passes ``check=False`` and drops what :func:`series_status` names.
    ``layout="table"``: the layout of :func:`write_series`; a file holds many buildings, so an
    unreadable one is an error.

    ``measures`` (dotted or sanitized names) narrows the columns; by default all are kept."""
    folders = series_folders(spark, root, upgrades, state)
    files = None
    if layout == "source" and check and not isinstance(ids, (list, tuple)):
        files = SF.open_files(spark, root, folders, ids, schema)
        if files.strays and ids is None:  # files without an id are read too
            files = None
    if files is not None:
        df = files.readings(None if measures is None else {"bldg_id", "upgrade", "timestamp", *[C.sanitize(m) for m in measures]})
    else:
        df = _open_series(spark, root, folders, layout, ids, schema, tolerant=layout == "source")
    if measures is not None:
        keep = {"bldg_id", "upgrade", "timestamp", *[C.sanitize(m) for m in measures]}
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if C.sanitize(c) in keep])
    if layout == "source" and check and not (files is not None and files.whole):
        read = checkpoint_table(count_readings(df), scratch_path(spark, "series_probe"))
        files = files or series_files(spark, root, upgrades, state, ids, schema)
        bad = files.status(read).where(F.col("cause").isNotNull())
        bad = checkpoint_table(bad.select("bldg_id", "upgrade"), scratch_path(spark, "series_bad"))
        if bad.count():
            df = df.join(bad, ["bldg_id", "upgrade"], "left_anti")
    df = C.sanitize_columns(df)
    if measures is not None:
        order = ["bldg_id", "upgrade", "timestamp", *[C.sanitize(m) for m in measures]]
        df = df.select(*[c for c in order if c in df.columns])
    return df


def load_status(requested: DataFrame, readings: DataFrame) -> DataFrame:
    """Every requested (group, bldg_id) row with ``loaded`` = it has readings.

    The readings are reduced to distinct ids first (a map-side partial aggregate,
    so a building holding a large share of the rows collapses before any shuffle),
    then matched with the requested ids."""
    req_ids = requested.select("bldg_id").distinct()
    present = (readings.select("bldg_id").distinct().join(req_ids, "bldg_id", "left_semi")
               .withColumn("loaded", F.lit(True)))
    out = requested.join(present, "bldg_id", "left")
    return out.withColumn("loaded", F.coalesce(F.col("loaded"), F.lit(False)))


def arm_load_status(requested: DataFrame, readings: DataFrame, arms: Sequence[int],
                    arm_col: str = "upgrade") -> DataFrame:
    """J6 / J7 for several arms in one scan: every requested (group, bldg_id) row per
    arm with ``loaded``. Only the id and arm columns of the readings are touched."""
    # aggregate first (partial aggregation collapses hot buildings), then match
    flags = (readings.groupBy("bldg_id")
             .agg(*[F.max(F.col(arm_col) == F.lit(a)).alias(f"_arm_{a}") for a in arms])
             .join(requested.select("bldg_id").distinct(), "bldg_id", "left_semi"))
    st = requested.join(flags, "bldg_id", "left").select(
        *requested.columns, *[F.coalesce(F.col(f"_arm_{a}"), F.lit(False)).alias(f"_arm_{a}") for a in arms])
    long = st.unpivot(requested.columns, [f"_arm_{a}" for a in arms], "_arm", "loaded")
    return long.select(*requested.columns,
                       F.regexp_extract("_arm", r"(\d+)$", 1).cast("int").alias(arm_col), "loaded")


def failed_reads(requested: DataFrame, readings: DataFrame) -> DataFrame:
    """Requested rows that produced no readings (the reference only logs them)."""
    return requested.join(readings.select("bldg_id").distinct(), "bldg_id", "left_anti")
