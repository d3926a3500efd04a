"""Files of a series as a table: differing types, id tables, the writer of the source layout."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loadshift.sources import files as IO
from loadshift.sources import series_files as SF

NET = "out.electricity.net.energy_consumption"


def _write(root, bldg, columns, arm=0):
    d = f"{root}/upgrade={arm}/state=VA"
    os.makedirs(d, exist_ok=True)
    pq.write_table(pa.table(columns), f"{d}/{bldg}-{arm}.parquet")


def mixed_series(root):
    """Measures as int, double, long, float, flag and empty column; one file lacks a measure."""
    at = pa.array([0, 900_000_000, 1_800_000_000], pa.timestamp("us"))
    col = lambda kind, *v: pa.array(v, kind)
    _write(root, 1, {"timestamp": at, NET: col(pa.int32(), 1, 2, None), "m": col(pa.int64(), 1, 2, 3)})
    _write(root, 2, {"timestamp": at, NET: col(pa.float64(), 0.5, 2, 3), "m": col(pa.int32(), 1, 2, 3)})
    _write(root, 3, {"timestamp": at, NET: col(pa.int64(), 7, 8, 9), "extra": col(pa.string(), "a", "b", None)})
    _write(root, 4, {"timestamp": at, NET: col(pa.float32(), 0.25, 1, 1), "m": col(pa.bool_(), True, False, None)})
    _write(root, 5, {"timestamp": at, NET: pa.nulls(3), "m": pa.nulls(3)})
    _write(root, 2, {"timestamp": at, NET: col(pa.int16(), 1, 1, 1)}, arm=5)
    return root


def test_files_of_different_types_are_bound(spark, out_dir):
    root = mixed_series(f"{out_dir}/s")
    df = IO.read_series(spark, root, (0, 5), "VA")
    net = NET.replace(".", "__")
    kinds = dict(df.dtypes)
    assert (kinds[net], kinds["m"], kinds["extra"], kinds["timestamp"]) == ("double", "bigint", "string", "timestamp_ntz")
    got = {(r.bldg_id, r.upgrade): (r.n, r.net, r.m, r.e) for r in df.groupBy("bldg_id", "upgrade").agg(
        F.count(F.lit(1)).alias("n"), F.sum(net).alias("net"), F.sum("m").alias("m"), F.max("extra").alias("e")).collect()}
    assert got == {(1, 0): (3, 3.0, 6, None), (2, 0): (3, 5.5, 6, None), (3, 0): (3, 24.0, None, "b"),
                   (4, 0): (3, 2.25, 1, None), (5, 0): (3, None, None, None), (2, 5): (3, 3.0, None, None)}
    # ids as a list or a table give the same columns, whatever the types of their own files
    for ids in ([2, 3], spark.createDataFrame([(2,), (3,), (99,)], "bldg_id long")):
        some = IO.read_series(spark, root, (0, 5), "VA", ids=ids, check=False)
        assert dict(some.dtypes) == kinds
        assert {r.bldg_id: r.s for r in some.groupBy("bldg_id").agg(F.sum(net).alias("s")).collect()} == {2: 8.5, 3: 24.0}


def test_footers_through_spark_where_only_it_reads_the_store(spark, out_dir, monkeypatch):
    root = mixed_series(f"{out_dir}/s")
    open(f"{root}/upgrade=0/state=VA/9-0.parquet", "wb").write(b"not a parquet file")
    files = IO.checkpoint_table(SF.list_files(spark, root, [f"{root}/upgrade=0"]), f"{out_dir}/files")
    want = sorted(map(tuple, SF.footer_types(files).collect()))
    assert len(want) == 15 and {t[3] for t in want if t[2] == NET} == {"int", "double", "bigint", "float", "void"}

    def unknown(path):
        raise OSError(path)

    monkeypatch.setattr(SF, "_store", unknown)  # travels with the tasks' functions
    assert sorted(map(tuple, SF.footer_types(files).collect())) == want


def test_text_and_numbers_are_not_bound(spark, out_dir):
    _write(f"{out_dir}/s", 1, {"m": pa.array(["a"])})
    _write(f"{out_dir}/s", 2, {"m": pa.array([1])})
    with pytest.raises(ValueError, match="Column m cannot be bound: .*bigint, string"):
        IO.read_series(spark, f"{out_dir}/s", (0,), "VA")


def test_common_types():
    for types, want in (({"int", "double"}, "double"), ({"boolean", "int"}, "int"), ({"float", "int"}, "double"),
                        ({"float", "smallint"}, "float"), ({"void", "string"}, "string"), ({"void"}, "int"),
                        ({"decimal(5,2)", "int"}, "double"), ({"decimal(5,2)"}, "decimal(5,2)"),
                        ({"timestamp"}, "timestamp")):
        assert SF.common_type("c", types) == want


def test_status_of_files_of_different_types(spark, out_dir):
    root = mixed_series(f"{out_dir}/s")
    path = f"{root}/upgrade=0/state=VA/3-0.parquet"
    data = open(path, "rb").read()
    open(path, "wb").write(data[:len(data) // 2])
    df = IO.read_series(spark, root, (0, 5), "VA")
    assert {(r.bldg_id, r.upgrade) for r in df.select("bldg_id", "upgrade").distinct().collect()} == {
        (1, 0), (2, 0), (4, 0), (5, 0), (2, 5)}


def test_many_ids_stay_out_of_the_plan(spark, out_dir):
    """An id table of 200,000 rows is joined with the listing: no id is in the plan, and the
    files are opened in groups."""
    root = mixed_series(f"{out_dir}/s")
    ids = spark.range(1_000_000, 1_200_000).withColumnRenamed("id", "bldg_id").unionByName(
        spark.createDataFrame([(1,), (4,)], "bldg_id long"))
    folders = [f"{root}/upgrade=0/state=VA", f"{root}/upgrade=5/state=VA"]
    found = SF.open_files(spark, root, folders, ids, bound=1)
    assert len(found.parts) == 2 and {(r.bldg_id, r.upgrade) for r in found.files.collect()} == {(1, 0), (4, 0)}
    df = IO.read_series(spark, root, (0, 5), "VA", ids=ids, check=False)
    assert sorted(r.bldg_id for r in df.collect()) == [1, 1, 1, 4, 4, 4]
    plan = df._jdf.queryExecution().toString()
    assert "1000000" not in plan and "1100000" not in plan


def _readings(spark, n=3000):
    return spark.range(n).select(
        (F.col("id") % 7).cast("int").alias("bldg_id"), (F.col("id") % 2 * 5).cast("int").alias("upgrade"), F.lit("VA").alias("state"),
        F.timestamp_micros(F.col("id") * 900_000_000).cast("timestamp_ntz").alias("timestamp"), (F.col("id") * 0.5).alias(NET))


def test_tasks_name_the_files(spark, out_dir):
    root = f"{out_dir}/src"
    IO.write_source_series(_readings(spark), root)
    found = sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if f != "_temporary")
    assert found == sorted(["_SUCCESS", *(f"upgrade={u}/state=VA/{b}-{u}.parquet" for u in (0, 5) for b in range(7))])
    back = IO.read_series(spark, root, (0, 5), "VA")
    want = _readings(spark)
    net = NET.replace(".", "__")
    pick = lambda df, c: sorted((r.bldg_id, r.upgrade, r.timestamp, r[c]) for r in df.collect())
    assert pick(back, net) == pick(want, NET)
    IO.write_source_series(_readings(spark, 14), root)  # overwrites
    assert IO.read_series(spark, root, (0, 5), "VA").count() == 14
    SF.write_files(_readings(spark, 14).where("bldg_id = 1").withColumn("bldg_id", F.lit(50)), root, overwrite=False)  # adds
    assert IO.read_series(spark, root, (0, 5), "VA").count() == 16


def test_a_failed_write_leaves_nothing(spark, out_dir):
    root = f"{out_dir}/src"
    boom = F.when(F.col("bldg_id") == 6, F.raise_error(F.lit("boom"))).otherwise(F.col("bldg_id"))
    df = _readings(spark).withColumn(NET, F.col(f"`{NET}`") + boom.cast("double"))
    with pytest.raises(Exception, match="boom"):
        SF.write_files(df.coalesce(1), root)
    assert not os.path.exists(root) or os.listdir(root) == []


def test_row_groups_of_a_long_series_are_bounded(spark, out_dir, monkeypatch):
    monkeypatch.setattr(SF, "ROW_GROUP", 1000)
    root = f"{out_dir}/src"
    SF.write_files(_readings(spark, 30_000).withColumn("bldg_id", F.lit(3)).withColumn("upgrade", F.lit(0)), root)
    meta = pq.ParquetFile(f"{root}/upgrade=0/state=VA/3-0.parquet").metadata
    assert meta.num_rows == 30_000 and max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 11_000


def _no_scan(monkeypatch, allowed=0):
    """Paths given to Spark's reader, of which there may be ``allowed``; footers are not merged on the driver."""
    given, read = [], SF.SeriesFiles._read

    def spy(self, paths, kind, tolerant=True):
        given.extend(paths)
        assert len(given) <= allowed, given
        return read(self, paths, kind, tolerant)

    def merged(*a):
        raise AssertionError("footers merged once more")

    monkeypatch.setattr(SF.SeriesFiles, "_read", spy)
    monkeypatch.setattr(SF, "merged_schema", merged)
    return given


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_small_files_are_read_in_tasks(spark, out_dir, monkeypatch):
    """No path of a small file is on the driver or in a plan; the rows are those of Spark's reader."""
    root = f"{out_dir}/src"
    IO.write_source_series(_readings(spark), root)
    scanned = _rows(IO.read_series(spark, root, (0, 5), "VA", check=False))
    given = _no_scan(monkeypatch)
    df = IO.read_series(spark, root, (0, 5), "VA")
    assert _rows(df) == scanned and given == []
    assert dict(df.dtypes)["upgrade"] == "int" and dict(df.dtypes)["state"] == "string"
    assert "0.parquet" not in df._jdf.queryExecution().toString()


def test_status_of_small_files_without_a_scan(spark, out_dir, monkeypatch):
    """Only the file without a footer is given to Spark's reader; causes are those of the files."""
    root = f"{out_dir}/src"
    IO.write_source_series(_readings(spark), root)
    with open(f"{root}/upgrade=0/state=VA/1-0.parquet", "r+b") as f:
        f.truncate(300)
        f.seek(0, os.SEEK_END)
        f.write(b"\xfd\xfe\xff\xfe????")  # read as the length of a footer, beyond the integers
    IO.blot_file(spark, f"{root}/upgrade=5/state=VA/2-5.parquet")
    given = _no_scan(monkeypatch, allowed=1)
    files = IO.series_files(spark, root, (0, 5), "VA")
    read = IO.checkpoint_table(IO.count_readings(files.readings()), f"{out_dir}/read")
    found = {(r.bldg_id, r.upgrade): (r.n_expected == r.n_read, r.cause) for r in files.status(read).collect()}
    assert len(found) == 14 and len(given) == 1
    assert {k: v for k, v in found.items() if v != (True, None)} == {
        (1, 0): (False, "footer unreadable"), (2, 5): (False, "data unreadable")}


def test_small_files_of_different_types_without_a_scan(spark, out_dir, monkeypatch):
    root = mixed_series(f"{out_dir}/s")
    monkeypatch.setattr(SF, "SMALL_ROWS", 0)  # all by Spark's reader
    scanned = IO.read_series(spark, root, (0, 5), "VA")
    want, kinds = _rows(scanned), scanned.dtypes
    monkeypatch.setattr(SF, "SMALL_ROWS", 1000)
    given = _no_scan(monkeypatch)
    df = IO.read_series(spark, root, (0, 5), "VA")
    assert (_rows(df), df.dtypes, given) == (want, kinds, [])


def test_tasks_do_not_grow_with_files_of_different_types(spark, out_dir):
    """Every task sends a result of some KB to the driver, so there may not be one for each file."""
    kinds, n = (pa.int32(), pa.float64(), pa.int64()), 600
    at = pa.array([0, 900_000_000], pa.timestamp("us"))
    for b in range(n):
        _write(f"{out_dir}/s", b, {"timestamp": at, NET: pa.array([b, b + 1], kinds[b % 3])})
    sc = spark.sparkContext
    sc.setJobGroup(out_dir, "files of different types")
    try:
        rows = IO.read_series(spark, f"{out_dir}/s", (0,), "VA").groupBy("bldg_id").agg(F.sum(NET.replace(".", "__")).alias("net")).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert {r.bldg_id: r.net for r in rows} == {b: 2.0 * b + 1 for b in range(n)}
    seen = sc.statusTracker()
    stages = {i for j in seen.getJobIdsForGroup(out_dir) for i in seen.getJobInfo(j).stageIds}
    assert 0 < sum(seen.getStageInfo(i).numTasks for i in stages if seen.getStageInfo(i)) < n / 3


def test_files_of_an_id_table_without_a_scan(spark, out_dir, monkeypatch):
    root = f"{out_dir}/src"
    IO.write_source_series(_readings(spark), root)
    ids = spark.createDataFrame([(2,), (2,), (6,), (None,), (99,)], "bldg_id long")
    given = _no_scan(monkeypatch)
    for check in (True, False):
        df = IO.read_series(spark, root, (0, 5), "VA", ids=ids, check=check)
        assert _rows(df) == _rows(IO.read_series(spark, root, (0, 5), "VA").where("bldg_id IN (2, 6)")) and given == []


def test_other_types_and_large_files_are_left_to_spark(spark, out_dir, monkeypatch):
    root = f"{out_dir}/s"
    at = pa.array([0, 900_000_000], pa.timestamp("us", "UTC"))
    _write(root, 1, {"timestamp": at, NET: pa.array([1.0, 2.0])})
    _write(root, 2, {"timestamp": at, NET: pa.array([3.0, 4.0]), "Extra": pa.array([1, 2])})
    files = IO.series_files(spark, root, (0,), "VA")
    assert not files.whole and {f.name for f in files.schema} == {"timestamp", NET, "Extra"}
    assert IO.read_series(spark, root, (0,), "VA").count() == 4
    plain = f"{out_dir}/p"
    IO.write_source_series(_readings(spark, 140), plain)
    monkeypatch.setattr(SF, "SMALL_BYTES", 10)
    assert not IO.series_files(spark, plain, (0, 5), "VA").whole
    assert IO.read_series(spark, plain, (0, 5), "VA").count() == 140
