"""Scans and sinks: CSV with NA and dotted names, series file pruning, failed reads."""

import os

from pyspark.sql import functions as F

import fixtures as FX
from loadshift.functions import columns as C
from loadshift.sources import files as IO


def _num_files(df):
    df.collect()                      # same QueryExecution as the plan read below
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(p):
        m = p.metrics()
        if m.contains("numFiles"):
            found.append(m.apply("numFiles").value())
        it = p.children().iterator()
        while it.hasNext():
            walk(it.next())
    walk(plan)
    return sum(found)


def test_read_csv_na_and_dotted_names(spark, fixture_dir):
    df = IO.read_csv(spark, f"{fixture_dir}/baseline.csv", FX.META_SCHEMA)
    assert "in__sqft" in df.columns and "out__params__size_heating_system_primary_k_btu_h" in df.columns
    assert df.where("bldg_id = 7").collect()[0].applicability is None
    assert df.where("bldg_id = 10").collect()[0].in__hvac_cooling_partial_space_conditioning is None


def test_series_reads_only_requested_files(spark, fixture_dir):
    ids = spark.createDataFrame([(2,), (5,)], "bldg_id int")
    df = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", ids=[2, 5])
    assert _num_files(df) == 2            # 2-0 and 2-5 only; 5-* do not exist
    assert {r.bldg_id for r in df.select("bldg_id").distinct().collect()} == {2}
    # ids as a table are applied with a semi-join: same rows, same columns
    df2 = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", ids=ids)
    assert df2.count() == df.count() and set(df2.columns) == set(df.columns)


def test_no_requested_file(spark, fixture_dir):
    for ids in ([77], spark.createDataFrame([(77,)], "bldg_id int")):
        assert IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", ids=ids).count() == 0


def _source_files(spark, root, extra=None):
    """Two buildings, several row groups each; the second's file lacks a measure."""
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq
    d = f"{root}/upgrade=0/state=VA"
    os.makedirs(d)
    for i in (1, 2):
        n = 4000
        df = pd.DataFrame({"timestamp": pd.date_range("2018-01-01", periods=n, freq="15min").astype("datetime64[us]"),
                           "out.electricity.net.energy_consumption": [float(x % 97) + i for x in range(n)],
                           **({"bldg_id": [i] * n} if extra else {})})
        if i == 1:
            df["out.natural_gas.heating.energy_consumption"] = 1.5
        pq.write_table(pa.Table.from_pandas(df), f"{d}/{i}-0.parquet", row_group_size=500, compression="none",
                       use_dictionary=False)
    return d


def _damage(path, at):
    with open(path, "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * 400)


def test_damaged_row_group_drops_the_building_and_arm(spark, out_dir):
    import pyarrow.parquet as pq
    d = _source_files(spark, f"{out_dir}/s")
    meta = pq.ParquetFile(f"{d}/1-0.parquet").metadata
    _damage(f"{d}/1-0.parquet", meta.row_group(4).column(1).data_page_offset)
    whole = IO.read_series(spark, f"{out_dir}/s", (0,), "VA")
    assert {r.bldg_id: r["count"] for r in whole.groupBy("bldg_id").count().collect()} == {2: 4000}
    raw = IO.read_series(spark, f"{out_dir}/s", (0,), "VA", check=False)
    net = "out__electricity__net__energy_consumption"
    read = IO.checkpoint_table(raw.groupBy("bldg_id", "upgrade").agg(F.count(F.lit(1)).alias("n_read"), F.sum(net).alias("x")),
                               f"{out_dir}/read")
    st = {r.bldg_id: (r.n_expected, r.cause) for r in
          IO.series_status(spark, f"{out_dir}/s", (0,), "VA", read).collect()}
    assert st == {1: (4000, "data unreadable"), 2: (4000, None)}


def test_damage_in_a_column_that_is_not_asked_for(spark, out_dir):
    import pyarrow.parquet as pq
    d = _source_files(spark, f"{out_dir}/s")
    meta = pq.ParquetFile(f"{d}/1-0.parquet").metadata
    gas = [i for i in range(meta.num_columns) if meta.schema.column(i).name.startswith("out.natural_gas")
           or "natural_gas" in meta.row_group(0).column(i).path_in_schema][0]
    _damage(f"{d}/1-0.parquet", meta.row_group(4).column(gas).data_page_offset)
    count = lambda measure: {r.bldg_id: r["count"] for r in IO.read_series(
        spark, f"{out_dir}/s", (0,), "VA", measures=[measure]).groupBy("bldg_id").count().collect()}
    assert count("out.electricity.net.energy_consumption") == {1: 4000, 2: 4000}
    assert count("out.natural_gas.heating.energy_consumption") == {2: 4000}


def test_columns_are_bound_by_name_with_and_without_an_id_column(spark, out_dir):
    for extra in (False, True):
        root = f"{out_dir}/{extra}"
        _source_files(spark, root, extra)
        df = IO.read_series(spark, root, (0,), "VA", ids=[1, 2])
        gas = "out__natural_gas__heating__energy_consumption"
        sums = {r.bldg_id: r.g for r in df.groupBy("bldg_id").agg(F.sum(gas).alias("g")).collect()}
        assert sums == {1: 6000.0, 2: None}


def test_source_layout_round_trip(spark, fixture_dir, out_dir):
    src = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", schema=FX.SERIES_SCHEMA)
    root = IO.write_source_series(C.restore_columns(src), f"{out_dir}/src")
    names = sorted(f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))
    assert "2-0.parquet" in names and "2-5.parquet" in names
    back = IO.read_series(spark, root, (0, 5), "VA")
    cols = sorted(src.columns)
    assert sorted(map(str, back.select(cols).collect())) == sorted(map(str, src.select(cols).collect()))


def test_load_status_and_failed_reads(spark, fixture_dir):
    req = spark.createDataFrame([("s", 1), ("s", 4), ("s", 5), ("t", 2)], "scenario string, bldg_id int")
    series = IO.read_series(spark, f"{fixture_dir}/series", (0,), "VA", schema=FX.SERIES_SCHEMA)
    st = {(r.scenario, r.bldg_id): r.loaded for r in IO.load_status(req, series).collect()}
    assert st == {("s", 1): True, ("s", 4): False, ("s", 5): False, ("t", 2): True}
    failed = sorted((r.scenario, r.bldg_id) for r in IO.failed_reads(req, series).collect())
    assert failed == [("s", 4), ("s", 5)]


def test_write_csv_restores_names_and_na(spark, out_dir):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, 1.5)], "scenario string, `in.sqft` int, `out.x` double")
    df = C.sanitize_columns(df)
    path = IO.write_csv(df, os.path.join(out_dir, "t"), partition_by=["scenario"])
    files = [f for f in os.listdir(os.path.join(path, "scenario=a")) if f.endswith(".csv")]
    text = open(os.path.join(path, "scenario=a", files[0])).read()
    assert text.splitlines()[0] == "in.sqft,out.x" and text.splitlines()[1] == "1,NA"
    back = IO.read_csv(spark, path, "`in.sqft` int, `out.x` double, scenario string")
    assert sorted(back.collect()) == sorted(df.select("in__sqft", "out__x", "scenario").collect())


def test_series_binds_by_name(spark, fixture_dir):
    # building 3's upgrade file lacks the fuel-oil column: bind by name, NULL fill
    df = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", ids=[3])
    fo = "out__fuel_oil__heating__energy_consumption"
    assert fo in df.columns
    assert df.where(f"upgrade = 5 AND {fo} IS NOT NULL").count() == 0
    assert df.where(f"upgrade = 0 AND {fo} IS NOT NULL").count() > 0


def test_arm_load_status_one_scan(spark, fixture_dir):
    req = spark.createDataFrame([("s", 1), ("s", 4), ("t", 2)], "scenario string, bldg_id int")
    series = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", schema=FX.SERIES_SCHEMA)
    st = IO.arm_load_status(req, series, (0, 5))
    got = sorted((r.scenario, r.bldg_id, r.upgrade, r.loaded) for r in st.collect())
    assert got == [("s", 1, 0, True), ("s", 1, 5, True), ("s", 4, 0, False), ("s", 4, 5, False),
                   ("t", 2, 0, True), ("t", 2, 5, True)]
    from test_plans import leaves
    raw = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", schema=FX.SERIES_SCHEMA, check=False)
    assert leaves(spark, lambda: IO.arm_load_status(req, raw, (0, 5))).count("Scan parquet ") == 1


def test_spark_native_layout_pushes_id_filter(spark, fixture_dir, out_dir):
    src = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", schema=FX.SERIES_SCHEMA)
    restored = C.restore_columns(src).drop("state").withColumn("state", F.lit("VA"))
    root = IO.write_series(restored, os.path.join(out_dir, "native"))
    df = IO.read_series(spark, root, (0, 5), "VA", ids=[2, 3], layout="table")
    from loadshift.plans.inspect import plan_summary
    (scan,) = plan_summary(df)["scans"]
    assert "In(bldg_id, [2,3])" in scan[1]
    cols = [c for c in src.columns if c != "state"]
    want = sorted(src.where("bldg_id IN (2, 3)").select(cols).collect())
    assert sorted(df.select(cols).collect()) == want


def test_write_series_keeps_all_rows(spark, fixture_dir, out_dir):
    src = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", schema=FX.SERIES_SCHEMA)
    root = IO.write_series(C.restore_columns(src), os.path.join(out_dir, "native"))
    assert spark.read.parquet(root).count() == src.count()


def test_checkpoint_table_empty_and_partitioned(spark, out_dir):
    df = spark.createDataFrame([("a", 1, 2.0)], "scenario string, k int, v double").where("k > 5")
    back = IO.checkpoint_table(df, os.path.join(out_dir, "empty"), partition_by=["scenario"])
    assert back.count() == 0 and back.columns == df.columns
    full = spark.createDataFrame([("a", 1, 2.0), ("b", 2, 3.0)], "scenario string, k int, v double")
    back = IO.checkpoint_table(full, os.path.join(out_dir, "full"), partition_by=["scenario"])
    assert back.columns == full.columns and sorted(back.collect()) == sorted(full.collect())


def test_stray_file_name_gives_null_id(spark, fixture_dir, out_dir):
    import shutil
    root = os.path.join(out_dir, "stray")
    shutil.copytree(f"{fixture_dir}/series/upgrade=0", os.path.join(root, "upgrade=0"))
    shutil.copy(os.path.join(root, "upgrade=0", "state=VA", "1-0.parquet"),
                os.path.join(root, "upgrade=0", "state=VA", "notes.parquet"))
    df = IO.read_series(spark, root, (0,), "VA", schema=FX.SERIES_SCHEMA)
    ids = {r.bldg_id for r in df.select("bldg_id").distinct().collect()}
    assert ids == {1, 2, 3, None}
    assert {r.bldg_id for r in IO.read_series(spark, root, (0,), "VA", ids=[1]).select("bldg_id").distinct().collect()} == {1}


def test_series_without_schema_binds_by_name(spark, fixture_dir):
    # no ids, no schema: all footers merged; the corrupt files are skipped
    df = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA")
    fo = "out__fuel_oil__heating__energy_consumption"
    assert fo in df.columns
    assert df.where(f"bldg_id = 3 AND upgrade = 5 AND {fo} IS NOT NULL").count() == 0
    assert {r.bldg_id for r in df.select("bldg_id").distinct().collect()} == {1, 2, 3}
