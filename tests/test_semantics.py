
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadshift.functions import columns as C
from loadshift.functions import semantics as S


def one(df):
    return df.collect()[0]


def test_sum0_all_null_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "k int, x double")
    got = {r.k: r.s for r in df.groupBy("k").agg(S.sum0("x").alias("s")).collect()}
    assert got == {1: 0.0, 2: 3.0}
    assert one(df.groupBy("k").agg(F.sum("x").alias("s")).where("k = 1")).s is None  # Spark default differs


def test_mean_strict_and_skipna(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 2.0), (2, 4.0)], "k int, x double")
    got = {r.k: (r.strict, r.skip) for r in
           df.groupBy("k").agg(S.mean_strict("x").alias("strict"), S.mean_skipna("x").alias("skip")).collect()}
    assert got[1] == (None, 1.0)
    assert got[2] == (3.0, 3.0)


def test_pmax_strict(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (3.0, None)], "a double, b double")
    got = [r.m for r in df.select(S.pmax_strict("a", "b").alias("m")).collect()]
    assert got == [2.0, None, None]
    assert [r.g for r in df.select(F.greatest("a", "b").alias("g")).collect()] == [2.0, 2.0, 3.0]


def test_row_sum_skips_null_and_empty_is_zero(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert [r.s for r in df.select(S.row_sum(["a", "b"]).alias("s")).collect()] == [1.0, 0.0]
    assert [r.s for r in df.select(S.row_sum([]).alias("s")).collect()] == [0.0, 0.0]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 0.0), (1.0, None), (3.0, 2.0), (None, 2.0)], "u double, b double")
    got = [r.r for r in df.select(S.safe_ratio("u", "b").alias("r")).collect()]
    assert got == [0.0, 0.0, None, 1.5, None]


def test_extract_number(spark):
    df = spark.createDataFrame([("100% Conditioned",), ("<10% Conditioned",), ("None",), (None,), ("80%",)], "s string")
    got = [r.n for r in df.select(S.extract_number("s").alias("n")).collect()]
    assert got == [1.0, 0.1, None, None, 0.8]


def test_as_bool_by_type(spark):
    df = spark.createDataFrame([("TRUE", 1, True), ("yes", 0, False), ("Y", None, None), ("no", 2, True),
                                (None, 1, None), ("t", 0, False), ("1", 1, True), ("false", 0, False)],
                               "s string, i int, b boolean")
    rows = df.select(S.as_bool(F.col("s"), T.StringType()).alias("s"),
                     S.as_bool(F.col("i"), T.IntegerType()).alias("i"),
                     S.as_bool(F.col("b"), T.BooleanType()).alias("b")).collect()
    assert [r.s for r in rows] == [True, True, True, False, False, True, True, False]
    assert [r.i for r in rows] == [True, False, None, True, True, False, True, False]
    assert [r.b for r in rows] == [True, False, None, True, None, False, True, False]


def test_in_set_never_null(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert [r.m for r in df.select(S.in_set("x", [1, 2]).alias("m")).collect()] == [True, False, False]


def test_units(spark):
    df = spark.createDataFrame([(24.0, 3412.14, 1500.0)], "kbtuh double, kbtu double, kwh double")
    r = one(df.select(S.kbtuh_to_tons("kbtuh").alias("t"), S.kbtu_to_mwh(F.col("kbtu")).alias("m"),
                      S.kwh_to_mwh("kwh").alias("w"), S.mwh_to_kw(F.col("kwh")).alias("k")))
    assert r.t == 2.0 and math.isclose(r.m, 1.0, rel_tol=1e-4) and r.w == 1.5 and r.k == 1.5e6


def test_selectors_strict_vs_broad():
    cols = [C.sanitize(c) for c in [
        "out.electricity.heating.energy_consumption", "out.electricity.heating_hp_bkup.energy_consumption",
        "out.electricity.cooling.energy_consumption", "out.electricity.cooling_fans_pumps.energy_consumption",
        "out.electricity.cooling.energy_consumption.kwh", "out.load.cooling.energy_delivered.kbtu"]]
    assert C.strict_thermal(cols, "heating") == ["out__electricity__heating__energy_consumption"]
    assert C.strict_thermal(cols, "cooling") == ["out__electricity__cooling__energy_consumption"]
    assert C.broad_thermal(cols, "cooling") == ["out__electricity__cooling__energy_consumption",
                                                "out__electricity__cooling_fans_pumps__energy_consumption"]
    assert C.broad_thermal(cols, "heating") == ["out__electricity__heating__energy_consumption",
                                                "out__electricity__heating_hp_bkup__energy_consumption"]
    assert C.strict_thermal(cols, "cooling", C.STRICT_METADATA) == ["out__electricity__cooling__energy_consumption__kwh"]


def test_sanitize_roundtrip(spark):
    df = spark.createDataFrame([(1, 2.0)], "`in.sqft` int, `out.a.b` double")
    s = C.sanitize_columns(df)
    assert s.columns == ["in__sqft", "out__a__b"]
    assert C.restore_columns(s).columns == ["in.sqft", "out.a.b"]
