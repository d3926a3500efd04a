"""Reports (D15-D17, D19)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadshift.operators import compare as CMP
from loadshift.operators import report as REP
from loadshift.sources import files as IO
import fixtures as FX

ZONE = "America/New_York"


@pytest.fixture(scope="module")
def cmp(spark, fixture_dir):
    s = IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", schema=FX.SERIES_SCHEMA)
    return CMP.portfolio_compare(s, 3, 0, 5, ZONE).cache()


def test_annual_energy_shape_and_values(cmp):
    rows = REP.annual_energy(cmp).collect()
    assert [r.scenario for r in rows] == ["Baseline", "Baseline (Scaled Up)", "Upgrade"]
    assert rows[0].asDict().keys() == {"scenario", "elec_heating_mwh", "elec_cooling_mwh", "gas_heating_mwh"}
    tot = cmp.agg(F.sum("all_heating_electricity_mwh_base"), F.sum("heating_mwh_scaled"),
                  F.sum("gas_heating_mwh_upg")).collect()[0]
    assert rows[0].elec_heating_mwh == pytest.approx(tot[0])
    assert rows[1].elec_heating_mwh == pytest.approx(tot[1])
    assert rows[2].gas_heating_mwh == pytest.approx(tot[2])


def test_annual_energy_keeps_empty_groups(spark, cmp):
    g = cmp.withColumn("scenario_name", F.lit("s1"))
    groups = spark.createDataFrame([("s1",), ("s2",)], "scenario_name string")
    rows = REP.annual_energy(g, ("scenario_name",), groups).collect()
    assert len(rows) == 6
    assert all(r.elec_heating_mwh == 0.0 for r in rows if r.scenario_name == "s2")


def test_peak_day_profiles(cmp):
    summer = REP.peak_day_profile(cmp, "2018-07-02", "cooling")
    assert summer.columns == ["time_hr", "cooling_kw_base", "cooling_kw_upg", "cooling_kw_scaled"]
    assert summer.count() == 23           # the day's readings end at 00:00 EDT next day
    r = summer.where(F.col("time_hr") == dt.datetime(2018, 7, 2, 16)).collect()[0]
    assert r.cooling_kw_base == pytest.approx(4 * 0.3 * 6 / 3)       # strict cooling, kW per building
    assert r.cooling_kw_upg == pytest.approx(4 * 0.15 * 6 / 3)
    fall = REP.peak_day_profile(cmp, "2018-11-04", "heating")
    assert fall.count() == 24             # 00:00 absent, 01:00 twice


def test_profile_long_labels(cmp):
    prof = REP.peak_day_profile(cmp, "2018-01-07", "heating")
    long = REP.profile_long(prof, "heating")
    labels = {(r.series, r.series_rank) for r in long.select("series", "series_rank").distinct().collect()}
    assert labels == {("Baseline AC (Unscaled)", 1), ("Baseline AC (Scaled Up)", 2), ("GSHP heating", 3)}
    assert long.count() == 3 * prof.count()


def test_recode_keeps_unmatched(spark):
    df = spark.createDataFrame([("base",), ("other",)], "s string")
    got = [r.x for r in df.select(REP.recode(F.col("s"), REP.ARM_LABELS).alias("x")).collect()]
    assert got == ["Baseline", "other"]
