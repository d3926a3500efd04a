"""Roll-ups and arm comparison on the hand-made series (FIXTURES.md F2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as FX
from loadshift.operators import compare as CMP
from loadshift.operators import rollup as R
from loadshift.sources import files as IO

ZONE = "America/New_York"


@pytest.fixture(scope="module")
def series(spark, fixture_dir):
    return IO.read_series(spark, f"{fixture_dir}/series", (0, 5), "VA", schema=FX.SERIES_SCHEMA).cache()


def test_read_series_skips_corrupt_and_other_state(series):
    ids = sorted(r.bldg_id for r in series.select("bldg_id").distinct().collect())
    assert ids == [1, 2, 3]
    assert "out__electricity__net__energy_consumption" in series.columns
    assert series.where("bldg_id = 3 AND upgrade = 5 AND "
                        "out__fuel_oil__heating__energy_consumption IS NOT NULL").count() == 0


def test_per_building_values_and_fall_back_merge(series):
    b = R.hourly_by_building(series.where("upgrade = 0"), "baseline", ZONE)
    r = b.where("bldg_id = 2 AND year = 2018 AND month = 1 AND day = 7 AND hour = 9").collect()[0]
    assert r.baseline_total_elec_kwh == pytest.approx(16.0)
    assert r.baseline_heating_elec_kwh == pytest.approx(6.0)          # broad: heating + hp_bkup
    assert r.baseline_cooling_total_elec_kwh == pytest.approx(3.2)    # broad: cooling + fans
    assert r.baseline_cooling_fans_pumps_elec_kwh == pytest.approx(0.8)
    assert r["baseline__cooling__energy__kbtu__CP"] == pytest.approx(16.0)
    fb = b.where("bldg_id = 2 AND month = 11 AND day = 4 AND hour = 1").collect()
    assert len(fb) == 1 and fb[0].baseline_total_elec_kwh == pytest.approx(32.0)   # 8 readings merged
    # an hour whose readings are all NULL sums to 0
    z = b.where("bldg_id = 1 AND month = 7 AND day = 2 AND hour = 12").collect()[0]
    assert z.baseline_total_elec_kwh == 0.0 and z.baseline_heating_elec_kwh == 0.0


def test_sum_of_hours_equals_sum_of_readings(series):
    b = R.hourly_by_building(series.where("upgrade = 0"), "baseline", ZONE)
    raw = series.where("upgrade = 0").agg(F.sum("out__electricity__net__energy_consumption")).collect()[0][0]
    hourly = b.agg(F.sum("baseline_total_elec_kwh")).collect()[0][0]
    assert hourly == pytest.approx(raw)


def test_portfolio_keeps_both_fall_back_instants(series):
    p = R.hourly_portfolio(series.where("upgrade = 0"), 3, ZONE)
    fb = p.where("month = 11 AND day = 4 AND hour = 1").collect()
    assert len(fb) == 2 and all(r.interval_count == 12 for r in fb)
    # strict heating set (no hp_bkup): 4 readings x 0.5 x (1+2+3) / 1000 / 3
    r = p.where("month = 1 AND day = 7 AND hour = 9").collect()[0]
    assert r.all_heating_electricity_mwh == pytest.approx(4 * 0.5 * 6 / 1000 / 3)
    assert r.heating_load_kbtu == pytest.approx(4 * 3.0 * 6)          # loads are not scaled (T14)


def test_portfolio_times_n_equals_building_sum(series):
    p = R.hourly_portfolio(series.where("upgrade = 0"), 3, ZONE).where("NOT (month = 11 AND day = 4 AND hour = 1)")
    b = R.hourly_by_building(series.where("upgrade = 0"), "baseline", ZONE)
    bs = b.groupBy("year", "month", "day", "hour").agg(F.sum("baseline_total_elec_kwh").alias("s"))
    j = p.join(bs, ["year", "month", "day", "hour"]).select(
        (F.col("total_electricity_mwh") * 1000 * 3 - F.col("s")).alias("d")).collect()
    assert len(j) > 90 and max(abs(r.d) for r in j) < 1e-9


def test_onepass_equals_join_form(series):
    one = CMP.portfolio_compare(series, 3, 0, 5, ZONE)
    hb = R.hourly_portfolio(series.where("upgrade = 0"), 3, ZONE)
    hu = R.hourly_portfolio(series.where("upgrade = 5"), 3, ZONE)
    two = CMP.compare_arms(hb, hu)
    assert one.columns == two.columns
    cols = [c for c in one.columns]
    r1 = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in one.select(cols).collect())
    r2 = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in two.select(cols).collect())
    assert r1 == r2


def test_building_compare_left_join_semantics(series):
    bhc = CMP.building_hour_compare(series, 0, 5, ZONE)
    missing = bhc.where("bldg_id = 1 AND month = 7 AND day = 2 AND hour = 14").collect()[0]
    assert missing.baseline_total_elec_kwh == pytest.approx(8.0)
    assert missing.upgrade_total_elec_kwh is None
    ok = bhc.where("bldg_id = 1 AND month = 7 AND day = 2 AND hour = 15").collect()[0]
    assert ok.upgrade_total_elec_kwh == pytest.approx(4.0)
    assert missing.time_hour == dt.datetime(2018, 7, 2, 14)
    # same as joining two per-arm roll-ups
    b1 = R.hourly_by_building(series.where("upgrade = 0"), "baseline", ZONE)
    u1 = R.hourly_by_building(series.where("upgrade = 5"), "upgrade", ZONE)
    j = CMP.join_building_arms(b1, u1)
    assert sorted(j.columns) == sorted(bhc.columns)
    assert j.count() == bhc.count()
    assert j.exceptAll(j.select(*bhc.columns)).count() == 0


def test_peak_hour_prefilter_matches_full(series):
    hours = ["2018-07-02 16:00:00", "2018-01-07 07:00:00"]
    fast = CMP.building_hour_compare(series, 0, 5, ZONE, only_local_hours=hours)
    full = CMP.building_hour_compare(series, 0, 5, ZONE)
    for h in hours:
        a = sorted(CMP.peak_hour_slice(fast, h).collect())
        b = sorted(CMP.peak_hour_slice(full, h).collect())
        assert a == b and len(a) == 3


def test_ratio_zero_base_load_and_missing_upgrade(spark):
    rows = [(1, 0, dt.datetime(2018, 1, 7, 3, 15), 1.0, 0.0), (1, 5, dt.datetime(2018, 1, 7, 3, 15), 0.5, 2.0),
            (1, 0, dt.datetime(2018, 1, 7, 5, 15), 1.0, 4.0)]
    df = spark.createDataFrame(rows, "bldg_id int, upgrade int, timestamp timestamp_ntz, "
                                     "out__electricity__heating__energy_consumption double, "
                                     "out__load__heating__energy_delivered__kbtu double")
    out = {r.hour: r for r in CMP.portfolio_compare(df, 1, 0, 5, ZONE).collect()}
    assert out[3].heating_load_ratio == 0.0 and out[3].heating_mwh_scaled == 0.0
    assert out[5].heating_load_ratio is None and out[5].heating_mwh_scaled is None
    assert out[5].interval_count_upg is None and out[5].total_electricity_mwh_upg is None
    assert out[3].total_electricity_mwh_base == 0.0     # measure absent from the input -> 0


def test_cube_derivations_equal_direct_rollups(spark, series):
    cube = R.hour_cube(series)
    p1 = R.portfolio_from_cube(cube, 3, ZONE)
    p2 = R.hourly_portfolio(series, 3, ZONE)
    rnd = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(p2.columns).collect())
    assert rnd(p1) == rnd(p2)
    b1 = R.building_hours_from_cube(cube, 5, "upgrade", ZONE)
    b2 = R.hourly_by_building(series.where("upgrade = 5"), "upgrade", ZONE)
    rb = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(b2.columns).collect())
    assert rb(b1) == rb(b2)


def test_type_labels_and_compare_drops_them(series):
    labels = {0: "Baseline", 5: "Upgrade"}
    p = R.hourly_portfolio(series, 3, ZONE, arm_labels=labels)
    assert {(r.upgrade, r.type) for r in p.select("upgrade", "type").distinct().collect()} == {(0, "Baseline"), (5, "Upgrade")}
    c = CMP.compare_arms(p.where("upgrade = 0"), p.where("upgrade = 5"))
    assert "type" not in c.columns and "upgrade" not in c.columns
