"""Pools and samples for all scenarios at once."""

from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import fixtures as FX
from loadshift.config import REFERENCE_SCENARIOS, Scenario, scenario_table
from loadshift.operators import sample as SMP
from loadshift.sources import files as IO


@pytest.fixture(scope="module")
def meta(spark, fixture_dir):
    base = IO.read_csv(spark, f"{fixture_dir}/baseline.csv", FX.META_SCHEMA)
    upg = IO.read_csv(spark, f"{fixture_dir}/upgrade.csv", FX.UPGRADE_SCHEMA)
    return base, upg


def pools(spark, meta, scenarios):
    p = SMP.eligible_pool(*meta, scenario_table(spark, scenarios))
    out = {}
    for r in p.select("scenario", "bldg_id").collect():
        out.setdefault(r.scenario, set()).add(r.bldg_id)
    return out


def test_prep_baseline(spark, meta):
    df = SMP.prep_baseline(meta[0], "Single-Family Detached", "Yes")
    ids = sorted(r.bldg_id for r in df.select("bldg_id").collect())
    assert ids == [1, 2, 3, 4, 5, 9, 10, 12, 13]          # spellings of TRUE; NA/False/no ducts/other type out
    r = df.where("bldg_id = 1").collect()[0]
    assert r.heating_electricity_kwh == 3000.0             # strict: hp_bkup excluded
    assert r.thermal_electricity_kwh == 4500.0
    assert r.nonthermal_electricity_kwh == 12001.0 - 4500.0
    assert r.tons == 4.0
    assert df.where("bldg_id = 4").collect()[0].tons is None   # NULL heating size (T4)


def test_pools_all_scenarios(spark, meta):
    got = pools(spark, meta, REFERENCE_SCENARIOS)
    assert got == {"scenario1": {1, 2, 3, 4, 5}, "scenario2": {10, 13}, "scenario3": {13},
                   "scenario4": {1, 2, 3, 4, 5, 10, 13}, "scenario5": {4}}


def test_optional_filters_null_empty_or_all_null(spark, meta):
    scn = [Scenario("a"), Scenario("b", sqft_allowed=()), Scenario("c", vintage_allowed=(None,)),
           Scenario("d", sqft_allowed=(1698,))]
    got = pools(spark, meta, scn)
    assert got["a"] == got["b"] == got["c"] == {1, 2, 3, 4, 5, 10, 13}
    assert got["d"] == {3, 13}


def test_sample_cap_subset_and_reproducible(spark, meta):
    scn = tuple(replace(s, sample_size=3) for s in REFERENCE_SCENARIOS)
    sdf = scenario_table(spark, scn)
    pool = SMP.eligible_pool(*meta, sdf)
    s1 = SMP.draw_sample(pool)
    got = {}
    for r in s1.select("scenario", "bldg_id").collect():
        got.setdefault(r.scenario, set()).add(r.bldg_id)
    sizes = {k: len(v) for k, v in got.items()}
    assert sizes == {"scenario1": 3, "scenario2": 2, "scenario3": 1, "scenario4": 3, "scenario5": 1}
    assert got["scenario1"] <= {1, 2, 3, 4, 5}
    # invariant to partitioning and input order
    shuffled = pool.repartition(7, "bldg_id").orderBy(F.rand(5))
    s2 = SMP.draw_sample(shuffled)
    assert sorted(s1.select("scenario", "bldg_id").collect()) == sorted(s2.select("scenario", "bldg_id").collect())
    # the chosen ids are the smallest hash keys
    keys = pool.where("scenario = 'scenario4'").select(
        "bldg_id", SMP.sample_order_key(F.col("seed"), F.col("bldg_id")).alias("k")).collect()
    expect = {r.bldg_id for r in sorted(keys, key=lambda r: (r.k, r.bldg_id))[:3]}
    assert got["scenario4"] == expect


def test_no_task_ranks_a_whole_scenario(spark, meta):
    sdf = scenario_table(spark, REFERENCE_SCENARIOS)
    s = SMP.draw_sample(SMP.eligible_pool(*meta, sdf))
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    ranks = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert ranks and all("_bucket" in line.split("row_number()")[1] for line in ranks)


def test_empty_pool_stops_only_its_scenario(spark, meta):
    sdf = scenario_table(spark, (Scenario("ok"), Scenario("none", heating_fuel="Wood")))
    s = SMP.draw_sample(SMP.eligible_pool(*meta, sdf))
    assert {r.scenario for r in s.collect()} == {"ok"} and s.count() == 7
    empty = SMP.empty_pools(sdf, s).collect()
    assert [(r.scenario, r.cause) for r in empty] == [("none", "No rows available after filtering")]


def test_sample_summary(spark, meta):
    scn = (Scenario("s5", vintage_allowed=("1990s",), hvac_efficiency=FX.EF, heating_fuel="Electricity"),
           Scenario("s2", hvac_efficiency=FX.GF, heating_fuel="Natural Gas"))
    sdf = scenario_table(spark, scn)
    summ = {r.scenario: r for r in SMP.sample_summary(SMP.draw_sample(SMP.eligible_pool(*meta, sdf))).collect()}
    s5 = summ["s5"]                     # building 4 only: NULL heating size
    assert s5["count"] == 1 and s5.base_tons_heating is None and s5.base_tons_cooling == 2.0
    assert s5.sqft == 2678.0 and s5.cooling_space_conditioned_sqft == 2678.0
    s2 = summ["s2"]                     # buildings 10 (partial NULL) and 13
    assert s2["count"] == 2 and s2.cooling_space_conditioned_sqft is None       # strict mean (T2)
    assert s2.gas_heating == 9.0 and s2.upgrade_tons_heating == pytest.approx((60 + 63) / 2 / 12)
    assert s2["out__load__heating__energy_delivered__mwh"] == pytest.approx(40000 * 0.000293071)


@pytest.mark.parametrize("size", [1, 1500, 5000, 10 ** 6])
def test_large_samples_are_exact(spark, size):
    pool = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("scenario"), F.col("id").alias("bldg_id"),
        F.lit(size).alias("sample_size"), F.lit(123).alias("seed"))
    got = sorted(tuple(r) for r in SMP.draw_sample(pool).select("scenario", "bldg_id").collect())
    import hashlib
    key = lambda i: (hashlib.md5(f"123-{i}".encode()).hexdigest(), i)
    want = [(s, i) for s, ids in (("a", range(0, 20000, 3)), ("b", [i for i in range(20000) if i % 3]))
            for i in sorted(ids, key=key)[:size]]
    assert got == sorted(want)


def test_empty_pools_none_missing(spark):
    scn = spark.createDataFrame([("a",), ("b",)], "scenario string")
    drawn = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "scenario string, bldg_id int")
    assert SMP.empty_pools(scn, drawn).count() == 0


def test_load_scenarios_from_json(tmp_path):
    import json
    from loadshift.config import load_scenarios
    p = tmp_path / "s.json"
    p.write_text(json.dumps([{"scenario": "x", "sqft_allowed": [1698], "heating_fuel": "Electricity"},
                             {"scenario": "y", "sample_size": 5}]))
    got = load_scenarios(str(p))
    assert got[0].sqft_allowed == (1698,) and got[0].building_type == "Single-Family Detached"
    assert got[1].sample_size == 5 and got[1].heating_fuel is None
    p.write_text(json.dumps([{"scenario": "z", "colour": "red"}]))
    with pytest.raises(ValueError, match="unknown scenario fields"):
        load_scenarios(str(p))
