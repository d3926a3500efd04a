
import os

import pytest
from pyspark.sql import functions as F

import fixtures as FX
from loadshift.config import REFERENCE_SCENARIOS, JobParams
from loadshift.plans import job


@pytest.fixture(scope="module")
def result(spark, fixture_dir):
    import tempfile
    out = tempfile.mkdtemp(prefix="loadshift-job-")
    res = job.run(spark, f"{fixture_dir}/baseline.csv", f"{fixture_dir}/upgrade.csv", f"{fixture_dir}/series",
                  out, JobParams(), REFERENCE_SCENARIOS, FX.META_SCHEMA, FX.UPGRADE_SCHEMA)
    return out, res


def test_outputs_written(result):
    out, _ = result
    for t in ("bldg_ids/applicable_buildings", "bldg_ids/sample_average", "results/combined_8760",
              "results/all_buildings_summer_peak_hr", "results/all_buildings_winter_peak_hr",
              "results/annual_energy_consumption", "results/summer_peak_day", "results/winter_peak_day",
              "results/failed_reads"):
        assert os.path.isdir(os.path.join(out, t)), t
    assert os.path.isdir(os.path.join(out, "results/combined_8760/scenario=scenario1"))


def test_divisor_is_requested_count(result, spark):
    _, res = result
    cmp = res["combined_8760"].where("scenario = 'scenario1'")
    # scenario1 requested 1..5; only 1,2,3 have series; the mean divides by 5
    r = cmp.where("month = 1 AND day = 7 AND hour = 9").collect()[0]
    assert r.total_electricity_mwh_base == pytest.approx(4 * 2.0 * 6 / 1000 / 5)
    failed = sorted((x.scenario, x.bldg_id, x.upgrade) for x in res["failed_reads"].collect())
    assert ("scenario1", 4, 0) in failed and ("scenario1", 5, 5) in failed
    assert {b for _, b, _ in failed} == {4, 5, 10, 13}      # every sampled id without series files


def test_peak_slices_identities(result):
    _, res = result
    summer = res["summer_peak_hr"].where("scenario = 'scenario4'")
    rows = summer.collect()
    assert sorted(r.bldg_id for r in rows) == [1, 2, 3]
    for r in rows:
        assert r.sqft_conditioned == pytest.approx(r.in__sqft * r.in__hvac_cooling_partial_space_conditioning)
        assert r.baseline_cooling_total_elec_kwh == pytest.approx(
            r.baseline_cooling_elec_kwh + r.baseline_cooling_fans_pumps_elec_kwh)
        assert r.hour == 16 and r.month == 7
    assert res["winter_peak_hr"].where("scenario = 'scenario4'").count() == 3


def test_reports(result):
    _, res = result
    ann = res["annual_energy_consumption"]
    assert ann.count() == 15
    lab = {r.scenario_name: r.label for r in ann.select("scenario_name", "label").distinct().collect()}
    assert lab["scenario2"] == "Gas Furnace + Central AC"
    # scenario5 (building 4 only: corrupt file) has no hours -> zeros
    z = ann.where("scenario_name = 'scenario5'").collect()
    assert len(z) == 3 and all(r.elec_heating_mwh == 0.0 for r in z)
    summer = res["summer_peak_day"].where("scenario_name = 'scenario1'")
    assert summer.count() == 23


def test_missing_input_is_reported(spark, fixture_dir, out_dir):
    with pytest.raises(FileNotFoundError, match="Missing file: .*nope.csv"):
        job.run(spark, f"{fixture_dir}/nope.csv", f"{fixture_dir}/upgrade.csv", f"{fixture_dir}/series", out_dir)


def test_report_text_time(result):
    out, _ = result
    d = os.path.join(out, "results", "winter_peak_day", "scenario_id=scenario1")
    text = "".join(open(os.path.join(d, f)).read() for f in os.listdir(d) if f.endswith(".csv"))
    lines = text.splitlines()
    assert "2018-01-07" in [ln.split(",")[0] for ln in lines]          # midnight: date only
    assert any(ln.startswith("2018-01-07 07:00:00,") for ln in lines)


def test_cli_stages(spark, fixture_dir, out_dir):
    args = ["--baseline", f"{fixture_dir}/baseline.csv", "--upgrade", f"{fixture_dir}/upgrade.csv",
            "--series", f"{fixture_dir}/series", "--out", out_dir, "--scenarios", "scenario1,scenario4"]
    job.main(args + ["--stage", "select"])
    job.main(args + ["--stage", "series"])
    job.main(args + ["--stage", "analyze"])
    ann = spark.read.option("header", True).csv(os.path.join(out_dir, "results", "annual_energy_consumption"))
    assert sorted({r.scenario_id for r in ann.collect()}) == ["scenario1", "scenario4"]
    assert ann.count() == 6


def test_analyze_without_series_stage_is_reported(spark, out_dir):
    with pytest.raises(FileNotFoundError, match="combined_8760"):
        job.analyze_results(spark, out_dir, JobParams())


def test_lazy_extras(result):
    _, res = result
    hp = res["hourly_portfolio"].where("scenario_name = 'scenario1' AND upgrade = 0")
    cmp = res["combined_8760"].where("scenario = 'scenario1'")
    a = {r.hour_utc: r.total_electricity_mwh for r in hp.collect()}
    b = {r.hour_utc: r.total_electricity_mwh_base for r in cmp.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    hours = res["building_hours"]
    assert hours.count() > 0 and {r.bldg_id for r in hours.select("bldg_id").distinct().collect()} == {1, 2, 3}


def test_empty_pool_stops_only_its_scenario(spark, fixture_dir, out_dir):
    from loadshift.config import Scenario
    scn = (REFERENCE_SCENARIOS[0], Scenario("nothing", heating_fuel="Wood"))
    res = job.run(spark, f"{fixture_dir}/baseline.csv", f"{fixture_dir}/upgrade.csv", f"{fixture_dir}/series", out_dir,
                  JobParams(), scn, FX.META_SCHEMA, FX.UPGRADE_SCHEMA)
    assert res["combined_8760"].select("scenario").distinct().count() == 1
    empty = spark.read.option("header", True).csv(f"{out_dir}/bldg_ids/empty_pools").collect()
    assert [r.scenario for r in empty] == ["nothing"]


def test_cli_parameters(spark, fixture_dir, out_dir):
    job.main(["--baseline", f"{fixture_dir}/baseline.csv", "--upgrade", f"{fixture_dir}/upgrade.csv",
              "--series", f"{fixture_dir}/series", "--out", out_dir, "--scenarios", "scenario1", "--seed", "9",
              "--sample-size", "2", "--winter-peak-hour", "2018-01-07 08:00:00", "--state", "VA"])
    peak = spark.read.parquet(f"{out_dir}/results/building_hours")
    assert peak.count() > 0
    ids = spark.read.option("header", True).csv(f"{out_dir}/bldg_ids/applicable_buildings")
    assert ids.count() == 2
    d = f"{out_dir}/results/all_buildings_winter_peak_hr"
    got = spark.read.option("header", True).csv(d)
    assert {r.hour for r in got.select("hour").collect()} <= {"8"}


def test_run_with_series_schema(spark, fixture_dir, out_dir):
    res = job.run(spark, f"{fixture_dir}/baseline.csv", f"{fixture_dir}/upgrade.csv", f"{fixture_dir}/series",
                  out_dir, JobParams(), REFERENCE_SCENARIOS, FX.META_SCHEMA, FX.UPGRADE_SCHEMA,
                  series_schema=FX.SERIES_SCHEMA)
    assert res["annual_energy_consumption"].count() == 15
    assert res["summer_peak_hr"].where("scenario = 'scenario4'").count() == 3
