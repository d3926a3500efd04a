"""Restartable stages, bad CSV lines, numbering without one task, buckets, one evaluation of the pool."""

import os

import fixtures as FX
import pytest
from pyspark.sql import functions as F

from loadshift.config import REFERENCE_SCENARIOS, JobParams
from loadshift.operators import compare as CMP
from loadshift.operators import order as ORD
from loadshift.operators import rollup as R
from loadshift.plans import job
from loadshift.plans import queries as Q
from loadshift.plans.inspect import plan_summary
from loadshift.plans.stages import Stages
from loadshift.sources import bucketed as B
from loadshift.sources import driver_views as V
from loadshift.sources import files as IO
from loadshift.sources import series_files as SF

SF01 = "/root/testdata/sf0.01"


def _run(spark, fixture_dir, out, params=JobParams(), scenarios=REFERENCE_SCENARIOS, **kw):
    stages = Stages(spark, out, **kw)
    res = job.run(spark, f"{fixture_dir}/baseline.csv", f"{fixture_dir}/upgrade.csv", f"{fixture_dir}/series", out, params,
                  scenarios, FX.META_SCHEMA, FX.UPGRADE_SCHEMA, stages=stages)
    return stages, res


def test_a_rerun_reuses_finished_stages(spark, fixture_dir, out_dir, monkeypatch):
    whole = CMP.portfolio_compare_from_cube

    def fails(*a, **k):
        raise RuntimeError("the cluster went away")

    monkeypatch.setattr(CMP, "portfolio_compare_from_cube", fails)
    with pytest.raises(RuntimeError, match="went away"):
        _run(spark, fixture_dir, out_dir)
    monkeypatch.setattr(CMP, "portfolio_compare_from_cube", whole)
    sample = f"{out_dir}/_work/sample/_SUCCESS"
    written = os.path.getmtime(sample)
    stages, res = _run(spark, fixture_dir, out_dir)
    assert stages.reused == ["baseline_metadata", "upgrade_metadata", "bad_records", "sample", "hour_cube/part=0",
                             "footer_counts/part=0", "series_status"]
    assert stages.built == ["combined_8760", "building_hours", "series_reports", "reports"]
    assert os.path.getmtime(sample) == written
    first = sorted(map(str, res["annual_energy_consumption"].collect()))
    again, res = _run(spark, fixture_dir, out_dir)
    assert again.built == [] and sorted(map(str, res["annual_energy_consumption"].collect())) == first
    # another peak hour touches neither the sample nor the cube; another seed builds everything after the metadata
    other, _ = _run(spark, fixture_dir, out_dir, JobParams(summer_peak_hour="2018-07-02 15:00:00"))
    assert "hour_cube/part=0" in other.reused and "sample" in other.reused and "series_reports" in other.built
    from dataclasses import replace
    seeded, _ = _run(spark, fixture_dir, out_dir, scenarios=tuple(replace(s, seed=5) for s in REFERENCE_SCENARIOS))
    assert seeded.reused == ["baseline_metadata", "upgrade_metadata", "bad_records"]
    fresh, _ = _run(spark, fixture_dir, out_dir, resume=False)
    assert fresh.reused == []


def test_changed_inputs_are_read_again(spark, fixture_dir, out_dir):
    import shutil
    csv = f"{out_dir}/baseline.csv"
    shutil.copy(f"{fixture_dir}/baseline.csv", csv)
    upg = f"{fixture_dir}/upgrade.csv"
    read = lambda: (st := Stages(spark, f"{out_dir}/o")) and job.read_inputs(st, csv, upg, FX.META_SCHEMA, FX.UPGRADE_SCHEMA) and st
    assert read().reused == [] and read().built == []
    with open(csv) as f:
        lines = f.read().splitlines()
    with open(csv, "w") as f:
        f.write("\n".join(lines[:-1]) + "\n")
    again = read()
    assert again.built == ["baseline_metadata", "bad_records"] and again.reused == ["upgrade_metadata"]


def test_a_stage_without_manifest_is_named(spark, out_dir):
    with pytest.raises(FileNotFoundError, match="stage sample has not finished"):
        Stages(spark, out_dir).key("sample")


def test_groups_of_files_give_the_same_job(spark, fixture_dir, out_dir, monkeypatch):
    _, one = _run(spark, fixture_dir, f"{out_dir}/one")
    opened = SF.open_files
    monkeypatch.setattr(SF, "open_files", lambda *a, **k: opened(*a, **{**k, "bound": 2}))
    stages, many = _run(spark, fixture_dir, f"{out_dir}/many")
    assert sum(n.startswith("hour_cube/") for n in stages.built) > 1
    # sums of other groups differ in the last bits
    near = lambda df: [pytest.approx([v for v in r if isinstance(v, float)]) for r in by_key(df)]
    by_key = lambda df: sorted(df.collect(), key=lambda r: str([v for v in r if not isinstance(v, float)]))
    floats = lambda df: [[v for v in r if isinstance(v, float)] for r in by_key(df)]
    for t in ("annual_energy_consumption", "failed_reads", "combined_8760", "building_hours"):
        assert floats(many[t]) == near(one[t]), t


def test_bad_lines_are_listed_with_their_file(spark, out_dir):
    path = f"{out_dir}/meta.csv"
    with open(path, "w") as f:
        f.write('bldg_id,in.sqft,name\n1,900,a\n2,oops,b\n3,800\n4,700,c,more\n5,NA,"x, y"\n6,,\n')
    schema = "bldg_id int, `in.sqft` int, name string"
    bad = {r.line: (r.file, r.parsed) for r in IO.bad_records(spark, path, schema).collect()}
    assert bad == {"2,oops,b": ("meta.csv", '{"bldg_id":2,"name":"b"}'), "3,800": ("meta.csv", '{"bldg_id":3,"in.sqft":800}'),
                   "4,700,c,more": ("meta.csv", '{"bldg_id":4,"in.sqft":700,"name":"c"}')}
    assert IO.bad_records(spark, path, schema).select("line").count() == 3  # whatever is selected
    kept = {r.bldg_id: (r.in__sqft, r.name) for r in IO.read_csv(spark, path, schema).collect()}
    assert kept == {1: (900, "a"), 2: (None, "b"), 3: (800, None), 4: (700, "c"), 5: (None, "x, y"), 6: (None, None)}


def test_rows_are_numbered_in_order_without_one_task(spark):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("k"), "id")
    out = ORD.numbered(df, ["k", "id"])
    rows = sorted((r.row_number, r.k, r.id) for r in out.collect())
    assert [r[0] for r in rows] == list(range(1, 5001)) and [r[1:] for r in rows] == sorted(r[1:] for r in rows)
    text = Q.QUERIES["report_text_8760"](spark, SF01)._jdf.queryExecution().toString()
    assert "Coalesce 1" not in text
    assert ORD.numbered(df.limit(0), ["k"]).count() == 0


def test_bucketed_arms_join_without_exchange(spark, out_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cube = R.wall_cube(R.hour_cube(V.readings(spark, SF01)))
        table = B.write_bucketed(cube, f"{out_dir}/cube", R.BUCKET_KEYS, buckets=6)
        joined = CMP.join_building_arms(*[R.building_hours_from_wall_cube(table, a, n) for a, n in ((0, "baseline"), (1, "upgrade"))])
        plan = plan_summary(joined)
        assert plan["sort_merge_joins"] == 1 and plan["shuffles"] == 0 and plan["broadcast_joins"] == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sample_evaluates_the_pool_once(spark):
    df = Q.QUERIES["scenario_sample"](spark, SF01)
    plan = plan_summary(df)
    assert {s[0].split("-")[0] for s in plan["scans"]} == {"sample"}  # the written sample
    pool = Q._pool(spark, SF01)
    drawn = plan_summary(Q.SMP.draw_sample(pool))
    assert {s[0].split("-")[0] for s in drawn["scans"]} == {"sample_pool"}
    once = plan_summary(pool)["scans"]
    assert sorted(s[0] for s in once).count("orders.parquet") <= 2


def test_input_status(spark, fixture_dir):
    got = {r.input: r.present for r in IO.input_status(spark, {"a": f"{fixture_dir}/baseline.csv", "b": f"{fixture_dir}/none"}).collect()}
    assert got == {"a": True, "b": False}
    with pytest.raises(FileNotFoundError, match="Missing file: .*none"):
        IO.require_paths(spark, f"{fixture_dir}/baseline.csv", f"{fixture_dir}/none")
