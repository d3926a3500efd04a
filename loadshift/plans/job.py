"""End-to-end run for every scenario at once.

    python -m loadshift.plans.job --baseline base.csv --upgrade upg.csv \
        --series s3a://bucket/timeseries --out s3a://bucket/results

Stages and where the lineage is cut (each stage reads what the previous wrote,
so a lost executor only recomputes inside one stage). Every stage leaves a manifest; a rerun
with the same inputs and parameters reads the finished stages (``plans.stages``):

0. metadata CSVs -> ``_work/*_metadata`` (parquet, parsed once); lines that do not fit the schema
   -> ``results/bad_records``.
1. metadata -> eligible pools (broadcast scenario table) -> hash-ordered sample
   -> ``bldg_ids/applicable_buildings`` (CSV) + ``bldg_ids/sample_average`` (CSV)
   + ``_work/sample`` (parquet, read back below).
2. series of the sampled buildings only, found by joining the sample with the listing and opened in
   groups of bounded count -> one hour cube per (arm, building, hour) with its
   reading counts -> ``_work/hour_cube`` (parquet, one part per group): the only scan of the readings. A building
   and arm whose counted readings differ from its file's footer is dropped whole and listed in
   ``results/failed_reads`` with the cause.
3. from the cube: comparison per (scenario, hour) -> ``results/combined_8760`` (CSV + parquet);
   building hours of both arms -> ``results/building_hours`` (parquet); the two peak hours with
   attributes -> ``results/all_buildings_{summer,winter}_peak_hr``.
4. reports from the written comparison: ``annual_energy_consumption``,
   ``summer_peak_day``, ``winter_peak_day`` and the failed-reads table.

All tables are partitioned by ``scenario`` (one folder per scenario).
"""

from __future__ import annotations

import argparse
from dataclasses import astuple
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (REFERENCE_SCENARIO_LABELS, REFERENCE_SCENARIOS, JobParams, Scenario, arm_labels,
                      load_scenarios, scenario_labels, scenario_table, total_sample_bound)
from ..functions import columns as C
from ..functions import timecols as TC
from ..operators import compare as CMP
from ..operators import joins as J
from ..operators import report as REP
from ..operators import rollup as R
from ..operators import sample as SMP
from ..sources import files as IO
from .stages import Stages, input_mark

SCN = "scenario_name"


def _out(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


# A sample of at most so many buildings is a literal filter on the table layout (pushed to parquet);
# a larger one is joined.
LITERAL_IDS = 10_000


def select_samples(spark: SparkSession, base_meta: DataFrame, upg_meta: DataFrame, out_dir: str,
                   scenarios: Sequence[Scenario] = REFERENCE_SCENARIOS, stages: Stages | None = None) -> DataFrame:
    """Stage 1: pools, samples and their summaries for all scenarios; returns the
    written sample (read back). ``stages`` of a run resumes it; alone, everything is built."""
    uses = METADATA if stages else ()
    stages = stages or Stages(spark, out_dir, resume=False)
    scn = scenario_table(spark, scenarios)
    asked = [astuple(s) for s in scenarios]

    def reports(sample: DataFrame) -> None:
        # an empty pool stops its own scenario only; the others run on
        empty = IO.checkpoint_table(SMP.empty_pools(scn, sample), _out(out_dir, "_work", "empty_pools"))
        IO.write_csv(empty, _out(out_dir, "bldg_ids", "empty_pools"))
        if not sample.select("scenario").limit(1).collect():
            raise ValueError("No rows available after filtering: " + ", ".join(s.scenario for s in scenarios))
        IO.write_csv(sample.drop("sample_size", "seed").hint("rebalance", "scenario"),
                     _out(out_dir, "bldg_ids", "applicable_buildings"), partition_by=["scenario"])
        IO.write_csv(SMP.sample_summary(sample).repartition("scenario"),
                     _out(out_dir, "bldg_ids", "sample_average"), partition_by=["scenario"])

    return stages.table("sample", lambda: SMP.draw_sample(SMP.eligible_pool(base_meta, upg_meta, scn)).hint("rebalance", "scenario"),
                        asked, uses=uses, partition_by=["scenario"], after=reports)


def _source_cube(stages: Stages, series_root: str, arms: Sequence[int], params: JobParams, wanted: DataFrame, series_schema,
                 inputs: list, uses: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """(hour cube, load status, names of the cube's stages) from the source layout, one group of
    files after the other: the driver holds the paths of one group, and finished groups are reused."""
    spark = stages.spark
    files = IO.series_files(spark, series_root, arms, params.state, wanted, series_schema)
    groups = files.groups() if files.parts else [files.readings()]
    cubes, counts, names = [], [], []
    for k, readings in enumerate(groups):
        same = {"params": [k, len(files.parts), arms, params.state, str(series_schema)], "inputs": inputs, "uses": uses}
        cubes.append(stages.table(f"hour_cube/part={k}", lambda r=readings: R.hour_cube(C.sanitize_columns(r)), **same))
        counts.append(stages.table(f"footer_counts/part={k}", lambda k=k: files.expected(k), **same))
        names += [f"hour_cube/part={k}", f"footer_counts/part={k}"]
    cube, expected = reduce(DataFrame.unionByName, cubes), reduce(DataFrame.unionByName, counts)
    read = cube.groupBy("bldg_id", "upgrade").agg(F.sum("_n").alias("n_read"))
    status = stages.table("series_status", lambda: files.status(read, expected), uses=names)
    return cube, status, [*names, "series_status"]


def build_series_results(spark: SparkSession, sample: DataFrame, base_meta: DataFrame, upg_meta: DataFrame,
                         series_root: str, out_dir: str, params: JobParams,
                         scenarios: Sequence[Scenario] = REFERENCE_SCENARIOS,
                         series_schema=None, layout: str = "source", stages: Stages | None = None) -> dict[str, DataFrame]:
    """Stages 2-3: hourly comparison per scenario, building hours and the two peak-hour slices.
    ``series_schema`` (DDL or StructType) skips reading footers to find the schema."""
    arms = (params.upgrade_baseline, params.upgrade_gshp)
    bound = total_sample_bound(scenarios)
    uses = ("sample", *METADATA) if stages else ()
    stages = stages or Stages(spark, out_dir, resume=False)
    inputs = [input_mark(spark, f) for f in IO.series_folders(spark, series_root, arms, params.state)]
    asked = [astuple(params), [astuple(s) for s in scenarios], layout]
    ids = sample.select(F.col("scenario").alias(SCN), "bldg_id")
    n = ids.groupBy(SCN).agg(F.count_distinct("bldg_id").alias("n_buildings"))   # T16: requested ids
    wanted = ids.select("bldg_id").distinct()
    # one scan of the readings: everything below comes from the written cube
    if layout == "source":
        cube, status, made = _source_cube(stages, series_root, arms, params, wanted, series_schema, inputs, uses)
        bad = status.where(F.col("cause").isNotNull()).select("bldg_id", "upgrade")
        cube = cube.join(J.broadcast_bounded(bad, bound * len(arms)), ["bldg_id", "upgrade"], "left_anti")
    else:
        some = sorted(r[0] for r in wanted.collect()) if bound <= LITERAL_IDS else wanted
        series = IO.read_series(spark, series_root, arms, params.state, ids=some, schema=series_schema, layout=layout, check=False)
        cube = stages.table("hour_cube", lambda: R.hour_cube(series), [arms, params.state, str(series_schema)], inputs, uses)
        status = cube.select("bldg_id", "upgrade").distinct().withColumn("cause", F.lit(None).cast("string"))
        made = ["hour_cube"]
    member = cube.join(J.broadcast_bounded(ids, bound), "bldg_id", "inner")

    def hourly() -> DataFrame:
        cmp = CMP.portfolio_compare_from_cube(member, n, params.upgrade_baseline, params.upgrade_gshp, params.timezone,
                                              group_cols=(SCN,))
        return cmp.withColumnRenamed(SCN, "scenario").repartition("scenario")

    def hourly_csv(cmp: DataFrame) -> None:
        IO.write_csv(cmp.repartition("scenario").sortWithinPartitions("hour_utc")
                     .withColumn("time_hr", TC.r_datetime_text(F.col("time_hr"))),
                     _out(out_dir, "results", "combined_8760"), partition_by=["scenario"])

    cmp_df = stages.table("combined_8760", hourly, asked, uses=made, partition_by=["scenario"], after=hourly_csv)

    # building hours of both arms, once per building whatever the number of scenarios
    hours = stages.table("building_hours", lambda: CMP.join_building_arms(
        *[R.building_hours_from_cube(cube, arm, name, params.timezone) for arm, name in zip(arms, ("baseline", "upgrade"))]),
        asked, uses=made, path=_out(out_dir, "results", "building_hours"))
    out = {"combined_8760": cmp_df, "building_hours": hours,
           "hourly_portfolio": R.portfolio_from_cube(member, n, params.timezone, group_cols=(SCN,),
                                                     arm_labels=arm_labels(*arms))}
    for season, hour in (("summer", params.summer_peak_hour), ("winter", params.winter_peak_hour)):
        peak = CMP.peak_hour_slice(hours, hour).join(J.broadcast_bounded(ids, bound), "bldg_id", "inner")
        out[f"{season}_peak_hr"] = CMP.slice_with_attributes(base_meta, upg_meta, peak, bound).withColumnRenamed(SCN, "scenario")
    pairs = ids.withColumn("upgrade", F.explode(F.array(*[F.lit(a) for a in arms])))
    out["failed_reads"] = (
        pairs.join(J.broadcast_bounded(status.select("bldg_id", "upgrade", F.col("cause"), F.lit(True).alias("_found")),
                                       bound * len(arms)), ["bldg_id", "upgrade"], "left")
        .where(F.col("_found").isNull() | F.col("cause").isNotNull())
        .select(F.col(SCN).alias("scenario"), "bldg_id", "upgrade", F.coalesce("cause", F.lit("no readings")).alias("cause")))

    def write_reports() -> None:
        for season in ("summer", "winter"):
            sl = out[f"{season}_peak_hr"]
            IO.write_csv(sl.hint("rebalance", "scenario").withColumn("time_hour", TC.r_datetime_text(F.col("time_hour"))),
                         _out(out_dir, "results", f"all_buildings_{season}_peak_hr"), partition_by=["scenario"])
        IO.write_csv(out["failed_reads"].hint("rebalance", "scenario"), _out(out_dir, "results", "failed_reads"),
                     partition_by=["scenario"])

    stages.action("series_reports", write_reports, asked, uses=["building_hours", *made, *uses])
    return out


def analyze_results(spark: SparkSession, out_dir: str, params: JobParams,
                    scenarios: Sequence[Scenario] = REFERENCE_SCENARIOS,
                    labels=REFERENCE_SCENARIO_LABELS, cmp: DataFrame | None = None,
                    stages: Stages | None = None) -> dict[str, DataFrame]:
    """Stage 4: reports from the written comparison (one read for all scenarios, S13).
    ``cmp`` is stage 2's read-back table; by default it is read from ``out_dir``."""
    if cmp is None:
        path = _out(out_dir, "_work", "combined_8760")
        IO.require_paths(spark, path)          # S9: results of the series stage must exist
        cmp = spark.read.parquet(path)
    names = scenario_table(spark, scenarios).select("scenario")
    cmp = cmp.withColumnRenamed("scenario", SCN)
    annual = REP.annual_energy(cmp, group_cols=(SCN,), groups=names.withColumnRenamed("scenario", SCN))
    annual = REP.scenario_report(scenario_labels(spark, labels), annual)
    summer = REP.peak_day_profile(cmp, params.summer_peak_day, "cooling", group_cols=(SCN,))
    winter = REP.peak_day_profile(cmp, params.winter_peak_day, "heating", group_cols=(SCN,))
    outs = {"annual_energy_consumption": annual, "summer_peak_day": summer, "winter_peak_day": winter}

    def write_reports() -> None:
        for name, df in outs.items():
            # files keep the reference's columns; the label stays on the returned table
            df = df.drop("label").withColumnRenamed(SCN, "scenario_id")
            if "time_hr" in df.columns:          # written as the reference prints it (T12)
                df = df.withColumn("time_hr", TC.r_datetime_text(F.col("time_hr")))
            # reports are a few rows per scenario: one file per scenario folder
            IO.write_csv(df.repartition("scenario_id"), _out(out_dir, "results", name), partition_by=["scenario_id"])

    if stages is None:
        write_reports()
    else:
        stages.action("reports", write_reports, [astuple(params), [astuple(s) for s in scenarios], labels], uses=["combined_8760"])
    return outs


METADATA = ("baseline_metadata", "upgrade_metadata")


def read_inputs(stages: Stages, baseline_csv: str, upgrade_csv: str, metadata_schema=None,
                upgrade_schema=None) -> tuple[DataFrame, DataFrame]:
    """Stage 0: each metadata CSV is parsed once (later stages read columnar parquet with
    pruning); its bad lines are listed with their file in ``results/bad_records``."""
    spark, tables, bad = stages.spark, [], []
    for name, path, schema in zip(METADATA, (baseline_csv, upgrade_csv), (metadata_schema, upgrade_schema), strict=True):
        schema = IO.csv_schema(spark, path) if schema is None else schema
        tables.append(stages.table(name, lambda p=path, s=schema: IO.read_metadata(spark, p, s), str(schema),
                                   [input_mark(spark, path)]))
        bad.append(IO.bad_records(spark, path, schema).withColumn("input", F.lit(name)))
    stages.table("bad_records", lambda: bad[0].unionByName(bad[1]), uses=METADATA, path=_out(stages.out, "results", "bad_records"))
    return tables[0], tables[1]


def run(spark: SparkSession, baseline_csv: str, upgrade_csv: str, series_root: str, out_dir: str,
        params: JobParams = JobParams(), scenarios: Sequence[Scenario] = REFERENCE_SCENARIOS,
        metadata_schema=None, upgrade_schema=None, series_schema=None, layout: str = "source",
        resume: bool = True, stages: Stages | None = None) -> dict[str, DataFrame]:
    """The whole pipeline for every scenario; returns the written tables. With ``resume`` the
    stages that an earlier run into ``out_dir`` finished from the same inputs and parameters are read."""
    IO.require_paths(spark, baseline_csv, upgrade_csv, series_root)
    stages = stages or Stages(spark, out_dir, resume)
    base, upg = read_inputs(stages, baseline_csv, upgrade_csv, metadata_schema, upgrade_schema)
    sample = select_samples(spark, base, upg, out_dir, scenarios, stages)
    res = build_series_results(spark, sample, base, upg, series_root, out_dir, params, scenarios, series_schema, layout, stages)
    rep = analyze_results(spark, out_dir, params, scenarios, cmp=res["combined_8760"], stages=stages)
    return {"sample": sample, **res, **rep}


def main(argv=None) -> None:
    from dataclasses import replace

    from ..session import get_session
    ap = argparse.ArgumentParser(description="baseline vs upgrade load analysis for all scenarios")
    ap.add_argument("--baseline", required=True, help="baseline metadata CSV")
    ap.add_argument("--upgrade", required=True, help="upgrade metadata CSV")
    ap.add_argument("--series", required=True, help="series dataset root")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--sample-size", type=int, default=None)
    ap.add_argument("--scenarios", default="", help="comma-separated subset, e.g. scenario1,scenario4")
    ap.add_argument("--scenario-file", default=None, help="JSON list of scenarios (replaces the built-in five)")
    ap.add_argument("--series-schema", default=None,
                    help="DDL schema of the series files (incl. upgrade int, state string): no footer reads")
    ap.add_argument("--stage", choices=("all", "select", "series", "analyze"), default="all",
                    help="run one step; later steps read what earlier ones wrote")
    ap.add_argument("--series-layout", choices=("source", "table"), default="source",
                    help="one file per building and arm, or the table layout")
    ap.add_argument("--fresh", action="store_true", help="build every stage again, finished or not")
    ap.add_argument("--metadata-schema", default=None, help="DDL schema of the baseline CSV (no inference)")
    ap.add_argument("--upgrade-schema", default=None, help="DDL schema of the upgrade CSV (no inference)")
    ap.add_argument("--seed", type=int, default=None, help="seed of every scenario's draw")
    fixed = JobParams()
    for name, kind in (("state", str), ("timezone", str), ("upgrade_baseline", int), ("upgrade_gshp", int),
                       ("summer_peak_day", str), ("summer_peak_hour", str), ("winter_peak_day", str), ("winter_peak_hour", str)):
        ap.add_argument("--" + name.replace("_", "-"), type=kind, default=getattr(fixed, name))
    a = ap.parse_args(argv)
    spark = get_session(cluster=True)
    scen = load_scenarios(a.scenario_file) if a.scenario_file else REFERENCE_SCENARIOS
    if a.scenarios:
        wanted = set(a.scenarios.split(","))
        scen = tuple(s for s in scen if s.scenario in wanted)
    if a.sample_size:
        scen = tuple(replace(s, sample_size=a.sample_size) for s in scen)
    if a.seed is not None:
        scen = tuple(replace(s, seed=a.seed) for s in scen)
    params = replace(fixed, state=a.state, timezone=a.timezone, upgrade_baseline=a.upgrade_baseline,
                     upgrade_gshp=a.upgrade_gshp, summer_peak_day=a.summer_peak_day, summer_peak_hour=a.summer_peak_hour,
                     winter_peak_day=a.winter_peak_day, winter_peak_hour=a.winter_peak_hour)
    if a.stage == "all":
        run(spark, a.baseline, a.upgrade, a.series, a.out, params, scen, a.metadata_schema, a.upgrade_schema, a.series_schema,
            a.series_layout, not a.fresh)
        return
    IO.require_paths(spark, a.baseline, a.upgrade)
    stages = Stages(spark, a.out, not a.fresh)
    if a.stage == "analyze":
        analyze_results(spark, a.out, params, scen, stages=stages)
        return
    base, upg = read_inputs(stages, a.baseline, a.upgrade, a.metadata_schema, a.upgrade_schema)
    if a.stage == "select":
        select_samples(spark, base, upg, a.out, scen, stages)
    else:
        IO.require_paths(spark, _out(a.out, "_work", "sample"))
        sample = spark.read.parquet(_out(a.out, "_work", "sample"))
        build_series_results(spark, sample, base, upg, a.series, a.out, params, scen, a.series_schema, a.series_layout, stages)


if __name__ == "__main__":
    main()
