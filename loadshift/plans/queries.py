"""

Every query reads whole tables (views in ``sources.driver_views``) and returns a
lazy DataFrame. At the boundary integers are widened to BIGINT and doubles are
rounded to ``ROUND_DIGITS`` so that Spark and the SQL oracle can be compared
value by value (summation order differs in the last bits).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (REFERENCE_SCENARIO_LABELS, JobParams, scenario_labels, scenario_table,
                      total_sample_bound)
from ..functions import columns as C
from ..functions import semantics as S
from ..functions import timecols as TC
from ..operators import compare as CMP
from ..operators import joins as J
from ..operators import order as ORD
from ..operators import report as REP
from ..operators import rollup as R
from ..operators import sample as SMP
from ..sources import bucketed as B
from ..sources import driver_views as V
from ..sources import files as IO
from ..sources import series_files as SF
from ..streaming import hourly as ST
from . import job

ROUND_DIGITS = 7
ZONE = TC.DEFAULT_ZONE
BASE, UPG = V.DRIVER_BASELINE_ARM, V.DRIVER_UPGRADE_ARM
DST_SHIFTS_DAYS = (60, 300)   # move January events over the March and November changes


def finalize(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Widen integers to BIGINT and round doubles; names unchanged.

    Doubles are rounded as round(x * 10^d) / 10^d on the binary value, which returns stored
    two-decimal values as they are. (Spark's round(x, d) rounds the shortest decimal text of
    x instead, which breaks exact ties differently from SQL engines that round in binary.)
    Built as one SQL projection: a single call into the JVM however wide the table."""
    scale = f"{float(10 ** digits)!r}D"
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            exprs.append(f"CAST({q} AS BIGINT) AS {q}")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(f"round(CAST({q} AS DOUBLE) * {scale}, 0) / {scale} AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)


def _n_requested(spark, sf_dir):
    """divisor = number of requested buildings, as a scalar subquery on the id table."""
    return V.requested_buildings(spark, sf_dir).select(F.count(F.lit(1))).scalar()


def _onepass(spark, sf_dir, day: str | None = None) -> DataFrame:
    """The comparison; with ``day`` only around that local day, as a filter on the raw
    timestamp that reaches the scan."""
    rd = V.readings(spark, sf_dir)
    if day is not None:
        rd = rd.where(TC.raw_window_for_local_day("timestamp", day))
    return CMP.portfolio_compare(rd, _n_requested(spark, sf_dir), BASE, UPG, ZONE)


# ---- time-series family ------------------------------------------------------

def hourly_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both arms, per hour instant; MWh averaged over the requested buildings."""
    rd = V.readings(spark, sf_dir)
    return finalize(R.hourly_portfolio(rd, _n_requested(spark, sf_dir), ZONE, arm_labels=V.DRIVER_ARM_LABELS))


def compare_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 in the reference's shape: two per-arm hourly tables joined on the hour."""
    rd = V.readings(spark, sf_dir)
    n = _n_requested(spark, sf_dir)
    hr = lambda arm: R.hourly_portfolio(rd.where(F.col("upgrade") == arm), n, ZONE, arm_labels=V.DRIVER_ARM_LABELS)
    return finalize(CMP.compare_arms(hr(BASE), hr(UPG)))


def compare_arms_onepass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 from one scan and one aggregation (conditional sums per arm)."""
    return finalize(_onepass(spark, sf_dir))


def hourly_by_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 for the baseline arm: per building and wall-clock hour, prefix ``baseline``."""
    rd = V.readings(spark, sf_dir).where(F.col("upgrade") == BASE)
    return finalize(R.hourly_by_building(rd, "baseline", ZONE))


def hourly_by_building_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 for the upgrade arm, prefix ``upgrade``."""
    rd = V.readings(spark, sf_dir).where(F.col("upgrade") == UPG)
    return finalize(R.hourly_by_building(rd, "upgrade", ZONE))


def portfolio_from_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 derived from the shared hour cube (same result as ``hourly_portfolio``)."""
    rd = V.readings(spark, sf_dir)
    return finalize(R.portfolio_from_cube(R.hour_cube(rd), _n_requested(spark, sf_dir), ZONE, arm_labels=V.DRIVER_ARM_LABELS))


def building_hours_from_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 for the baseline arm derived from the shared hour cube (same result as
    ``hourly_by_building``)."""
    return finalize(R.building_hours_from_cube(R.hour_cube(V.readings(spark, sf_dir)), BASE, "baseline", ZONE))


def building_hour_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D12 in one pass: per building and wall-clock hour, baseline LEFT JOIN upgrade."""
    rd = V.readings(spark, sf_dir)
    return finalize(CMP.building_hour_compare(rd, BASE, UPG, ZONE))


def building_hour_compare_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D12 in the reference's shape: two per-arm building tables joined."""
    rd = V.readings(spark, sf_dir)
    b1 = R.hourly_by_building(rd.where(F.col("upgrade") == BASE), "baseline", ZONE)
    u1 = R.hourly_by_building(rd.where(F.col("upgrade") == UPG), "upgrade", ZONE)
    return finalize(CMP.join_building_arms(b1, u1))


def building_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected metadata, upgrade heating size, conditioned area."""
    return finalize(CMP.building_attributes(V.baseline_metadata(spark, sf_dir), V.upgrade_metadata(spark, sf_dir)))


def peak_hour_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wall-clock hour per building, enriched with its attributes."""
    rd = V.readings(spark, sf_dir)
    bhc = CMP.building_hour_compare(rd, BASE, UPG, ZONE, only_local_hours=[V.DRIVER_PEAK_HOUR])
    sl = CMP.peak_hour_slice(bhc, V.DRIVER_PEAK_HOUR)
    return finalize(CMP.slice_with_attributes(V.baseline_metadata(spark, sf_dir), V.upgrade_metadata(spark, sf_dir), sl))


def annual_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual totals per arm label and end use."""
    return finalize(REP.annual_energy(_onepass(spark, sf_dir)))


def peak_day_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cooling profile of one local day, kW per building."""
    return finalize(REP.peak_day_profile(_onepass(spark, sf_dir, V.DRIVER_PEAK_DAY), V.DRIVER_PEAK_DAY, "cooling"))


def peak_day_profile_heating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heating profile of one local day, kW per building."""
    day = V.DRIVER_WINTER_PEAK_HOUR[:10]
    return finalize(REP.peak_day_profile(_onepass(spark, sf_dir, day), day, "heating"))


def profile_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The peak-day profile in labelled long form."""
    prof = REP.peak_day_profile(_onepass(spark, sf_dir, V.DRIVER_PEAK_DAY), V.DRIVER_PEAK_DAY, "cooling")
    return finalize(REP.profile_long(prof, "cooling"))


def local_hour_dst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 across both daylight-saving changes: readings moved by 60 and 300 days;
    readings and distinct hour instants per wall-clock hour."""
    rd = V.readings(spark, sf_dir)
    # one scan: every reading is emitted once per shift
    shift = F.explode(F.array(*[F.lit(d) for d in DST_SHIFTS_DAYS]))
    moved = rd.select(shift.alias("shift_days"), "timestamp").select(
        "shift_days", (F.col("timestamp") + F.make_dt_interval(F.col("shift_days"))).alias("timestamp"))
    inst = R.with_hour(moved).groupBy("shift_days", R.HOUR_UTC).agg(F.count(F.lit(1)).alias("n"))
    wall = R.add_wall_clock(inst, ZONE)
    out = wall.groupBy("shift_days", R.TIME_HR, *R.WALL).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_instants"))
    return finalize(out)


def hourly_portfolio_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 through Structured Streaming: the readings derived from ``events`` are
    written as a series dataset and streamed back; each micro-
    batch writes its partial sums exactly once, and the partials are merged and
    finished on read. Same result as ``hourly_portfolio``."""
    base = IO.scratch_dir(spark, "hourly_stream")
    rd = V.readings(spark, sf_dir)
    IO.write_series(rd.withColumn("state", F.lit("VA")), f"{base}/series")
    schema = spark.read.parquet(f"{base}/series").schema
    stream = spark.readStream.schema(schema).parquet(f"{base}/series")
    q = ST.start_partials(stream, f"{base}/partials", f"{base}/checkpoint")
    q.awaitTermination()
    return finalize(ST.read_portfolio(spark, f"{base}/partials", _n_requested(spark, sf_dir), ZONE,
                                      arm_labels=V.DRIVER_ARM_LABELS))


def distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct (building, arm) pairs present in the series."""
    return finalize(V.readings(spark, sf_dir).select("bldg_id", "upgrade").distinct())


# ---- sampling family -----------------------------------------------------------

def _scenarios(spark):
    return scenario_table(spark, V.DRIVER_SCENARIOS)


def _pool(spark, sf_dir) -> DataFrame:
    return SMP.eligible_pool(V.baseline_metadata(spark, sf_dir), V.upgrade_metadata(spark, sf_dir), _scenarios(spark))


def _sample(spark, sf_dir) -> DataFrame:
    """The sample, written: its readers share one evaluation of the pool."""
    return IO.checkpoint_table(SMP.draw_sample(_pool(spark, sf_dir)), IO.scratch_dir(spark, "sample"))


PREP_COLUMNS = ("bldg_id", "applicability", "heating_electricity_kwh", "cooling_electricity_kwh",
                "thermal_electricity_kwh", "nonthermal_electricity_kwh", "heating_tons", "cooling_tons", "tons")
POOL_COLUMNS = ("scenario", "bldg_id", "tons", "nonthermal_electricity_kwh", "upgrade_tons_heating",
                "upgrade_tons_cooling")


def prep_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 with the default building-type and ducts filters."""
    d = V.DRIVER_SCENARIOS[0]
    df = SMP.prep_baseline(V.baseline_metadata(spark, sf_dir), d.building_type, d.ducts_required)
    return finalize(df.select(*PREP_COLUMNS))


def eligible_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible buildings of every scenario in one pass."""
    return finalize(_pool(spark, sf_dir).select(*POOL_COLUMNS))


def scenario_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash-ordered sample of every scenario."""
    return finalize(_sample(spark, sf_dir).select(*POOL_COLUMNS))


def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven statistics per scenario sample."""
    return finalize(SMP.sample_summary(_sample(spark, sf_dir)))


def requested_vs_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per scenario and arm, requested vs loaded vs failed buildings.

    One aggregate of the readings (arm flags per requested building) and one pass
    over the sample; the two arms are columns, unpivoted at the end."""
    sample_ids = _sample(spark, sf_dir).select("scenario", "bldg_id")
    rd = V.readings(spark, sf_dir)
    req = sample_ids.select("bldg_id").distinct()
    flags = (rd.join(J.broadcast_bounded(req, total_sample_bound(V.DRIVER_SCENARIOS)), "bldg_id", "left_semi")
               .groupBy("bldg_id")
               .agg(*[F.max(F.col("upgrade") == a).alias(f"_has_{a}") for a in (BASE, UPG)]))
    st = sample_ids.join(flags, "bldg_id", "left")
    per = st.groupBy("scenario").agg(
        F.count_distinct("bldg_id").alias("n_requested"),
        *[F.count(F.when(F.col(f"_has_{a}"), 1)).alias(f"_loaded_{a}") for a in (BASE, UPG)])
    long = per.unpivot(["scenario", "n_requested"], [f"_loaded_{a}" for a in (BASE, UPG)], "_arm", "n_loaded")
    out = long.select("scenario", F.regexp_extract("_arm", r"(\d+)$", 1).cast("int").alias("upgrade"),
                      "n_requested", "n_loaded", (F.col("n_requested") - F.col("n_loaded")).alias("n_failed"))
    return finalize(out)


def scenario_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D18 + D19 for every scenario in one job: sample -> series of the sampled
    buildings -> one-pass comparison per scenario -> annual report -> labels."""
    ids = _sample(spark, sf_dir).select(F.col("scenario").alias("scenario_name"), "bldg_id")
    n = ids.groupBy("scenario_name").agg(F.count(F.lit(1)).alias("n_buildings"))
    # readings are summed per building and hour first; scenarios then share those rows
    cube = R.hour_cube(V.readings(spark, sf_dir))
    member = cube.join(J.broadcast_bounded(ids, total_sample_bound(V.DRIVER_SCENARIOS)), "bldg_id", "inner")
    cmp = CMP.portfolio_compare_from_cube(member, n, BASE, UPG, ZONE, group_cols=("scenario_name",))
    names = _scenarios(spark).select(F.col("scenario").alias("scenario_name"))
    annual = REP.annual_energy(cmp, group_cols=("scenario_name",), groups=names)
    return finalize(REP.scenario_report(scenario_labels(spark, REFERENCE_SCENARIO_LABELS), annual))


def job_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D18 on data derived from the driver tables: the readings are written as a
    series dataset and the metadata views as CSV files (dotted names, NA), then the
    whole job runs (samples, series, comparison, peak slices, reports) and its
    annual report is returned. Same result as ``scenario_report``."""
    base = IO.scratch_dir(spark, "job_end_to_end")
    IO.write_series(V.readings(spark, sf_dir).withColumn("state", F.lit("VA")), f"{base}/series")
    meta, upg = V.baseline_metadata(spark, sf_dir), V.upgrade_metadata(spark, sf_dir)
    IO.write_csv(meta, f"{base}/baseline_csv")
    IO.write_csv(upg, f"{base}/upgrade_csv")
    restore = lambda schema: T.StructType([T.StructField(C.restore(f.name), f.dataType, True) for f in schema])
    params = JobParams(upgrade_baseline=BASE, upgrade_gshp=UPG, state="VA", timezone=ZONE,
                       summer_peak_day=V.DRIVER_PEAK_DAY, summer_peak_hour=V.DRIVER_PEAK_HOUR,
                       winter_peak_day=V.DRIVER_WINTER_PEAK_HOUR[:10], winter_peak_hour=V.DRIVER_WINTER_PEAK_HOUR)
    res = job.run(spark, f"{base}/baseline_csv", f"{base}/upgrade_csv", f"{base}/series", f"{base}/out", params,
                  V.DRIVER_SCENARIOS, restore(meta.schema), restore(upg.schema), layout="table")
    return finalize(res["annual_energy_consumption"])


# ---- scalar-function family ------------------------------------------------------

def regex_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First digits / 100; NULL (not '' or an error) when there are none."""
    ev = V.table(spark, sf_dir, "events")
    part = V.table(spark, sf_dir, "part")
    a = ev.select(F.lit("events.props").alias("source"), F.col("event_id").alias("id"), F.col("props").alias("text"))
    # one scan of part: each row gives its name and its brand
    pair = lambda src, c: F.struct(F.lit(src).alias("source"), F.col(c).alias("text"))
    b = (part.select(F.col("p_partkey").alias("id"),
                     F.explode(F.array(pair("part.p_name", "p_name"), pair("part.p_brand", "p_brand"))).alias("p"))
             .select("p.source", "id", "p.text"))
    u = a.unionByName(b)
    return finalize(u.select("source", "id", S.extract_number(F.col("text")).alias("number")))


def bool_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric, text and logical inputs; text NULL is FALSE, numeric NULL stays NULL."""
    lab = V.table(spark, sf_dir, "labels")
    text = F.when(F.col("quality") == 1, "Yes").when(F.col("toxic") == 1, "T").otherwise("no")
    return finalize(lab.select(
        "doc_id",
        S.as_bool(F.col("quality"), T.IntegerType()).alias("quality_flag"),
        S.as_bool(F.col("toxic").cast("string"), T.StringType()).alias("toxic_text_flag"),
        S.as_bool(text, T.StringType()).alias("label_text_flag"),
        S.as_bool(F.col("quality") > F.col("toxic"), T.BooleanType()).alias("logical_flag"),
        S.in_set(F.when(F.col("toxic") == 0, F.col("quality")), [1]).alias("quality_in_set"),
    ))


def _customer_prices(spark, sf_dir) -> DataFrame:
    """customer LEFT JOIN (max price of early orders, max price of late orders):
    one scan and one aggregation of orders (conditional maxima)."""
    c = V.table(spark, sf_dir, "customer")
    o = V.table(spark, sf_dir, "orders")
    d, price = F.col("o_orderdate"), F.col("o_totalprice")
    per = o.groupBy("o_custkey").agg(
        F.max(F.when(d < TC.ntz_literal(V.EARLY_BEFORE), price)).alias("early_max"),
        F.max(F.when(d >= TC.ntz_literal(V.LATE_FROM), price)).alias("late_max"))
    return c.join(per, c.c_custkey == per.o_custkey, "left").drop("o_custkey")


def strict_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict mean (NULL if any NULL) next to the skip-NULL mean."""
    df = _customer_prices(spark, sf_dir)
    out = df.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        S.mean_strict("late_max").alias("mean_strict"),
        S.mean_skipna("late_max").alias("mean_skipna"),
    )
    return finalize(out)


def strict_pmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: pairwise max that is NULL when a side is NULL, next to Spark's greatest."""
    df = _customer_prices(spark, sf_dir)
    return finalize(df.select("c_custkey", "early_max", "late_max",
                              S.pmax_strict("early_max", "late_max").alias("pmax_strict"),
                              F.greatest("early_max", "late_max").alias("greatest_skipna")))


def row_sum_skipna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: horizontal sum skipping NULL, next to the NULL-propagating '+', and the
    empty column set (0)."""
    df = _customer_prices(spark, sf_dir)
    return finalize(df.select("c_custkey",
                              S.row_sum(["early_max", "late_max", "c_acctbal"]).alias("row_sum"),
                              (F.col("early_max") + F.col("late_max") + F.col("c_acctbal")).alias("plain_sum"),
                              S.row_sum([]).alias("empty_sum")))


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bind tables by column name, missing columns become NULL."""
    c = V.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"))
    s = V.table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("kind"))
    return finalize(c.unionByName(s, allowMissingColumns=True))


# Fixed pattern of the dynamic-measure query: every money/amount column of lineitem.
DYNAMIC_PATTERN = r"^l_.*(price|quantity)$"


def dynamic_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pick columns by regex / prefix+suffix at run time, scale them all,
    aggregate with computed names."""
    li = V.table(spark, sf_dir, "lineitem")
    by_regex = C.cols_regex(li.columns, DYNAMIC_PATTERN)
    by_affix = C.cols_prefix_suffix(li.columns, "l_", "tax")
    scaled = C.apply_to_columns(li, by_regex, lambda c: c / F.lit(1000.0))
    return finalize(scaled.groupBy("l_returnflag", "l_linestatus").agg(
        *[S.sum0(c).alias(f"sum_{c}_k") for c in by_regex],
        *[S.sum0(c).alias(f"sum_{c}") for c in by_affix],
        S.sum0(S.row_sum(by_regex)).alias("sum_all_k"),
        F.count(F.lit(1)).alias("n")))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a table as CSV partitioned by a key (header, NA for NULL)
    into the shared folder and read it back with an explicit schema."""
    c = V.table(spark, sf_dir, "customer")
    n = V.dimension(spark, sf_dir, "nation")
    r = V.dimension(spark, sf_dir, "region")
    df = (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
           .join(r, n.n_regionkey == r.r_regionkey, "left")
           .select("c_custkey", "c_name", F.when(F.col("r_name") != "AFRICA", F.col("r_name")).alias("r_name"),
                   (F.col("c_acctbal") * 1.5).alias("score"), "c_mktsegment"))
    out = IO.write_csv(df, IO.scratch_dir(spark, "csv_roundtrip"), partition_by=["c_mktsegment"])
    schema = "c_custkey bigint, c_name string, r_name string, score double, c_mktsegment string"
    return finalize(IO.read_csv(spark, out, schema))


# ---- order, text output, clock change, large samples ---------------------------------

def _shifted(spark, sf_dir) -> DataFrame:
    """The readings moved over the autumn clock change, where an hour repeats."""
    move = F.make_dt_interval(F.lit(V.DRIVER_AUTUMN_SHIFT_DAYS))
    return V.readings(spark, sf_dir).withColumn("timestamp", F.col("timestamp") + move)


def hourly_portfolio_dst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 across the clock change: both instants of the repeated hour stay apart."""
    return finalize(R.hourly_portfolio(_shifted(spark, sf_dir), _n_requested(spark, sf_dir), ZONE,
                                       arm_labels=V.DRIVER_ARM_LABELS))


def hourly_by_building_dst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 across the clock change: the repeated hour is one row."""
    rd = _shifted(spark, sf_dir).where(F.col("upgrade") == BASE)
    return finalize(R.hourly_by_building(rd, "baseline", ZONE))


def building_hour_compare_dst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D12 across the clock change."""
    return finalize(CMP.building_hour_compare(_shifted(spark, sf_dir), BASE, UPG, ZONE))


def report_text_8760(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison in hour order, numbered, written as text files of ascending hours
    and read back, with its times as text. The order is made by ranges of hours; no task sorts
    or numbers the whole."""
    cmp = _onepass(spark, sf_dir).select("hour_utc", "time_hr", "interval_count_base", "total_electricity_mwh_base",
                                         "total_mwh_scaled")
    text = (ORD.numbered(cmp, ["hour_utc"]).withColumn("time_hr", TC.r_datetime_text(F.col("time_hr"))).drop("hour_utc"))
    path = IO.write_csv(text, IO.scratch_dir(spark, "report_text"))
    schema = ("time_hr string, interval_count_base long, total_electricity_mwh_base double, total_mwh_scaled double, "
              "row_number long")
    return finalize(IO.read_csv(spark, path, schema))


def annual_energy_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the report's rows in their own order."""
    out = REP.annual_energy(_onepass(spark, sf_dir)).select("scenario")
    return finalize(out.withColumn("row_number", F.monotonically_increasing_id() + 1))


def large_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of all buildings, one of more than a thousand."""
    sizes = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(k).alias("sample_size"), F.lit(sd).alias("seed"))
                      for n, k, sd in V.LARGE_SAMPLES])
    pool = V.requested_buildings(spark, sf_dir).select(F.explode(sizes).alias("s"), "bldg_id").select("s.*", "bldg_id")
    return finalize(SMP.draw_sample(pool).select("scenario", "bldg_id"))


def _by_building_arm(back: DataFrame) -> DataFrame:
    return back.groupBy("bldg_id", "upgrade").agg(
        F.count(F.lit(1)).alias("n_readings"), F.count(R.NET).alias("n_net"), F.sum(R.NET).alias("sum_net"),
        F.sum(R.GAS_HEAT).alias("sum_gas_heat"))


def _source_series(spark, sf_dir, name: str) -> str:
    """The readings in the source layout: one file per building and arm, named by the tasks."""
    root = IO.scratch_dir(spark, name)
    IO.write_source_series(V.readings(spark, sf_dir).withColumn("state", F.lit("VA")), root)
    return root


def series_source_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings written as one file per building and arm, as the source has
    them, and read back: ids from file names, arms and state from folders."""
    root = _source_series(spark, sf_dir, "series_source")
    return finalize(_by_building_arm(IO.read_series(spark, root, (BASE, UPG), "VA", layout="source")))


def series_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder whose measures have different types (whole numbers of 4 and 8 bytes
    and fractions), one measure missing in some: types from the footers, one schema."""
    root = IO.scratch_dir(spark, "series_mixed")
    rd = V.readings(spark, sf_dir).withColumn("state", F.lit("VA"))
    kinds = len(V.MIXED_TYPES)
    for k, kind in enumerate(V.MIXED_TYPES):
        part = rd.where(F.col("bldg_id") % kinds == k).withColumn(R.NET, F.floor(R.NET).cast(kind) if kind != "double" else F.col(R.NET))
        SF.write_files(part if kind == "double" else part.drop(R.GAS_HEAT), root, overwrite=False)
    back = IO.read_series(spark, root, (BASE, UPG), "VA", layout="source")
    return finalize(_by_building_arm(back).withColumn("net_type", F.lit(back.schema[R.NET].dataType.simpleString())))


def series_of_id_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the buildings in an id table (the customers of one market segment),
    found by joining it with the listing; most of the files are not opened."""
    root = _source_series(spark, sf_dir, "series_ids")
    ids = V.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == V.SAMPLED_SEGMENT).select(
        F.col("c_custkey").alias("bldg_id"))
    return finalize(_by_building_arm(IO.read_series(spark, root, (BASE, UPG), "VA", ids=ids, layout="source")))


def damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and cause of every building and arm after one file has lost its end and
    the pages of another were overwritten; both are dropped whole from the readings."""
    root = _source_series(spark, sf_dir, "series_damaged")
    rd = V.readings(spark, sf_dir)
    first, last = rd.agg(F.min(F.when(F.col("upgrade") == BASE, F.col("bldg_id"))),
                         F.max(F.when(F.col("upgrade") == UPG, F.col("bldg_id")))).first()
    IO.truncate_file(spark, f"{root}/upgrade={BASE}/state=VA/{first}-{BASE}.parquet")
    IO.blot_file(spark, f"{root}/upgrade={UPG}/state=VA/{last}-{UPG}.parquet")
    files = IO.series_files(spark, root, (BASE, UPG), "VA")
    read = IO.checkpoint_table(IO.count_readings(files.readings()), IO.scratch_dir(spark, "damaged_read"))
    status = files.status(read)
    return finalize(status.select("bldg_id", "upgrade", F.when(F.col("cause").isNull(), F.col("n_read")).alias("n_loaded"), "cause"))


def bucketed_arm_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hour cube written in buckets of building and hour, both arms read from it and
    joined without an exchange. Same result as ``building_hour_compare``."""
    cube = R.wall_cube(R.hour_cube(V.readings(spark, sf_dir)), ZONE)
    table = B.write_bucketed(cube, IO.scratch_dir(spark, "wall_cube"), R.BUCKET_KEYS)
    arms = [R.building_hours_from_wall_cube(table, arm, name) for arm, name in ((BASE, "baseline"), (UPG, "upgrade"))]
    return finalize(CMP.join_building_arms(*arms))


def csv_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV some of whose lines have text in a number, a field too few or one too many. The
    bad lines are listed; the rows stay in the data with what could be read."""
    c = V.table(spark, sf_dir, "customer")
    key, fields = F.col("c_custkey"), [F.col("c_custkey").cast("string"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string")]
    fault = key % V.BAD_LINE_EVERY
    line = (F.when(fault == 0, F.concat_ws(",", fields[0], fields[1], F.lit("oops")))
            .when(fault == 1, F.concat_ws(",", *fields[:2]))
            .when(fault == 2, F.concat_ws(",", *fields, F.lit("more")))
            .otherwise(F.concat_ws(",", *fields)))
    path = IO.scratch_dir(spark, "bad_csv")
    c.select(line.alias("c_custkey,c_mktsegment,c_nationkey")).write.option("header", True).option("sep", "\u0001").csv(path)
    schema = "c_custkey bigint, c_mktsegment string, c_nationkey bigint"
    rows = IO.read_csv(spark, path, schema)
    bad = IO.bad_records(spark, path, schema).select(
        F.regexp_extract("line", r"^(\d+),", 1).try_cast("bigint").alias("c_custkey"), F.col("line").alias("bad_line"))
    return finalize(rows.join(bad, "c_custkey", "left"))


def input_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which inputs of a run are there, and how many rows those hold; a missing one is listed
    (``io.require_paths`` raises for it)."""
    base = sf_dir.rstrip("/")
    found = IO.input_status(spark, {n: f"{base}/{n}.parquet" for n in V.JOB_INPUTS}).drop("path")
    rows = [V.table(spark, sf_dir, r.input).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("input", F.lit(r.input))
            for r in found.collect() if r.present]  # one row for each configured input
    counts = rows[0]
    for more in rows[1:]:
        counts = counts.unionByName(more)
    return finalize(found.join(counts, "input", "left"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_portfolio": hourly_portfolio,
    "compare_arms": compare_arms,
    "compare_arms_onepass": compare_arms_onepass,
    "hourly_by_building": hourly_by_building,
    "hourly_by_building_upgrade": hourly_by_building_upgrade,
    "portfolio_from_cube": portfolio_from_cube,
    "building_hours_from_cube": building_hours_from_cube,
    "building_hour_compare": building_hour_compare,
    "building_hour_compare_join": building_hour_compare_join,
    "building_attributes": building_attributes,
    "peak_hour_slice": peak_hour_slice,
    "annual_energy": annual_energy,
    "peak_day_profile": peak_day_profile,
    "peak_day_profile_heating": peak_day_profile_heating,
    "profile_long": profile_long,
    "local_hour_dst": local_hour_dst,
    "hourly_portfolio_stream": hourly_portfolio_stream,
    "distinct_ids": distinct_ids,
    "prep_baseline": prep_baseline,
    "eligible_pool": eligible_pool,
    "scenario_sample": scenario_sample,
    "sample_summary": sample_summary,
    "requested_vs_loaded": requested_vs_loaded,
    "scenario_report": scenario_report,
    "job_end_to_end": job_end_to_end,
    "regex_number": regex_number,
    "bool_coercion": bool_coercion,
    "strict_mean": strict_mean,
    "strict_pmax": strict_pmax,
    "row_sum_skipna": row_sum_skipna,
    "union_by_name": union_by_name,
    "dynamic_measures": dynamic_measures,
    "csv_roundtrip": csv_roundtrip,
    "large_sample": large_sample,
    "report_text_8760": report_text_8760,
    "annual_energy_order": annual_energy_order,
    "hourly_portfolio_dst": hourly_portfolio_dst,
    "hourly_by_building_dst": hourly_by_building_dst,
    "building_hour_compare_dst": building_hour_compare_dst,
    "series_source_layout": series_source_layout,
    "series_mixed_types": series_mixed_types,
    "series_of_id_table": series_of_id_table,
    "damaged_files": damaged_files,
    "bucketed_arm_join": bucketed_arm_join,
    "csv_bad_records": csv_bad_records,
    "input_guards": input_guards,
}
