"""Eligible-building pools and reproducible samples for many scenarios at once.

The reference runs one scenario per process. Here the scenario table (D1) is a
small DataFrame and every scenario is matched in one job:

* the pool is ``baseline INNER JOIN upgrade`` (a left join followed by a filter on
  the upgrade flag is an inner join, T9), matched to the scenarios by a broadcast
  hash join on the four default attributes plus a residual test for the optional
  filters (NULL in the scenario table = no filter). The scenario table is a config
  object, so its size is known before the job runs.
* the sample is a hash-ordered top-k per scenario: order by md5(seed-bldg_id), keep
  the first ``sample_size``. It does not depend on partitioning or input order. A histogram
  of the hash keys cuts the pool before the shuffle (:func:`draw_sample`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import semantics as S
from ..session import scratch_path
from ..sources.files import checkpoint_table

APPL = "applicability"
BTYPE = C.sanitize("in.geometry_building_type_acs")
DUCTS = C.sanitize("in.hvac_has_ducts")
VACANCY = C.sanitize("in.vacancy_status")
COOLTYPE = C.sanitize("in.hvac_cooling_type")
SQFT = C.sanitize("in.sqft")
VINTAGE = C.sanitize("in.vintage")
HEAT_EFF = C.sanitize("in.hvac_heating_efficiency")
FUEL = C.sanitize("in.heating_fuel")
PARTIAL = C.sanitize("in.hvac_cooling_partial_space_conditioning")
TOTAL_KWH = C.sanitize("out.electricity.total.energy_consumption.kwh")
SIZE_HEAT = C.sanitize("out.params.size_heating_system_primary_k_btu_h")
SIZE_COOL = C.sanitize("out.params.size_cooling_system_primary_k_btu_h")
GAS_KWH = C.sanitize("out.natural_gas.heating.energy_consumption.kwh")
PROPANE_KWH = C.sanitize("out.propane.heating.energy_consumption.kwh")
FUEL_OIL_KWH = C.sanitize("out.fuel_oil.heating.energy_consumption.kwh")
LOAD_HEAT_KBTU = C.sanitize("out.load.heating.energy_delivered.kbtu")
LOAD_COOL_KBTU = C.sanitize("out.load.cooling.energy_delivered.kbtu")


def prep_baseline(meta: DataFrame, building_type: str | None = None,
                  ducts_required: str | None = None) -> DataFrame:
    """Bool flag, electric heating/cooling sums (strict selectors, T15), thermal
    split, tonnage (strict pmax, T4). The building-type / applicability / ducts
    filters apply when values are given (single-scenario use)."""
    heat = C.strict_thermal(meta.columns, "heating", C.STRICT_METADATA)
    cool = C.strict_thermal(meta.columns, "cooling", C.STRICT_METADATA)
    df = meta.withColumns({
        APPL: S.as_bool(F.col(APPL), meta.schema[APPL].dataType),
        "heating_electricity_kwh": S.row_sum(heat),
        "cooling_electricity_kwh": S.row_sum(cool),
    })
    df = df.withColumn("thermal_electricity_kwh", F.col("heating_electricity_kwh") + F.col("cooling_electricity_kwh"))
    df = df.withColumns({
        "nonthermal_electricity_kwh": F.col(TOTAL_KWH) - F.col("thermal_electricity_kwh"),
        "heating_tons": S.kbtuh_to_tons(SIZE_HEAT),
        "cooling_tons": S.kbtuh_to_tons(SIZE_COOL),
    })
    df = df.withColumn("tons", S.pmax_strict("heating_tons", "cooling_tons"))
    if building_type is not None:
        df = df.where(F.col(BTYPE) == building_type)
    if building_type is not None or ducts_required is not None:
        df = df.where(F.col(APPL))
    if ducts_required is not None:
        df = df.where(F.col(DUCTS) == ducts_required)
    return df


def prep_upgrade(meta_u: DataFrame) -> DataFrame:
    """D3: upgrade flag and the two upgrade tonnages."""
    return meta_u.select(
        "bldg_id",
        S.as_bool(F.col(APPL), meta_u.schema[APPL].dataType).alias("applicability5"),
        S.kbtuh_to_tons(SIZE_HEAT).alias("upgrade_tons_heating"),
        S.kbtuh_to_tons(SIZE_COOL).alias("upgrade_tons_cooling"),
    )


def _optional_list(cfg: Column, value: Column) -> Column:
    """P16 for a list filter: inactive when NULL, empty, or all NULL."""
    inactive = cfg.isNull() | (F.size(cfg) == 0) | F.forall(cfg, lambda x: x.isNull())
    return inactive | F.array_contains(cfg, value)


def _optional_eq(cfg: Column, value: Column) -> Column:
    return cfg.isNull() | (value == cfg)


def eligible_pool(base_meta: DataFrame, upg_meta: DataFrame, scenarios: DataFrame) -> DataFrame:
    """D4 for every scenario: (scenario, sample_size, seed, baseline columns, upgrade columns)."""
    b = prep_baseline(base_meta).where(F.col(APPL))
    u = prep_upgrade(upg_meta).where(F.col("applicability5"))
    j = b.join(u, "bldg_id", "inner")                                    # J1 + filter == inner (T9)
    s = scenarios.alias("s")
    sc = lambda n: F.col(f"s.{n}")
    cond = [
        F.col(BTYPE) == sc("building_type"),
        F.col(DUCTS) == sc("ducts_required"),
        F.col(VACANCY) == sc("vacancy_required"),
        F.col(COOLTYPE) == sc("cooling_type_required"),
        _optional_list(sc("sqft_allowed"), F.col(SQFT))
        & _optional_list(sc("vintage_allowed"), F.col(VINTAGE))
        & _optional_eq(sc("hvac_efficiency"), F.col(HEAT_EFF))
        & _optional_eq(sc("heating_fuel"), F.col(FUEL)),
    ]
    # the scenario table is configuration: its row count is fixed before the job
    pool = j.join(F.broadcast(s), cond, "inner")                          # J8
    return pool.select(sc("scenario").alias("scenario"), sc("sample_size").alias("sample_size"),
                       sc("seed").alias("seed"), *[F.col(c) for c in j.columns])


def sample_order_key(seed: Column, bldg_id: Column) -> Column:
    """Hash order of a building within a seeded draw: md5('<seed>-<bldg_id>')."""
    return F.md5(F.concat(seed.cast("string"), F.lit("-"), bldg_id.cast("string")))


def empty_pools(scenarios: DataFrame, drawn: DataFrame) -> DataFrame:
    """O3 guard: the scenarios without any eligible building (one row per configured scenario
    at most). ``drawn`` is the pool or the sample drawn from it: with every sample size at
    least one, a sample is empty exactly when its pool is."""
    return scenarios.select("scenario").join(drawn.select("scenario").distinct(), "scenario", "left_anti").withColumn(
        "cause", F.lit("No rows available after filtering"))


# Buckets of the hash order: the first hex digits of the md5 key.
BUCKET_HEX_DIGITS = 4


def draw_sample(pool: DataFrame) -> DataFrame:
    """Per scenario, min(sample_size, pool size) buildings without replacement, the
    smallest hash keys.

    The pool is evaluated once: it is written with its hash keys, and both passes read that
    table. A histogram of the key's leading digits (at most 65,536 rows per scenario, whatever
    the pool) tells how many of each bucket are drawn; later buckets are dropped before the
    shuffle, and the rest are ranked within their bucket. No task sorts a scenario, however
    large its pool or its sample."""
    key = sample_order_key(F.col("seed"), F.col("bldg_id"))
    p = pool.withColumn("_key", key).withColumn(
        "_bucket", F.conv(F.substring("_key", 1, BUCKET_HEX_DIGITS), 16, 10).cast("int"))
    p = checkpoint_table(p, scratch_path(pool.sparkSession, "sample_pool"))
    hist = p.groupBy("scenario", "sample_size", "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy("scenario").orderBy("_bucket")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = (hist.withColumn("_quota", F.col("sample_size") - before).where(F.col("_quota") > 0)
             .select(F.col("scenario").alias("_scenario"), F.col("_bucket").alias("_b"), "_quota"))
    # the histogram has at most 65,536 narrow rows per configured scenario
    kept = p.join(quota, (F.col("scenario") == F.col("_scenario")) & (F.col("_bucket") == F.col("_b")), "inner")
    rank = F.row_number().over(Window.partitionBy("scenario", "_bucket").orderBy("_key", "bldg_id"))
    return (kept.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_quota"))
            .drop("_rank", "_key", "_bucket", "_scenario", "_b", "_quota"))


def sample_summary(sample: DataFrame, group_cols=("scenario",)) -> DataFrame:
    """Eleven statistics per scenario (skip-NA means for tons, strict means else, T2/T3)."""
    partial = S.extract_number(F.col(PARTIAL))
    df = sample.withColumn("_sqft_conditioned", F.col(SQFT) * partial)
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("count"),
        S.mean_skipna(S.kbtuh_to_tons(SIZE_HEAT)).alias("base_tons_heating"),
        S.mean_skipna(S.kbtuh_to_tons(SIZE_COOL)).alias("base_tons_cooling"),
        S.mean_skipna("upgrade_tons_heating").alias("upgrade_tons_heating"),
        S.mean_strict(F.col(SQFT).cast("double")).alias("sqft"),
        S.mean_strict("_sqft_conditioned").alias("cooling_space_conditioned_sqft"),
        S.mean_strict(S.kwh_to_mwh(GAS_KWH)).alias("gas_heating"),
        S.mean_strict(S.kwh_to_mwh(PROPANE_KWH)).alias("propane_heating"),
        S.mean_strict(S.kwh_to_mwh(FUEL_OIL_KWH)).alias("fuel_oil_heating"),
        S.mean_strict(S.kbtu_to_mwh(F.col(LOAD_HEAT_KBTU))).alias(C.sanitize("out.load.heating.energy_delivered.mwh")),
        S.mean_strict(S.kbtu_to_mwh(F.col(LOAD_COOL_KBTU))).alias(C.sanitize("out.load.cooling.energy_delivered.mwh")),
    )
