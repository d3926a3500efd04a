"""Baseline vs upgrade comparison.

Two forms of the portfolio comparison are offered:

* :func:`compare_arms` -- the reference's shape: two hourly tables (one per arm)
  joined on the hour (left join, baseline drives).
* :func:`portfolio_compare` -- the same result from ONE scan and ONE aggregation:
  every reading is routed to its arm by a conditional sum, so there is no join
  and no second scan. An hour is kept when it has baseline readings; the upgrade
  side is NULL when that hour has no upgrade reading (left-join semantics).

The per-building comparison (:func:`building_hour_compare`) uses the one-pass
form as well, keyed by (building, hour).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import semantics as S
from ..functions import timecols as TC
from . import rollup as R
from .joins import broadcast_bounded

BASE_SUFFIX = "_base"
UPG_SUFFIX = "_upg"

# Fixed values that must equal the reference's for right results: D11's derived columns, in output order.
DERIVED = ("total_electricity_savings", "heating_electricity_savings", "cooling_electricity_savings",
           "gas_total_savings", "gas_heating_savings", "cooling_load_ratio", "heating_load_ratio",
           "nonthermal_mwh", "nonthermal_gas", "cooling_mwh_scaled", "heating_mwh_scaled",
           "cooling_mwh_savings_scaled", "heating_mwh_savings_scaled", "total_mwh_scaled",
           "total_mwh_savings_scaled", "gas_heating_mwh_scaled", "gas_total_mwh_scaled")


def savings_columns(col: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """D11 formulas as expressions over ``<measure>_base`` / ``<measure>_upg``
    (``col`` resolves those names; by default plain column references).

    Later terms are built from earlier ones (sequential, T13) by reusing the
    expression objects, so the whole set is one projection; ratios are guarded
    (T6): zero baseline load gives 0, a NULL side stays NULL."""
    b = lambda m: col(m + BASE_SUFFIX)
    u = lambda m: col(m + UPG_SUFFIX)
    d: dict[str, Column] = {}
    d["total_electricity_savings"] = b("total_electricity_mwh") - u("total_electricity_mwh")
    d["heating_electricity_savings"] = b("all_heating_electricity_mwh") - u("all_heating_electricity_mwh")
    d["cooling_electricity_savings"] = b("all_cooling_electricity_mwh") - u("all_cooling_electricity_mwh")
    d["gas_total_savings"] = b("gas_total_mwh") - u("gas_total_mwh")
    d["gas_heating_savings"] = b("gas_heating_mwh") - u("gas_heating_mwh")
    d["cooling_load_ratio"] = S.safe_ratio(u("cooling_load_kbtu"), b("cooling_load_kbtu"))
    d["heating_load_ratio"] = S.safe_ratio(u("heating_load_kbtu"), b("heating_load_kbtu"))
    d["nonthermal_mwh"] = b("total_electricity_mwh") - (b("all_heating_electricity_mwh")
                                                        + b("all_cooling_electricity_mwh"))
    d["nonthermal_gas"] = b("gas_total_mwh") - b("gas_heating_mwh")
    d["cooling_mwh_scaled"] = b("all_cooling_electricity_mwh") * d["cooling_load_ratio"]
    d["heating_mwh_scaled"] = b("all_heating_electricity_mwh") * d["heating_load_ratio"]
    d["cooling_mwh_savings_scaled"] = d["cooling_mwh_scaled"] - u("all_cooling_electricity_mwh")
    d["heating_mwh_savings_scaled"] = d["heating_mwh_scaled"] - u("all_heating_electricity_mwh")
    d["total_mwh_scaled"] = d["heating_mwh_scaled"] + d["cooling_mwh_scaled"] + d["nonthermal_mwh"]
    d["total_mwh_savings_scaled"] = d["heating_mwh_savings_scaled"] + d["cooling_mwh_savings_scaled"]
    d["gas_heating_mwh_scaled"] = b("gas_heating_mwh") * d["heating_load_ratio"]
    d["gas_total_mwh_scaled"] = d["nonthermal_gas"] + d["gas_heating_mwh_scaled"]
    return d


def add_savings(df: DataFrame) -> DataFrame:
    """The 17 derived columns, appended in one projection."""
    return df.select("*", *[c.alias(n) for n, c in savings_columns().items()])


def _suffixed(names: Sequence[str], suffix: str) -> list[str]:
    return [n + suffix for n in names]


def _compare_columns(group_cols: Sequence[str]) -> list[str]:
    return [*group_cols, R.TIME_HR, R.HOUR_UTC, *R.WALL,
            "interval_count" + BASE_SUFFIX, *_suffixed(R.PORTFOLIO_MEASURES, BASE_SUFFIX),
            "interval_count" + UPG_SUFFIX, *_suffixed(R.PORTFOLIO_MEASURES, UPG_SUFFIX), *DERIVED]


def compare_arms(hr_base: DataFrame, hr_upg: DataFrame, group_cols: Sequence[str] = (),
                 arm_col: str = "upgrade") -> DataFrame:
    """D11 in join form: ``hr_base`` LEFT JOIN ``hr_upg`` on the hour instant.

    Inputs are :func:`rollup.hourly_portfolio` outputs. Same-named counts become
    ``interval_count_base`` / ``interval_count_upg`` (T11).
    """
    vals = ["interval_count", *R.PORTFOLIO_MEASURES]
    # The arm and its label (``type``) are not carried into the wide form
    base = hr_base.drop(arm_col, "type").withColumnsRenamed({v: v + BASE_SUFFIX for v in vals})
    upg = (hr_upg.drop(arm_col, "type", R.TIME_HR, *R.WALL)
                 .withColumnsRenamed({v: v + UPG_SUFFIX for v in vals}))
    joined = base.join(upg, [*group_cols, R.HOUR_UTC], "left")
    return add_savings(joined).select(*_compare_columns(group_cols))


def portfolio_compare(readings: DataFrame, n_buildings, base_arm: int, upg_arm: int,
                      zone: str = TC.DEFAULT_ZONE, arm_col: str = "upgrade",
                      group_cols: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """D9 x 2 + D11 in one pass (R5 as conditional aggregation).

    ``n_buildings``: int, scalar Column, or a DataFrame of group_cols + ``n_buildings``
    (one row per group, e.g. per scenario).
    """
    measures = R.portfolio_measures(readings)
    rd = readings.where(F.col(arm_col).isin(base_arm, upg_arm))
    sums = R._arm_sums(rd, [*group_cols, TC.hour_utc(F.col(ts)).alias(R.HOUR_UTC)], measures, arm_col,
                       (base_arm, upg_arm))
    return _finish_compare(sums, measures, n_buildings, base_arm, upg_arm, zone, group_cols)


def portfolio_compare_from_cube(cube: DataFrame, n_buildings, base_arm: int, upg_arm: int,
                                zone: str = TC.DEFAULT_ZONE, arm_col: str = "upgrade",
                                group_cols: Sequence[str] = ()) -> DataFrame:
    """:func:`portfolio_compare` from the hour cube (joined to its groups)."""
    measures = [R.Measure(name, F.lit(None), scaled) for name, scaled in R.PORTFOLIO_SCALED]
    aggs = []
    for a in (base_arm, upg_arm):
        hit = F.col(arm_col) == F.lit(a)
        aggs.append(F.sum(F.when(hit, F.col("_n")).otherwise(0)).alias(f"_n_{a}"))
        aggs += [F.sum(F.when(hit, F.col(f"_s_{m.name}"))).alias(f"_s_{a}_{m.name}") for m in measures]
    return _finish_compare(cube.groupBy(*group_cols, R.HOUR_UTC).agg(*aggs), measures, n_buildings, base_arm, upg_arm,
                           zone, group_cols)


def _finish_compare(sums: DataFrame, measures, n_buildings, base_arm: int, upg_arm: int, zone: str,
                    group_cols: Sequence[str]) -> DataFrame:
    """The comparison's columns from the conditional sums of both arms."""
    sums, n = R._attach_n(sums, n_buildings, group_cols)
    has_upg = F.col(f"_n_{upg_arm}") > 0
    local = TC.to_local(F.col(R.HOUR_UTC), zone)
    cols = {
        **{g: F.col(g) for g in group_cols},
        R.TIME_HR: local, R.HOUR_UTC: F.col(R.HOUR_UTC),
        **TC.wall_parts(local),
        **R._finish_portfolio(measures, n, BASE_SUFFIX, F.lit(True), f"_n_{base_arm}", f"_s_{base_arm}_"),
        **R._finish_portfolio(measures, n, UPG_SUFFIX, has_upg, f"_n_{upg_arm}", f"_s_{upg_arm}_"),
    }
    # the savings read the finished measures directly (one projection)
    out = {**cols, **savings_columns(lambda name: cols[name])}
    return sums.where(F.col(f"_n_{base_arm}") > 0).select(
        *[out[c].alias(c) for c in _compare_columns(group_cols)])


def building_hour_compare(readings: DataFrame, base_arm: int, upg_arm: int,
                          zone: str = TC.DEFAULT_ZONE, arm_col: str = "upgrade",
                          prefixes: tuple[str, str] = ("baseline", "upgrade"),
                          group_cols: Sequence[str] = (), ts: str = "timestamp",
                          only_local_hours: Sequence[str] | None = None) -> DataFrame:
    """D10 x 2 + D12: per (building, wall-clock hour) baseline LEFT JOIN upgrade, with
    ``time_hour``. One scan, one aggregation.

    ``only_local_hours`` restricts the work to some wall-clock hours (peak slices):
    a redundant range test on the raw timestamp (parquet can skip row groups) and
    the exact test on the hour key, both before the aggregation.
    """
    cond = F.col(arm_col).isin(base_arm, upg_arm)
    hour = TC.hour_utc(F.col(ts))
    if only_local_hours:
        window = None
        for h in only_local_hours:
            w = TC.raw_window_for_local_hour(F.col(ts), h)
            window = w if window is None else (window | w)
        cond = cond & window & TC.to_local(hour, zone).isin([TC.ntz_literal(h) for h in only_local_hours])
    mb = R.building_measures(readings, prefixes[0])
    mu = R.building_measures(readings, prefixes[1])
    # one conditional sum per arm; each arm's measures carry its own name prefix
    keys = [*group_cols, "bldg_id"]
    sums = R._arm_sums(readings.where(cond), [*keys, hour.alias(R.HOUR_UTC)], mb, arm_col, (base_arm, upg_arm),
                       {base_arm: mb, upg_arm: mu})
    wall = R._merge_repeated_hours(sums, keys, zone)
    has_upg = F.col(f"_n_{upg_arm}") > 0
    parts = TC.wall_parts(F.col(R.TIME_HR))
    return wall.where(F.col(f"_n_{base_arm}") > 0).select(
        *keys, *[c.alias(k) for k, c in parts.items()],
        *[F.coalesce(F.col(f"_s_{base_arm}_{m.name}"), F.lit(0.0)).alias(m.name) for m in mb],
        *[F.when(has_upg, F.coalesce(F.col(f"_s_{upg_arm}_{m.name}"), F.lit(0.0))).alias(m.name) for m in mu],
        F.col(R.TIME_HR).alias("time_hour"),
    )


def join_building_arms(b1: DataFrame, u1: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """D12 in the reference's join form: two :func:`rollup.hourly_by_building`
    outputs joined LEFT on (building, wall-clock hour) (J3)."""
    keys = [*group_cols, "bldg_id", *R.WALL]
    out = b1.join(u1, keys, "left")
    return out.withColumn("time_hour", TC.make_wall_hour("year", "month", "day", "hour"))


# ---------------------------------------------------------------------------
# Peak-hour slices enriched with building attributes
# ---------------------------------------------------------------------------

# Fixed values that must equal the reference's for right results: the attributes of a peak slice.
ATTRIBUTE_COLUMNS = (
    "bldg_id", "in.sqft", "in.ground_thermal_conductivity", "in.vintage", "in.heating_fuel",
    "in.hvac_heating_efficiency", "in.hvac_cooling_efficiency", "in.hvac_cooling_partial_space_conditioning",
    "in.hvac_has_ducts", "out.unmet_hours.cooling.hour", "out.unmet_hours.heating.hour",
    "out.params.size_heating_system_primary_k_btu_h", "out.params.size_cooling_system_primary_k_btu_h",
)
SIZE_HEAT = C.sanitize("out.params.size_heating_system_primary_k_btu_h")
SIZE_COOL = C.sanitize("out.params.size_cooling_system_primary_k_btu_h")
PARTIAL = C.sanitize("in.hvac_cooling_partial_space_conditioning")


def building_attributes(base_meta: DataFrame, upg_meta: DataFrame) -> DataFrame:
    """Selected metadata, upgrade heating size (left join, J4), conditioned area."""
    sel = base_meta.select(*[C.sanitize(c) for c in ATTRIBUTE_COLUMNS])
    upg = upg_meta.select("bldg_id", F.col(SIZE_HEAT).alias("upgrade_heating_size"))
    df = sel.join(upg, "bldg_id", "left")
    df = df.withColumnsRenamed({SIZE_HEAT: "base_heating_size", SIZE_COOL: "base_cooling_size"})
    df = df.withColumn(PARTIAL, S.extract_number(F.col(PARTIAL)))
    return df.withColumn("sqft_conditioned", F.col("in__sqft") * F.col(PARTIAL))


def peak_hour_slice(bhc: DataFrame, peak_hour: str) -> DataFrame:
    """Rows of one wall-clock hour (timestamp equality, not text, T12)."""
    return bhc.where(F.col("time_hour") == TC.ntz_literal(peak_hour))


def slice_with_attributes(base_meta: DataFrame, upg_meta: DataFrame, slice_df: DataFrame,
                          id_bound: int | None = None) -> DataFrame:
    """D13 + D14 with the metadata reduced first: both metadata tables are
    semi-joined to the slice's buildings before the attribute join, so nothing
    touches the metadata of buildings outside the slice. ``id_bound`` (known from
    the configuration, e.g. the total sample size) allows broadcasting the ids."""
    ids = broadcast_bounded(slice_df.select("bldg_id").distinct(), id_bound)
    attrs = building_attributes(base_meta.join(ids, "bldg_id", "left_semi"),
                                upg_meta.join(ids, "bldg_id", "left_semi"))
    return enrich_slice(attrs, slice_df)


def enrich_slice(attributes: DataFrame, slice_df: DataFrame) -> DataFrame:
    """D13 join (J5): attributes INNER JOIN slice on bldg_id. The slice holds at most
    one row per sampled building per group; AQE turns this into a broadcast join
    from the slice's measured size."""
    return attributes.join(slice_df, "bldg_id", "inner")
