"""Hourly roll-ups of 15-minute readings.

Plan shape (what Catalyst gets):

* every raw row only computes its hour bucket ``hour_utc`` (two interval shifts and
  a floor) and, for row sums over several measure columns, one addition chain;
* the aggregation is keyed by the *instant* ``hour_utc`` so Spark runs a map-side
  partial aggregate before the single shuffle (4 readings per hour -> 1 row);
* the time-zone conversion runs after the aggregate, on hour keys only;
* the per-building roll-up groups by *wall clock* and therefore merges the two
  instants of the repeated hour at the fall-back change. Only those rows (2 of
  ~8,760 per building and year) are regrouped; the rest pass straight through.

Measure columns use sanitized names (``out__electricity__net__energy_consumption``);
a measure missing from the input counts as all-NULL (so it sums to 0).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import semantics as S
from ..functions import timecols as TC

# Source measure names (sanitized) -- fixed values of the series schema.
NET = "out__electricity__net__energy_consumption"
COOL = "out__electricity__cooling__energy_consumption"
COOL_FANS = "out__electricity__cooling_fans_pumps__energy_consumption"
GAS_TOTAL = "out__natural_gas__total__energy_consumption"
GAS_HEAT = "out__natural_gas__heating__energy_consumption"
PROPANE_HEAT = "out__propane__heating__energy_consumption"
FUEL_OIL_HEAT = "out__fuel_oil__heating__energy_consumption"
LOAD_HEAT = "out__load__heating__energy_delivered__kbtu"
LOAD_COOL = "out__load__cooling__energy_delivered__kbtu"

HOUR_UTC = "hour_utc"
TIME_HR = "time_hr"
WALL = ("year", "month", "day", "hour")

# Fixed values that must equal the reference's for right results: the portfolio measures in output
# order, and whether a measure is divided by 1000 * N (energy columns are averaged MWh, loads stay
# kBtu sums, T14).
PORTFOLIO_SCALED = (("total_electricity_mwh", True), ("all_heating_electricity_mwh", True),
                    ("all_cooling_electricity_mwh", True), ("heating_load_kbtu", False),
                    ("cooling_load_kbtu", False), ("gas_total_mwh", True), ("gas_heating_mwh", True))
PORTFOLIO_MEASURES = tuple(name for name, _ in PORTFOLIO_SCALED)
# Fixed values that must equal the reference's for right results: the per-building measures (suffix
# after the arm prefix), in output order.
BUILDING_MEASURES = (".cooling.energy.kbtu.CP", ".heating.energy.kbtu.CP", "_total_elec_kwh",
                     "_cooling_total_elec_kwh", "_cooling_elec_kwh", "_cooling_fans_pumps_elec_kwh",
                     "_heating_elec_kwh", "_heating_gas_kwh", "_heating_propane_kwh", "_heating_fuel_oil_kwh")


@dataclass(frozen=True)
class Measure:
    name: str              # output name
    value: Column          # per-row value (before aggregation)
    per_building_mwh: bool  # divide the sum by 1000 * N (kWh -> MWh, mean over buildings)


def _measure_col(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("double")


def portfolio_measures(df: DataFrame) -> list[Measure]:
    """The seven portfolio measures; thermal totals use the *strict* selectors."""
    src = lambda name: _measure_col(df, name)
    values = [src(NET), S.row_sum(C.strict_thermal(df.columns, "heating")), S.row_sum(C.strict_thermal(df.columns, "cooling")),
              src(LOAD_HEAT), src(LOAD_COOL), src(GAS_TOTAL), src(GAS_HEAT)]
    return [Measure(name, value, scaled) for (name, scaled), value in zip(PORTFOLIO_SCALED, values, strict=True)]


def building_measures(df: DataFrame, prefix: str) -> list[Measure]:
    """The ten per-building measures; thermal totals use the *broad* selectors."""
    heat = C.broad_thermal(df.columns, "heating")
    cool = C.broad_thermal(df.columns, "cooling")
    out = lambda suffix: C.sanitize(prefix + suffix)
    src = lambda name: _measure_col(df, name)
    vals = [src(LOAD_COOL), src(LOAD_HEAT), src(NET), S.row_sum(cool), src(COOL), src(COOL_FANS),
            S.row_sum(heat), src(GAS_HEAT), src(PROPANE_HEAT), src(FUEL_OIL_HEAT)]
    return [Measure(out(sfx), v, False) for sfx, v in zip(BUILDING_MEASURES, vals)]


def with_hour(readings: DataFrame, ts: str = "timestamp") -> DataFrame:
    """D8 (row part): add the hour bucket of every reading."""
    return readings.withColumn(HOUR_UTC, TC.hour_utc(F.col(ts)))


def add_wall_clock(df: DataFrame, zone: str, from_col: str = HOUR_UTC, out: str = TIME_HR) -> DataFrame:
    """D8 (key part): local wall-clock hour and its year/month/day/hour."""
    df = df.withColumn(out, TC.to_local(F.col(from_col), zone))
    return df.withColumns(TC.wall_parts(F.col(out)))


def _arm_sums(df: DataFrame, keys: Sequence, measures: Sequence[Measure], arm_col: str | None,
              arms: Sequence[int] | None, measures_by_arm: dict[int, Sequence[Measure]] | None = None) -> DataFrame:
    """Conditional sums per arm (one aggregation, no join).

    For arm ``a`` the result has ``_n_a`` (row count) and ``_s_a_<measure>`` (sum,
    NULL when every value is NULL); ``measures_by_arm`` gives an arm its own
    measure list (e.g. differently prefixed names). With ``arms=None`` a single
    unconditioned set ``_n`` / ``_s_<measure>`` is produced.
    """
    aggs = []
    if arms is None:
        aggs.append(F.count(F.lit(1)).alias("_n"))
        aggs += [F.sum(m.value).alias(f"_s_{m.name}") for m in measures]
    else:
        for a in arms:
            hit = F.col(arm_col) == F.lit(a)
            ms = (measures_by_arm or {}).get(a, measures)
            aggs.append(F.count(F.when(hit, 1)).alias(f"_n_{a}"))
            aggs += [F.sum(F.when(hit, m.value)).alias(f"_s_{a}_{m.name}") for m in ms]
    return df.groupBy(*keys).agg(*aggs)


def _merge_repeated_hours(sums: DataFrame, keys: Sequence[str], zone: str) -> DataFrame:
    """Turn instant-keyed sums into wall-clock-keyed sums.

    ``keys`` are the non-time keys. Only rows of the repeated fall-back hour are
    regrouped (a shuffle of ~2/8760 of the rows); everything else is projected.

    The repeated-hour flag is tied to an aggregate output (the row count, always
    positive) so that the optimizer keeps both filters above the aggregate: one
    scan and one shuffle feed both branches (the exchange is reused), and the time
    zone is converted per hour key, not per reading.
    """
    counts = [c for c in sums.columns if c.startswith("_n")]
    val_cols = [c for c in sums.columns if c.startswith("_n") or c.startswith("_s_")]
    rows = reduce(lambda a, b: a + b, [F.col(c) for c in counts])
    flag = F.when(rows > 0, TC.is_repeated_local_hour(F.col(HOUR_UTC), zone))
    local = sums.select(*keys, *val_cols, TC.to_local(F.col(HOUR_UTC), zone).alias(TIME_HR),
                        flag.alias("_repeated"))
    single = local.where(~F.col("_repeated")).select(*keys, TIME_HR, *val_cols)
    merged = (local.where(F.col("_repeated"))
                   .groupBy(*keys, TIME_HR)
                   .agg(*[F.sum(c).alias(c) for c in val_cols]))
    return single.unionByName(merged)


# ---------------------------------------------------------------------------
# Portfolio roll-up
# ---------------------------------------------------------------------------

def _finish_portfolio(measures: Sequence[Measure], n_buildings: Column, suffix: str, present: Column,
                      count_src: str, sum_prefix: str) -> dict[str, Column]:
    """Output expressions of the portfolio measures from the conditional sums."""
    out = {f"interval_count{suffix}": F.when(present, F.col(count_src)).cast("long")}
    for m in measures:
        v = F.coalesce(F.col(f"{sum_prefix}{m.name}"), F.lit(0.0))      # T1
        if m.per_building_mwh:
            v = v / F.lit(S.KWH_PER_MWH) / n_buildings                       # A12
        out[f"{m.name}{suffix}"] = F.when(present, v)
    return out


def _attach_n(sums: DataFrame, n_buildings, group_cols: Sequence[str]) -> tuple[DataFrame, Column]:
    """Resolve the divisor N. A DataFrame (group_cols + ``n_buildings``) is joined
    after the aggregate -- it has one row per group (e.g. per configured scenario),
    so it is broadcast."""
    if isinstance(n_buildings, DataFrame):
        sums = sums.join(F.broadcast(n_buildings.select(*group_cols, "n_buildings")), list(group_cols), "inner")
        return sums, F.col("n_buildings").cast("double")
    return sums, _n_col(n_buildings)


def _n_col(n_buildings) -> Column:
    if isinstance(n_buildings, Column):
        return n_buildings.cast("double")
    if isinstance(n_buildings, str):
        return F.col(n_buildings).cast("double")
    return F.lit(float(n_buildings))


def portfolio_sums(readings: DataFrame, group_cols: Sequence[str] = (), arm_col: str = "upgrade",
                   ts: str = "timestamp") -> DataFrame:
    """Mergeable part of D9: per (groups, arm, hour instant) the row count ``_n`` and
    the raw sums ``_s_<measure>`` (NULL when every value is NULL). Sums of these
    sums over any split of the readings give the same result (streaming partials)."""
    keys = [*group_cols, arm_col, TC.hour_utc(F.col(ts)).alias(HOUR_UTC)]
    return _arm_sums(readings, keys, portfolio_measures(readings), None, None)


def merge_portfolio_sums(partials: DataFrame, group_cols: Sequence[str] = (), arm_col: str = "upgrade") -> DataFrame:
    """Combine partial sums (e.g. one set per micro-batch) into one row per hour."""
    vals = [c for c in partials.columns if c == "_n" or c.startswith("_s_")]
    return partials.groupBy(*group_cols, arm_col, HOUR_UTC).agg(*[F.sum(c).alias(c) for c in vals])


def finish_portfolio(sums: DataFrame, n_buildings, zone: str = TC.DEFAULT_ZONE, arm_col: str = "upgrade",
                     group_cols: Sequence[str] = (), arm_labels: dict[int, str] | None = None) -> DataFrame:
    """D9 output from (merged) sums: MWh averaged over N, loads as kBtu sums, wall clock.
    ``arm_labels`` adds the reference's ``type`` column (e.g. 0 -> "Baseline")."""
    measures = [Measure(name, F.lit(None), scaled) for name, scaled in PORTFOLIO_SCALED]
    sums, n = _attach_n(sums, n_buildings, group_cols)
    local = TC.to_local(F.col(HOUR_UTC), zone)
    fin = _finish_portfolio(measures, n, "", F.lit(True), "_n", "_s_")
    label = []
    if arm_labels:
        t = None
        for a, lab in arm_labels.items():
            t = F.when(F.col(arm_col) == a, F.lit(lab)) if t is None else t.when(F.col(arm_col) == a, F.lit(lab))
        label = [t.alias("type")]
    return sums.select(*group_cols, arm_col, *label, local.alias(TIME_HR), HOUR_UTC,
                       *[c.alias(k) for k, c in TC.wall_parts(local).items()],
                       *[c.alias(k) for k, c in fin.items()])


def hourly_portfolio(readings: DataFrame, n_buildings, zone: str = TC.DEFAULT_ZONE,
                     arm_col: str = "upgrade", group_cols: Sequence[str] = (), ts: str = "timestamp",
                     arm_labels: dict[int, str] | None = None) -> DataFrame:
    """Per (arm, hour instant): interval count and the seven measures, energy as
    MWh averaged over ``n_buildings`` (int, scalar Column, or a DataFrame of
    group_cols + ``n_buildings``).

    Output: *group_cols, arm, [type], time_hr, hour_utc, year, month, day, hour,
    interval_count, 7 measures. Both instants of the fall-back hour are kept.
    """
    sums = portfolio_sums(readings, group_cols, arm_col, ts)
    return finish_portfolio(sums, n_buildings, zone, arm_col, group_cols, arm_labels)


# ---------------------------------------------------------------------------
# Per-building roll-up
# ---------------------------------------------------------------------------

def hourly_by_building(readings: DataFrame, prefix: str, zone: str = TC.DEFAULT_ZONE,
                       group_cols: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Per (building, wall-clock hour): the ten measures named ``<prefix>...``,
    kWh / kBtu, not scaled. The repeated fall-back hour is one row (merged).

    Output: *group_cols, bldg_id, year, month, day, hour, 10 measures.
    """
    measures = building_measures(readings, prefix)
    keys = [*group_cols, "bldg_id"]
    sums = _arm_sums(readings, [*keys, TC.hour_utc(F.col(ts)).alias(HOUR_UTC)], measures, None, None)
    wall = _merge_repeated_hours(sums, keys, zone)
    parts = TC.wall_parts(F.col(TIME_HR))
    return wall.select(*keys, *[c.alias(k) for k, c in parts.items()],
                       *[F.coalesce(F.col(f"_s_{m.name}"), F.lit(0.0)).alias(m.name) for m in measures])


# ---------------------------------------------------------------------------
# One cube for both roll-ups (D9 and D10 from a single scan and shuffle)
# ---------------------------------------------------------------------------

_CUBE_BUILDING = "_b"   # neutral prefix of the per-building measures inside the cube


def hour_cube(readings: DataFrame, group_cols: Sequence[str] = (), arm_col: str = "upgrade",
              ts: str = "timestamp") -> DataFrame:
    """Per (groups, arm, building, hour instant): row count and the raw sums of both
    measure sets (strict portfolio set and broad per-building set, T15).

    One scan and one shuffle (after a map-side partial aggregate); persist or
    write it when both roll-ups are needed. :func:`portfolio_from_cube` and
    :func:`building_hours_from_cube` derive D9 and D10 from it."""
    measures = portfolio_measures(readings) + building_measures(readings, _CUBE_BUILDING)
    keys = [*group_cols, arm_col, "bldg_id", TC.hour_utc(F.col(ts)).alias(HOUR_UTC)]
    return _arm_sums(readings, keys, measures, None, None)


def portfolio_from_cube(cube: DataFrame, n_buildings, zone: str = TC.DEFAULT_ZONE, arm_col: str = "upgrade",
                        group_cols: Sequence[str] = (), arm_labels: dict[int, str] | None = None) -> DataFrame:
    """D9 from the cube: per (groups, arm, hour) the sums over buildings (the cube is
    ~8,760 x arms rows per building, so the partial aggregate collapses it per task)."""
    names = [name for name, _ in PORTFOLIO_SCALED]
    sums = cube.groupBy(*group_cols, arm_col, HOUR_UTC).agg(
        F.sum("_n").alias("_n"), *[F.sum(f"_s_{n}").alias(f"_s_{n}") for n in names])
    return finish_portfolio(sums, n_buildings, zone, arm_col, group_cols, arm_labels)


def building_hours_from_cube(cube: DataFrame, arm: int, prefix: str, zone: str = TC.DEFAULT_ZONE,
                             arm_col: str = "upgrade", group_cols: Sequence[str] = ()) -> DataFrame:
    """D10 from the cube for one arm: wall-clock hours (fall-back hour merged),
    measures named ``<prefix>...``."""
    src = [C.sanitize(_CUBE_BUILDING + sfx) for sfx in BUILDING_MEASURES]
    keys = [*group_cols, "bldg_id"]
    sums = cube.where(F.col(arm_col) == F.lit(arm)).select(*keys, HOUR_UTC, "_n", *[f"_s_{c}" for c in src])
    wall = _merge_repeated_hours(sums, keys, zone)
    parts = TC.wall_parts(F.col(TIME_HR))
    return wall.select(*keys, *[c.alias(k) for k, c in parts.items()],
                       *[F.coalesce(F.col(f"_s_{c}"), F.lit(0.0)).alias(C.sanitize(prefix + sfx))
                         for c, sfx in zip(src, BUILDING_MEASURES)])


# ---------------------------------------------------------------------------
# The cube by wall clock, for tables in buckets (J3 without an exchange)
# ---------------------------------------------------------------------------

def wall_cube(cube: DataFrame, zone: str = TC.DEFAULT_ZONE, arm_col: str = "upgrade") -> DataFrame:
    """The hour cube's building measures keyed by arm, building and wall-clock parts: what
    :func:`sources.bucketed.write_bucketed` deals by ``BUCKET_KEYS``. A building's hours lie
    in many buckets, so one that holds a large share of the rows fills none."""
    src = [C.sanitize(_CUBE_BUILDING + sfx) for sfx in BUILDING_MEASURES]
    local = TC.to_local(F.col(HOUR_UTC), zone)
    return cube.select(arm_col, "bldg_id", *[c.alias(k) for k, c in TC.wall_parts(local).items()], "_n", *[f"_s_{c}" for c in src])


BUCKET_KEYS = ("bldg_id", *WALL)


def building_hours_from_wall_cube(table: DataFrame, arm: int, prefix: str, arm_col: str = "upgrade") -> DataFrame:
    """D10 for one arm from a :func:`wall_cube`. The instants of the repeated hour are summed by an
    aggregate on the bucket keys, which needs no exchange where the table is in buckets."""
    src = [C.sanitize(_CUBE_BUILDING + sfx) for sfx in BUILDING_MEASURES]
    sums = table.where(F.col(arm_col) == F.lit(arm)).groupBy(*BUCKET_KEYS).agg(*[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in src])
    return sums.select(*BUCKET_KEYS, *[F.coalesce(F.col(f"_s_{c}"), F.lit(0.0)).alias(C.sanitize(prefix + sfx))
                                       for c, sfx in zip(src, BUILDING_MEASURES)])
