"""Independent DuckDB SQL for every registered query (the correctness oracle).

Tables are the driver's parquet views. The re-aimed inputs are written here a
second time, as SQL CTEs, from the rules documented in ``sources.driver_views``.
"""

from __future__ import annotations

from ..config import REFERENCE_SCENARIO_LABELS
from ..functions import columns as C
from ..operators import compare as CMP
from ..operators import rollup as R
from ..sources import driver_views as V

D = 7  # rounding digits, as in plans.queries.ROUND_DIGITS
ZONE = "America/New_York"

READINGS_CTE = """
readings AS (
  SELECT user_id AS bldg_id, CAST(event_id % 2 AS INTEGER) AS upgrade, ts AS ts,
    CASE WHEN event_type IN ('click','view','signup') THEN value END AS net,
    CASE WHEN event_type = 'click' THEN value END AS heat,
    CASE WHEN event_type = 'error' THEN value END AS heat_fans,
    CASE WHEN event_type = 'view' THEN value END AS cool,
    CASE WHEN event_type = 'signup' THEN value END AS cool_fans,
    CASE WHEN event_type IN ('purchase','error') THEN value END AS gas_total,
    CASE WHEN event_type = 'purchase' THEN value END AS gas_heat,
    CASE WHEN event_type = 'error' THEN value END AS propane_heat,
    CASE WHEN event_type = 'purchase' AND value > 300 THEN value END AS fuel_oil_heat,
    CASE WHEN event_type IN ('click','purchase') THEN value END AS load_heat,
    CASE WHEN event_type IN ('view','error') THEN value END AS load_cool
  FROM events
),
rh AS (
  SELECT *, date_trunc('hour', ts + INTERVAL 5 HOUR - INTERVAL 5 MINUTE) AS hour_utc FROM readings
),
nreq AS (SELECT CAST(count(DISTINCT c_custkey) AS DOUBLE) AS n FROM customer)
"""


def shifted(sql: str) -> str:
    """The same query over readings moved across the autumn clock change."""
    return sql.replace("event_id % 2 AS INTEGER) AS upgrade, ts AS ts",
                       f"event_id % 2 AS INTEGER) AS upgrade, ts + INTERVAL {V.DRIVER_AUTUMN_SHIFT_DAYS} DAY AS ts")


def local(expr: str) -> str:
    return f"timezone('{ZONE}', timezone('UTC', {expr}))"


def wall(expr: str) -> str:
    return (f"CAST(year({expr}) AS BIGINT) AS year, CAST(month({expr}) AS BIGINT) AS month, "
            f"CAST(day({expr}) AS BIGINT) AS day, CAST(hour({expr}) AS BIGINT) AS hour")


def rnd(expr: str, name: str) -> str:
    return f"round(({expr}), {D}) AS {name}"


# portfolio sums per hour instant, for one arm (or all rows when arm is None)
def _portfolio_sql(arm_filter: str, with_arm: bool) -> str:
    arm = "CAST(upgrade AS BIGINT) AS upgrade, " if with_arm else ""
    grp = "upgrade, hour_utc" if with_arm else "hour_utc"
    return f"""
SELECT {arm}{local('hour_utc')} AS time_hr, hour_utc, {wall(local('hour_utc'))},
  count(*) AS interval_count,
  coalesce(sum(net), 0) / 1000 / (SELECT n FROM nreq) AS total_electricity_mwh,
  coalesce(sum(coalesce(heat, 0)), 0) / 1000 / (SELECT n FROM nreq) AS all_heating_electricity_mwh,
  coalesce(sum(coalesce(cool, 0)), 0) / 1000 / (SELECT n FROM nreq) AS all_cooling_electricity_mwh,
  coalesce(sum(load_heat), 0) AS heating_load_kbtu,
  coalesce(sum(load_cool), 0) AS cooling_load_kbtu,
  coalesce(sum(gas_total), 0) / 1000 / (SELECT n FROM nreq) AS gas_total_mwh,
  coalesce(sum(gas_heat), 0) / 1000 / (SELECT n FROM nreq) AS gas_heating_mwh
FROM rh {arm_filter} GROUP BY {grp}"""


HOURLY_PORTFOLIO = f"""
WITH {READINGS_CTE}
SELECT upgrade, CASE upgrade WHEN 0 THEN 'Baseline' WHEN 1 THEN 'Upgrade' END AS type,
  time_hr, hour_utc, year, month, day, hour, interval_count,
  {', '.join(rnd(m, m) for m in R.PORTFOLIO_MEASURES)}
FROM ({_portfolio_sql('', True)}) p
"""

# D11 derived columns in SQL, over columns <m>_base / <m>_upg
DERIVED_SQL = """
  b.total_electricity_mwh - u.total_electricity_mwh AS total_electricity_savings,
  b.all_heating_electricity_mwh - u.all_heating_electricity_mwh AS heating_electricity_savings,
  b.all_cooling_electricity_mwh - u.all_cooling_electricity_mwh AS cooling_electricity_savings,
  b.gas_total_mwh - u.gas_total_mwh AS gas_total_savings,
  b.gas_heating_mwh - u.gas_heating_mwh AS gas_heating_savings,
  CASE WHEN b.cooling_load_kbtu = 0 THEN 0 ELSE u.cooling_load_kbtu / b.cooling_load_kbtu END AS cooling_load_ratio,
  CASE WHEN b.heating_load_kbtu = 0 THEN 0 ELSE u.heating_load_kbtu / b.heating_load_kbtu END AS heating_load_ratio,
  b.total_electricity_mwh - (b.all_heating_electricity_mwh + b.all_cooling_electricity_mwh) AS nonthermal_mwh,
  b.gas_total_mwh - b.gas_heating_mwh AS nonthermal_gas
"""
DERIVED_SQL_2 = """
  all_cooling_electricity_mwh_base * cooling_load_ratio AS cooling_mwh_scaled,
  all_heating_electricity_mwh_base * heating_load_ratio AS heating_mwh_scaled,
  all_cooling_electricity_mwh_base * cooling_load_ratio - all_cooling_electricity_mwh_upg AS cooling_mwh_savings_scaled,
  all_heating_electricity_mwh_base * heating_load_ratio - all_heating_electricity_mwh_upg AS heating_mwh_savings_scaled,
  all_heating_electricity_mwh_base * heating_load_ratio + all_cooling_electricity_mwh_base * cooling_load_ratio
    + nonthermal_mwh AS total_mwh_scaled,
  (all_heating_electricity_mwh_base * heating_load_ratio - all_heating_electricity_mwh_upg)
    + (all_cooling_electricity_mwh_base * cooling_load_ratio - all_cooling_electricity_mwh_upg) AS total_mwh_savings_scaled,
  gas_heating_mwh_base * heating_load_ratio AS gas_heating_mwh_scaled,
  nonthermal_gas + gas_heating_mwh_base * heating_load_ratio AS gas_total_mwh_scaled
"""



def _compare_cte() -> str:
    base_cols = ", ".join(f"b.{m} AS {m}_base" for m in R.PORTFOLIO_MEASURES)
    upg_cols = ", ".join(f"u.{m} AS {m}_upg" for m in R.PORTFOLIO_MEASURES)
    return f"""
b AS ({_portfolio_sql('WHERE upgrade = 0', False)}),
u AS ({_portfolio_sql('WHERE upgrade = 1', False)}),
j AS (
  SELECT b.time_hr, b.hour_utc, b.year, b.month, b.day, b.hour,
    b.interval_count AS interval_count_base, {base_cols},
    u.interval_count AS interval_count_upg, {upg_cols},
    {DERIVED_SQL}
  FROM b LEFT JOIN u ON b.hour_utc = u.hour_utc
),
k AS (SELECT *, {DERIVED_SQL_2} FROM j)"""


_CMP_MEASURES = [f"{m}_base" for m in R.PORTFOLIO_MEASURES] + [f"{m}_upg" for m in R.PORTFOLIO_MEASURES]

COMPARE_ARMS = f"""
WITH {READINGS_CTE}, {_compare_cte()}
SELECT time_hr, hour_utc, year, month, day, hour, interval_count_base, interval_count_upg,
  {', '.join(rnd(c, c) for c in _CMP_MEASURES + list(CMP.DERIVED))}
FROM k
"""

# ---- per building ------------------------------------------------------------------

# per-building measure expressions, in rollup.BUILDING_MEASURES order (broad thermal sets)
_BUILDING_SQL = ["load_cool", "load_heat", "net", "coalesce(cool, 0) + coalesce(cool_fans, 0)", "cool", "cool_fans",
                 "coalesce(heat, 0) + coalesce(heat_fans, 0)", "gas_heat", "propane_heat", "fuel_oil_heat"]

RL_CTE = f"""
rl AS (
  SELECT *, year(lt) AS y, month(lt) AS m, day(lt) AS d, hour(lt) AS h
  FROM (SELECT *, {local('hour_utc')} AS lt FROM rh)
)"""


def _bname(prefix: str, suffix: str) -> str:
    return C.sanitize(prefix + suffix)


def _building_sql(prefix: str, arm: int) -> str:
    cols = ", ".join(f"coalesce(sum({e}), 0) AS {_bname(prefix, sfx)}"
                     for e, sfx in zip(_BUILDING_SQL, R.BUILDING_MEASURES))
    return f"SELECT bldg_id, y, m, d, h, {cols} FROM rl WHERE upgrade = {arm} GROUP BY bldg_id, y, m, d, h"


def _hourly_by_building(prefix: str, arm: int) -> str:
    outs = ", ".join(rnd(_bname(prefix, sfx), _bname(prefix, sfx)) for sfx in R.BUILDING_MEASURES)
    return f"""
WITH {READINGS_CTE}, {RL_CTE}
SELECT bldg_id, CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS month, CAST(d AS BIGINT) AS day,
  CAST(h AS BIGINT) AS hour, {outs}
FROM ({_building_sql(prefix, arm)})
"""


BHC_CTE = f"""
{RL_CTE},
b1 AS ({_building_sql('baseline', 0)}),
u1 AS ({_building_sql('upgrade', 1)}),
bhc AS (
  SELECT b1.bldg_id, CAST(b1.y AS BIGINT) AS year, CAST(b1.m AS BIGINT) AS month, CAST(b1.d AS BIGINT) AS day,
    CAST(b1.h AS BIGINT) AS hour,
    {', '.join(rnd('b1.' + _bname('baseline', s), _bname('baseline', s)) for s in R.BUILDING_MEASURES)},
    {', '.join(rnd('u1.' + _bname('upgrade', s), _bname('upgrade', s)) for s in R.BUILDING_MEASURES)},
    make_timestamp(b1.y, b1.m, b1.d, b1.h, 0, 0.0) AS time_hour
  FROM b1 LEFT JOIN u1 ON b1.bldg_id = u1.bldg_id AND b1.y = u1.y AND b1.m = u1.m AND b1.d = u1.d AND b1.h = u1.h
)"""

BUILDING_HOUR_COMPARE = f"WITH {READINGS_CTE}, {BHC_CTE} SELECT * FROM bhc"

# ---- building metadata ----------------------------------------------------------------

META_CTE = f"""
ob AS (
  SELECT o_custkey AS ob_id, sum(o_totalprice) AS sum_price, min(o_totalprice) AS min_price,
    count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{V.EARLY_BEFORE}') AS n_early,
    max(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '{V.EARLY_BEFORE}') AS max_early,
    count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{V.LATE_FROM}') AS n_late,
    max(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '{V.LATE_FROM}') AS max_late,
    min(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '{V.LATE_FROM}') AS min_late,
    min(o_orderpriority) FILTER (WHERE o_orderdate >= TIMESTAMP '{V.RECENT_FROM}') AS top_recent
  FROM orders GROUP BY o_custkey
),
m0 AS (
  SELECT c.c_custkey, c.c_acctbal, c.c_nationkey, c.c_mktsegment, n.n_regionkey, r.r_name, ob.*,
    CASE WHEN c.c_nationkey < 10 THEN 'Electricity' WHEN c.c_nationkey < 20 THEN 'Natural Gas'
         WHEN c.c_nationkey < 23 THEN 'Propane' ELSE 'Fuel Oil' END AS fuel
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN ob ON c.c_custkey = ob.ob_id
),
meta AS (
  SELECT c_custkey AS bldg_id,
    CASE WHEN c_acctbal >= -500 THEN 'True' ELSE 'False' END AS applicability,
    r_name AS btype,
    CASE WHEN c_acctbal >= 0 THEN 'Yes' ELSE 'No' END AS in__hvac_has_ducts,
    CASE WHEN n_early > 0 THEN 'Occupied' ELSE 'Vacant' END AS vacancy,
    CASE WHEN top_recent IN ('1-URGENT', '2-HIGH') THEN 'Central AC' ELSE 'Room AC' END AS cooltype,
    CAST(1000 + 500 * floor((c_acctbal + 1000) / 2200) AS INTEGER) AS in__sqft,
    c_mktsegment AS in__vintage,
    CASE WHEN c_nationkey < 10 THEN 'Electric Furnace, 100% AFUE' WHEN c_nationkey < 20 THEN 'Fuel Furnace, 80% AFUE'
         ELSE 'Fuel Boiler, 80% AFUE' END AS in__hvac_heating_efficiency,
    fuel AS in__heating_fuel,
    CASE WHEN c_acctbal < 5000 THEN 'AC, SEER 13' ELSE 'AC, SEER 15' END AS in__hvac_cooling_efficiency,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '100% Conditioned' WHEN 'MACHINERY' THEN '80% Conditioned'
         WHEN 'FURNITURE' THEN '60% Conditioned' WHEN 'AUTOMOBILE' THEN '<10% Conditioned' ELSE 'None' END AS partial_text,
    CAST(0.8 AS DOUBLE) + CAST(0.3 AS DOUBLE) * n_regionkey AS in__ground_thermal_conductivity,
    CAST(n_early AS DOUBLE) / 2 AS out__unmet_hours__cooling__hour,
    CAST(c_nationkey AS DOUBLE) / 4 AS out__unmet_hours__heating__hour,
    max_early / 10000 AS size_heat,
    (c_acctbal + 1000) / 400 AS size_cool,
    sum_price / 100 AS total_kwh,
    max_early / 50 AS heat_kwh,
    c_acctbal + 1000 AS cool_kwh,
    CASE WHEN fuel = 'Natural Gas' THEN sum_price / 40 ELSE 0 END AS gas_kwh,
    CASE WHEN fuel = 'Propane' THEN sum_price / 40 ELSE 0 END AS propane_kwh,
    CASE WHEN fuel = 'Fuel Oil' THEN sum_price / 40 ELSE 0 END AS fuel_oil_kwh,
    sum_price / 20 AS load_heat_kbtu,
    (c_acctbal + 1000) * 3 AS load_cool_kbtu
  FROM m0
),
umeta AS (
  SELECT ob_id AS bldg_id, n_late >= {V.UPGRADE_MIN_LATE_ORDERS} AS applicability,
    max_late / 8000 AS size_heat, min_late / 8000 AS size_cool
  FROM ob WHERE n_late > 0
),
attrs AS (
  SELECT m.bldg_id, m.in__sqft, m.in__ground_thermal_conductivity, m.in__vintage, m.in__heating_fuel,
    m.in__hvac_heating_efficiency, m.in__hvac_cooling_efficiency,
    CAST(nullif(regexp_extract(m.partial_text, '\\d+'), '') AS DOUBLE) / 100 AS in__hvac_cooling_partial_space_conditioning,
    m.in__hvac_has_ducts, m.out__unmet_hours__cooling__hour, m.out__unmet_hours__heating__hour,
    m.size_heat AS base_heating_size, m.size_cool AS base_cooling_size, u.size_heat AS upgrade_heating_size,
    m.in__sqft * (CAST(nullif(regexp_extract(m.partial_text, '\\d+'), '') AS DOUBLE) / 100) AS sqft_conditioned
  FROM meta m LEFT JOIN umeta u ON m.bldg_id = u.bldg_id
)"""

_ATTR_DOUBLES = ["in__ground_thermal_conductivity", "in__hvac_cooling_partial_space_conditioning",
                 "out__unmet_hours__cooling__hour", "out__unmet_hours__heating__hour", "base_heating_size",
                 "base_cooling_size", "upgrade_heating_size", "sqft_conditioned"]
_ATTR_OTHER = ["bldg_id", "in__vintage", "in__heating_fuel", "in__hvac_heating_efficiency",
               "in__hvac_cooling_efficiency", "in__hvac_has_ducts"]
_ATTR_SELECT = ", ".join([f"a.{c} AS {c}" for c in _ATTR_OTHER] + ["CAST(a.in__sqft AS BIGINT) AS in__sqft"]
                         + [rnd("a." + c, c) for c in _ATTR_DOUBLES])

BUILDING_ATTRIBUTES = f"WITH {META_CTE} SELECT {_ATTR_SELECT} FROM attrs a"

PEAK_HOUR_SLICE = f"""
WITH {READINGS_CTE}, {BHC_CTE}, {META_CTE}
SELECT {_ATTR_SELECT}, s.* EXCLUDE (bldg_id)
FROM attrs a JOIN (SELECT * FROM bhc WHERE time_hour = TIMESTAMP '{V.DRIVER_PEAK_HOUR}') s ON a.bldg_id = s.bldg_id
"""

# ---- reports --------------------------------------------------------------------------

ANNUAL_ENERGY = f"""
WITH {READINGS_CTE}, {_compare_cte()},
t AS (
  SELECT coalesce(sum(all_heating_electricity_mwh_base), 0) AS eh_b, coalesce(sum(all_cooling_electricity_mwh_base), 0) AS ec_b,
    coalesce(sum(gas_heating_mwh_base), 0) AS gh_b,
    coalesce(sum(heating_mwh_scaled), 0) AS eh_s, coalesce(sum(cooling_mwh_scaled), 0) AS ec_s,
    coalesce(sum(gas_heating_mwh_scaled), 0) AS gh_s,
    coalesce(sum(all_heating_electricity_mwh_upg), 0) AS eh_u, coalesce(sum(all_cooling_electricity_mwh_upg), 0) AS ec_u,
    coalesce(sum(gas_heating_mwh_upg), 0) AS gh_u
  FROM k
)
SELECT 'Baseline' AS scenario, round((eh_b), {D}) AS elec_heating_mwh, round((ec_b), {D}) AS elec_cooling_mwh,
  round((gh_b), {D}) AS gas_heating_mwh FROM t
UNION ALL SELECT 'Baseline (Scaled Up)', round((eh_s), {D}), round((ec_s), {D}), round((gh_s), {D}) FROM t
UNION ALL SELECT 'Upgrade', round((eh_u), {D}), round((ec_u), {D}), round((gh_u), {D}) FROM t
"""


def _peak_day(day: str, kind: str) -> str:
    src = {"cooling": ("all_cooling_electricity_mwh_base", "all_cooling_electricity_mwh_upg", "cooling_mwh_scaled"),
           "heating": ("all_heating_electricity_mwh_base", "all_heating_electricity_mwh_upg", "heating_mwh_scaled")}[kind]
    return f"""
WITH {READINGS_CTE}, {_compare_cte()}
SELECT time_hr, round(({src[0]} * 1000), {D}) AS {kind}_kw_base, round(({src[1]} * 1000), {D}) AS {kind}_kw_upg,
  round(({src[2]} * 1000), {D}) AS {kind}_kw_scaled
FROM k WHERE CAST(time_hr AS DATE) = DATE '{day}'
"""


PROFILE_LONG = f"""
WITH {READINGS_CTE}, {_compare_cte()},
p AS (SELECT * FROM k WHERE CAST(time_hr AS DATE) = DATE '{V.DRIVER_PEAK_DAY}')
SELECT time_hr, 'Baseline AC (Unscaled)' AS series, CAST(1 AS BIGINT) AS series_rank,
  round((all_cooling_electricity_mwh_base * 1000), {D}) AS value FROM p
UNION ALL SELECT time_hr, 'Baseline AC (Scaled Up)', 2, round((cooling_mwh_scaled * 1000), {D}) FROM p
UNION ALL SELECT time_hr, 'GSHP Cooling', 3, round((all_cooling_electricity_mwh_upg * 1000), {D}) FROM p
"""

LOCAL_HOUR_DST = f"""
WITH {READINGS_CTE},
mv AS (SELECT 60 AS shift_days, ts + INTERVAL 60 DAY AS t FROM readings
       UNION ALL SELECT 300, ts + INTERVAL 300 DAY FROM readings),
inst AS (SELECT shift_days, date_trunc('hour', t + INTERVAL 5 HOUR - INTERVAL 5 MINUTE) AS hu, count(*) AS n
         FROM mv GROUP BY 1, 2),
w AS (SELECT shift_days, {local('hu')} AS time_hr, n FROM inst)
SELECT CAST(shift_days AS BIGINT) AS shift_days, time_hr, {wall('time_hr')},
  CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_instants
FROM w GROUP BY shift_days, time_hr
"""

DISTINCT_IDS = "SELECT DISTINCT user_id AS bldg_id, CAST(event_id % 2 AS BIGINT) AS upgrade FROM events"

# ---- sampling -----------------------------------------------------------------------------


def _sql_list(values, kind: str) -> str:
    if values is None:
        return f"CAST(NULL AS {kind}[])"
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"CAST([{items}] AS {kind}[])"


def _sql_text(v) -> str:
    return "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"


_SCEN_ROWS = ",\n    ".join(
    f"('{s.scenario}', {_sql_text(s.building_type)}, {_sql_text(s.ducts_required)}, {_sql_text(s.vacancy_required)}, "
    f"{_sql_text(s.cooling_type_required)}, {s.sample_size}, {s.seed}, {_sql_list(s.sqft_allowed, 'INTEGER')}, "
    f"{_sql_list(s.vintage_allowed, 'VARCHAR')}, {_sql_text(s.hvac_efficiency)}, {_sql_text(s.heating_fuel)})"
    for s in V.DRIVER_SCENARIOS)

SAMPLE_CTE = f"""
pb AS (
  SELECT *, coalesce(lower(applicability) IN ('true', 't', '1', 'yes', 'y'), false) AS appl_bool,
    coalesce(heat_kwh, 0) AS heating_electricity_kwh, coalesce(cool_kwh, 0) AS cooling_electricity_kwh,
    coalesce(heat_kwh, 0) + coalesce(cool_kwh, 0) AS thermal_electricity_kwh,
    total_kwh - (coalesce(heat_kwh, 0) + coalesce(cool_kwh, 0)) AS nonthermal_electricity_kwh,
    size_heat / 12 AS heating_tons, size_cool / 12 AS cooling_tons,
    CASE WHEN size_heat IS NULL OR size_cool IS NULL THEN NULL ELSE greatest(size_heat / 12, size_cool / 12) END AS tons
  FROM meta
),
pu AS (SELECT bldg_id AS u_id, applicability AS applicability5, size_heat / 12 AS upgrade_tons_heating,
         size_cool / 12 AS upgrade_tons_cooling FROM umeta),
scen(scenario, building_type, ducts_required, vacancy_required, cooling_type_required, sample_size, seed,
     sqft_allowed, vintage_allowed, hvac_efficiency, heating_fuel) AS (VALUES
    {_SCEN_ROWS}),
pool AS (
  SELECT s.scenario, s.sample_size, s.seed, pb.*, pu.*
  FROM pb JOIN pu ON pb.bldg_id = pu.u_id
  JOIN scen s ON pb.btype = s.building_type AND pb.in__hvac_has_ducts = s.ducts_required
    AND pb.vacancy = s.vacancy_required AND pb.cooltype = s.cooling_type_required
  WHERE pb.appl_bool AND pu.applicability5
    AND (s.sqft_allowed IS NULL OR list_contains(s.sqft_allowed, pb.in__sqft))
    AND (s.vintage_allowed IS NULL OR list_contains(s.vintage_allowed, pb.in__vintage))
    AND (s.hvac_efficiency IS NULL OR pb.in__hvac_heating_efficiency = s.hvac_efficiency)
    AND (s.heating_fuel IS NULL OR pb.in__heating_fuel = s.heating_fuel)
),
sample AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY scenario
      ORDER BY md5(CAST(seed AS VARCHAR) || '-' || CAST(bldg_id AS VARCHAR)), bldg_id) AS rk
    FROM pool) WHERE rk <= sample_size
)"""

_POOL_SELECT = (f"scenario, bldg_id, {rnd('tons', 'tons')}, {rnd('nonthermal_electricity_kwh', 'nonthermal_electricity_kwh')}, "
                f"{rnd('upgrade_tons_heating', 'upgrade_tons_heating')}, {rnd('upgrade_tons_cooling', 'upgrade_tons_cooling')}")

_d0 = V.DRIVER_SCENARIOS[0]
PREP_BASELINE = f"""
WITH {META_CTE}, {SAMPLE_CTE}
SELECT bldg_id, appl_bool AS applicability,
  {', '.join(rnd(c, c) for c in ['heating_electricity_kwh', 'cooling_electricity_kwh', 'thermal_electricity_kwh',
                                   'nonthermal_electricity_kwh', 'heating_tons', 'cooling_tons', 'tons'])}
FROM pb WHERE btype = '{_d0.building_type}' AND appl_bool AND in__hvac_has_ducts = '{_d0.ducts_required}'
"""

ELIGIBLE_POOL = f"WITH {META_CTE}, {SAMPLE_CTE} SELECT {_POOL_SELECT} FROM pool"
SCENARIO_SAMPLE = f"WITH {META_CTE}, {SAMPLE_CTE} SELECT {_POOL_SELECT} FROM sample"


def _strict_avg(expr: str) -> str:
    return f"CASE WHEN bool_and(({expr}) IS NOT NULL) THEN avg({expr}) END"


_PARTIAL_NUM = "CAST(nullif(regexp_extract(partial_text, '\\d+'), '') AS DOUBLE) / 100"
SAMPLE_SUMMARY = f"""
WITH {META_CTE}, {SAMPLE_CTE}
SELECT scenario, count(*) AS count,
  round((avg(size_heat / 12)), {D}) AS base_tons_heating,
  round((avg(size_cool / 12)), {D}) AS base_tons_cooling,
  round((avg(upgrade_tons_heating)), {D}) AS upgrade_tons_heating,
  round(({_strict_avg('CAST(in__sqft AS DOUBLE)')}), {D}) AS sqft,
  round(({_strict_avg('in__sqft * (' + _PARTIAL_NUM + ')')}), {D}) AS cooling_space_conditioned_sqft,
  round(({_strict_avg('gas_kwh / 1000')}), {D}) AS gas_heating,
  round(({_strict_avg('propane_kwh / 1000')}), {D}) AS propane_heating,
  round(({_strict_avg('fuel_oil_kwh / 1000')}), {D}) AS fuel_oil_heating,
  round(({_strict_avg('load_heat_kbtu * 0.000293071')}), {D}) AS out__load__heating__energy_delivered__mwh,
  round(({_strict_avg('load_cool_kbtu * 0.000293071')}), {D}) AS out__load__cooling__energy_delivered__mwh
FROM sample GROUP BY scenario
"""


def _requested_arm(arm: int) -> str:
    return f"""
SELECT s.scenario, CAST({arm} AS BIGINT) AS upgrade, count(DISTINCT s.bldg_id) AS n_requested,
  count(l.bldg_id) AS n_loaded, count(*) - count(l.bldg_id) AS n_failed
FROM sample s LEFT JOIN (SELECT DISTINCT user_id AS bldg_id FROM events WHERE event_id % 2 = {arm}) l
  ON s.bldg_id = l.bldg_id
GROUP BY s.scenario"""


REQUESTED_VS_LOADED = f"""
WITH {META_CTE}, {SAMPLE_CTE}
{_requested_arm(0)}
UNION ALL
{_requested_arm(1)}
"""

_LABEL_ROWS = ", ".join(f"('{a}', '{b}')" for a, b in REFERENCE_SCENARIO_LABELS)
SCENARIO_REPORT = f"""
WITH {READINGS_CTE}, {META_CTE}, {SAMPLE_CTE},
sn AS (SELECT scenario AS scenario_name, CAST(count(*) AS DOUBLE) AS n FROM sample GROUP BY scenario),
rs AS (SELECT s.scenario AS scenario_name, r.* FROM rh r JOIN sample s ON r.bldg_id = s.bldg_id),
arm AS (
  SELECT rs.scenario_name, upgrade, hour_utc,
    sum(coalesce(heat, 0)) / 1000 / sn.n AS heat, sum(coalesce(cool, 0)) / 1000 / sn.n AS cool,
    coalesce(sum(gas_heat), 0) / 1000 / sn.n AS gas, coalesce(sum(load_heat), 0) AS lh, coalesce(sum(load_cool), 0) AS lc
  FROM rs JOIN sn ON rs.scenario_name = sn.scenario_name
  GROUP BY rs.scenario_name, upgrade, hour_utc, sn.n
),
kk AS (
  SELECT b.scenario_name, b.heat AS heat_b, b.cool AS cool_b, b.gas AS gas_b, u.heat AS heat_u, u.cool AS cool_u,
    u.gas AS gas_u,
    CASE WHEN b.lh = 0 THEN 0 ELSE u.lh / b.lh END AS hr, CASE WHEN b.lc = 0 THEN 0 ELSE u.lc / b.lc END AS cr
  FROM (SELECT * FROM arm WHERE upgrade = 0) b
  LEFT JOIN (SELECT * FROM arm WHERE upgrade = 1) u ON b.scenario_name = u.scenario_name AND b.hour_utc = u.hour_utc
),
t AS (
  SELECT sc.scenario AS scenario_name,
    coalesce(sum(heat_b), 0) AS eh_b, coalesce(sum(cool_b), 0) AS ec_b, coalesce(sum(gas_b), 0) AS gh_b,
    coalesce(sum(heat_b * hr), 0) AS eh_s, coalesce(sum(cool_b * cr), 0) AS ec_s, coalesce(sum(gas_b * hr), 0) AS gh_s,
    coalesce(sum(heat_u), 0) AS eh_u, coalesce(sum(cool_u), 0) AS ec_u, coalesce(sum(gas_u), 0) AS gh_u
  FROM scen sc LEFT JOIN kk ON kk.scenario_name = sc.scenario GROUP BY sc.scenario
),
lab(scenario_name, label) AS (VALUES {_LABEL_ROWS})
SELECT t.scenario_name, lab.label, x.scenario, round((x.eh), {D}) AS elec_heating_mwh, round((x.ec), {D}) AS elec_cooling_mwh,
  round((x.gh), {D}) AS gas_heating_mwh
FROM t
JOIN (SELECT scenario_name, 'Baseline' AS scenario, eh_b AS eh, ec_b AS ec, gh_b AS gh FROM t
      UNION ALL SELECT scenario_name, 'Baseline (Scaled Up)', eh_s, ec_s, gh_s FROM t
      UNION ALL SELECT scenario_name, 'Upgrade', eh_u, ec_u, gh_u FROM t) x ON x.scenario_name = t.scenario_name
LEFT JOIN lab ON lab.scenario_name = t.scenario_name
"""

# ---- scalar functions -------------------------------------------------------------------------


def _num(expr: str) -> str:
    return f"round((CAST(nullif(regexp_extract({expr}, '\\d+'), '') AS DOUBLE) / 100), {D})"


LARGE_SAMPLE = f"""
SELECT scenario, bldg_id FROM (
  SELECT s AS scenario, c_custkey AS bldg_id, row_number() OVER (PARTITION BY s
    ORDER BY md5(CAST(sd AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR)), c_custkey) AS rk, k
  FROM customer, (VALUES {', '.join(f"('{n}', {k}, {sd})" for n, k, sd in V.LARGE_SAMPLES)}) AS t(s, k, sd))
WHERE rk <= k
"""

_TEXT_TIME = ("CASE WHEN CAST(time_hr AS DATE) = time_hr THEN strftime(time_hr, '%Y-%m-%d') "
              "ELSE strftime(time_hr, '%Y-%m-%d %H:%M:%S') END")
REPORT_TEXT = f"""
WITH {READINGS_CTE}, {_compare_cte()}
SELECT row_number() OVER (ORDER BY hour_utc) AS row_number, {_TEXT_TIME} AS time_hr, interval_count_base,
  {rnd('total_electricity_mwh_base', 'total_electricity_mwh_base')}, {rnd('total_mwh_scaled', 'total_mwh_scaled')}
FROM k
"""

ANNUAL_ORDER = """
SELECT CAST(1 AS BIGINT) AS row_number, 'Baseline' AS scenario
UNION ALL SELECT 2, 'Baseline (Scaled Up)' UNION ALL SELECT 3, 'Upgrade'
"""

REGEX_NUMBER = f"""
SELECT 'events.props' AS source, event_id AS id, {_num('props')} AS number FROM events
UNION ALL SELECT 'part.p_name', p_partkey, {_num('p_name')} FROM part
UNION ALL SELECT 'part.p_brand', p_partkey, {_num('p_brand')} FROM part
"""

_TRUTHY = "('true', 't', '1', 'yes', 'y')"
BOOL_COERCION = f"""
SELECT doc_id, quality <> 0 AS quality_flag,
  coalesce(lower(CAST(toxic AS VARCHAR)) IN {_TRUTHY}, false) AS toxic_text_flag,
  coalesce(lower(CASE WHEN quality = 1 THEN 'Yes' WHEN toxic = 1 THEN 'T' ELSE 'no' END) IN {_TRUTHY}, false)
    AS label_text_flag,
  quality > toxic AS logical_flag,
  coalesce((CASE WHEN toxic = 0 THEN quality END) IN (1), false) AS quality_in_set
FROM labels
"""

PRICES_CTE = f"""
em AS (SELECT o_custkey AS e_id, max(o_totalprice) AS early_max FROM orders
       WHERE o_orderdate < TIMESTAMP '{V.EARLY_BEFORE}' GROUP BY o_custkey),
lm AS (SELECT o_custkey AS l_id, max(o_totalprice) AS late_max FROM orders
       WHERE o_orderdate >= TIMESTAMP '{V.LATE_FROM}' GROUP BY o_custkey),
cp AS (SELECT c.*, em.early_max, lm.late_max FROM customer c LEFT JOIN em ON c.c_custkey = em.e_id
       LEFT JOIN lm ON c.c_custkey = lm.l_id)"""

STRICT_MEAN = f"""
WITH {PRICES_CTE}
SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, count(*) AS n,
  round(({_strict_avg('late_max')}), {D}) AS mean_strict, round((avg(late_max)), {D}) AS mean_skipna
FROM cp GROUP BY c_nationkey, c_mktsegment
"""

STRICT_PMAX = f"""
WITH {PRICES_CTE}
SELECT c_custkey, round((early_max), {D}) AS early_max, round((late_max), {D}) AS late_max,
  round((CASE WHEN early_max IS NULL OR late_max IS NULL THEN NULL
             WHEN early_max >= late_max THEN early_max ELSE late_max END), {D}) AS pmax_strict,
  round((CASE WHEN early_max IS NULL THEN late_max WHEN late_max IS NULL THEN early_max
             WHEN early_max >= late_max THEN early_max ELSE late_max END), {D}) AS greatest_skipna
FROM cp
"""

ROW_SUM_SKIPNA = f"""
WITH {PRICES_CTE}
SELECT c_custkey,
  round((coalesce(early_max, 0) + coalesce(late_max, 0) + coalesce(c_acctbal, 0)), {D}) AS row_sum,
  round((early_max + late_max + c_acctbal), {D}) AS plain_sum,
  CAST(0 AS DOUBLE) AS empty_sum
FROM cp
"""

UNION_BY_NAME = f"""
SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nationkey,
  round((c_acctbal), {D}) AS acctbal, c_mktsegment AS mktsegment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, CAST(s_nationkey AS BIGINT), round((s_acctbal), {D}), NULL FROM supplier
"""

DYNAMIC_MEASURES = f"""
SELECT l_returnflag, l_linestatus,
  round((coalesce(sum(l_quantity / 1000), 0)), {D}) AS sum_l_quantity_k,
  round((coalesce(sum(l_extendedprice / 1000), 0)), {D}) AS sum_l_extendedprice_k,
  round((coalesce(sum(l_tax), 0)), {D}) AS sum_l_tax,
  round((coalesce(sum(coalesce(l_quantity / 1000, 0) + coalesce(l_extendedprice / 1000, 0)), 0)), {D}) AS sum_all_k,
  count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""

CSV_ROUNDTRIP = f"""
SELECT c_custkey, c_name, CASE WHEN r_name <> 'AFRICA' THEN r_name END AS r_name,
  round((c_acctbal * CAST(1.5 AS DOUBLE)), {D}) AS score, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
"""

# the readings that are written as source files, per building and arm
SERIES_SOURCE_LAYOUT = f"""
WITH {READINGS_CTE}
SELECT bldg_id, CAST(upgrade AS BIGINT) AS upgrade, count(*) AS n_readings,
  count(net) AS n_net, {rnd('sum(net)', 'sum_net')}, {rnd('sum(gas_heat)', 'sum_gas_heat')}
FROM readings GROUP BY bldg_id, upgrade
"""

# two of three buildings have whole numbers and no gas heating
SERIES_MIXED_TYPES = f"""
WITH {READINGS_CTE},
written AS (
  SELECT bldg_id, upgrade, CASE WHEN bldg_id % 3 = 1 THEN net ELSE floor(net) END AS net,
    CASE WHEN bldg_id % 3 = 1 THEN gas_heat END AS gas_heat
  FROM readings)
SELECT bldg_id, CAST(upgrade AS BIGINT) AS upgrade, count(*) AS n_readings, count(net) AS n_net,
  {rnd('sum(net)', 'sum_net')}, {rnd('sum(gas_heat)', 'sum_gas_heat')}, 'double' AS net_type
FROM written GROUP BY bldg_id, upgrade
"""

SERIES_OF_ID_TABLE = f"""
WITH {READINGS_CTE}
SELECT bldg_id, CAST(upgrade AS BIGINT) AS upgrade, count(*) AS n_readings,
  count(net) AS n_net, {rnd('sum(net)', 'sum_net')}, {rnd('sum(gas_heat)', 'sum_gas_heat')}
FROM readings WHERE bldg_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
GROUP BY bldg_id, upgrade
"""

DAMAGED_FILES = f"""
WITH {READINGS_CTE},
files AS (SELECT bldg_id, upgrade, count(*) AS n FROM readings GROUP BY bldg_id, upgrade),
causes AS (
  SELECT *, CASE
    WHEN upgrade = 0 AND bldg_id = (SELECT min(bldg_id) FROM readings WHERE upgrade = 0) THEN 'footer unreadable'
    WHEN upgrade = 1 AND bldg_id = (SELECT max(bldg_id) FROM readings WHERE upgrade = 1) THEN 'data unreadable' END AS cause
  FROM files)
SELECT bldg_id, CAST(upgrade AS BIGINT) AS upgrade, CASE WHEN cause IS NULL THEN n END AS n_loaded, cause FROM causes
"""

CSV_BAD_RECORDS = f"""
WITH lines AS (
  SELECT *, c_custkey % {V.BAD_LINE_EVERY} AS fault, concat_ws(',', c_custkey, c_mktsegment) AS head FROM customer)
SELECT c_custkey, c_mktsegment, CASE WHEN fault NOT IN (0, 1) THEN CAST(c_nationkey AS BIGINT) END AS c_nationkey,
  CASE fault WHEN 0 THEN head || ',oops' WHEN 1 THEN head WHEN 2 THEN concat_ws(',', head, c_nationkey, 'more') END AS bad_line
FROM lines
"""

INPUT_GUARDS = """
SELECT 'events' AS input, true AS present, count(*) AS n_rows FROM events
UNION ALL SELECT 'customer', true, count(*) FROM customer
UNION ALL SELECT 'orders', true, count(*) FROM orders
UNION ALL SELECT 'nation', true, count(*) FROM nation
UNION ALL SELECT 'region', true, count(*) FROM region
UNION ALL SELECT 'upgrade_metadata', false, NULL
"""

ORACLE: dict[str, str] = {
    "hourly_portfolio": HOURLY_PORTFOLIO,
    "hourly_portfolio_stream": HOURLY_PORTFOLIO,
    "compare_arms": COMPARE_ARMS,
    "compare_arms_onepass": COMPARE_ARMS,
    "hourly_by_building": _hourly_by_building("baseline", 0),
    "hourly_by_building_upgrade": _hourly_by_building("upgrade", 1),
    "portfolio_from_cube": HOURLY_PORTFOLIO,
    "building_hours_from_cube": _hourly_by_building("baseline", 0),
    "building_hour_compare": BUILDING_HOUR_COMPARE,
    "building_hour_compare_join": BUILDING_HOUR_COMPARE,
    "building_attributes": BUILDING_ATTRIBUTES,
    "peak_hour_slice": PEAK_HOUR_SLICE,
    "annual_energy": ANNUAL_ENERGY,
    "peak_day_profile": _peak_day(V.DRIVER_PEAK_DAY, "cooling"),
    "peak_day_profile_heating": _peak_day(V.DRIVER_WINTER_PEAK_HOUR[:10], "heating"),
    "profile_long": PROFILE_LONG,
    "local_hour_dst": LOCAL_HOUR_DST,
    "distinct_ids": DISTINCT_IDS,
    "prep_baseline": PREP_BASELINE,
    "eligible_pool": ELIGIBLE_POOL,
    "scenario_sample": SCENARIO_SAMPLE,
    "sample_summary": SAMPLE_SUMMARY,
    "requested_vs_loaded": REQUESTED_VS_LOADED,
    "scenario_report": SCENARIO_REPORT,
    "job_end_to_end": SCENARIO_REPORT,
    "regex_number": REGEX_NUMBER,
    "bool_coercion": BOOL_COERCION,
    "strict_mean": STRICT_MEAN,
    "strict_pmax": STRICT_PMAX,
    "row_sum_skipna": ROW_SUM_SKIPNA,
    "union_by_name": UNION_BY_NAME,
    "dynamic_measures": DYNAMIC_MEASURES,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "large_sample": LARGE_SAMPLE,
    "report_text_8760": REPORT_TEXT,
    "annual_energy_order": ANNUAL_ORDER,
    "hourly_portfolio_dst": shifted(HOURLY_PORTFOLIO),
    "hourly_by_building_dst": shifted(_hourly_by_building("baseline", 0)),
    "building_hour_compare_dst": shifted(BUILDING_HOUR_COMPARE),
    "series_source_layout": SERIES_SOURCE_LAYOUT,
    "series_mixed_types": SERIES_MIXED_TYPES,
    "series_of_id_table": SERIES_OF_ID_TABLE,
    "damaged_files": DAMAGED_FILES,
    "bucketed_arm_join": BUILDING_HOUR_COMPARE,
    "csv_bad_records": CSV_BAD_RECORDS,
    "input_guards": INPUT_GUARDS,
}
