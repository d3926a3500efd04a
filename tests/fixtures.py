"""Hand-made fixtures with the reference's schemas (FIXTURES.md F1, F2).

Buildings 1..12 in the baseline metadata; the series dataset holds buildings
1, 2 and 3 (and a corrupt file for 4) for arms 0 and 5, over four whole days:
2018-01-07 (winter peak), 2018-03-11 (spring forward), 2018-07-02 (summer peak),
2018-11-04 (fall back). Building 5 is sampled but has no files (failed read).
"""

from __future__ import annotations

import csv
import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq

META_COLUMNS = [
    "bldg_id", "applicability", "in.geometry_building_type_acs", "in.hvac_has_ducts", "in.vacancy_status",
    "in.hvac_cooling_type", "in.sqft", "in.vintage", "in.hvac_heating_efficiency", "in.hvac_cooling_efficiency",
    "in.heating_fuel", "in.ground_thermal_conductivity", "in.hvac_cooling_partial_space_conditioning",
    "out.params.size_heating_system_primary_k_btu_h", "out.params.size_cooling_system_primary_k_btu_h",
    "out.unmet_hours.cooling.hour", "out.unmet_hours.heating.hour",
    "out.electricity.total.energy_consumption.kwh", "out.electricity.heating.energy_consumption.kwh",
    "out.electricity.heating_hp_bkup.energy_consumption.kwh", "out.electricity.cooling.energy_consumption.kwh",
    "out.natural_gas.heating.energy_consumption.kwh", "out.propane.heating.energy_consumption.kwh",
    "out.fuel_oil.heating.energy_consumption.kwh", "out.load.heating.energy_delivered.kbtu",
    "out.load.cooling.energy_delivered.kbtu",
]

SFD = "Single-Family Detached"
EF = "Electric Furnace, 100% AFUE"
GF = "Fuel Furnace, 80% AFUE"


def _b(i, appl="TRUE", btype=SFD, ducts="Yes", vac="Occupied", cool="Central AC", sqft=2179, vint="1980s",
       eff=EF, fuel="Electricity", partial="100% Conditioned", size_h=48.0, size_c=24.0):
    return [i, appl, btype, ducts, vac, cool, sqft, vint, eff, "AC, SEER 13", fuel, 1.1, partial, size_h, size_c,
            3.5, 6.0, 12000.0 + i, 3000.0, 500.0, 1500.0, 0.0 if fuel != "Natural Gas" else 9000.0,
            0.0, 0.0, 40000.0, 20000.0]


BASELINE_ROWS = [
    _b(1),
    _b(2, appl="yes", partial="80% Conditioned", size_h=60.0),
    _b(3, appl="1", sqft=1698, vint="1970s", partial="<10% Conditioned", size_c=30.0),
    _b(4, appl="t", sqft=2678, vint="1990s", size_h=None),           # NULL heating size (pmax NULL)
    _b(5, appl="Y", partial="None"),                                  # sampled, no series files
    _b(6, appl="False"),                                              # not applicable
    _b(7, appl=None),                                                 # NA applicability -> FALSE
    _b(8, ducts="No"),                                                # no ducts
    _b(9, vac="Vacant"),
    _b(10, fuel="Natural Gas", eff=GF, partial=None),                 # gas scenario
    _b(11, btype="Mobile Home"),
    _b(12),                                                           # missing from upgrade file
    _b(13, fuel="Natural Gas", eff=GF, vint="1990s", sqft=1698),      # gas, 1990s
]

UPGRADE_COLUMNS = ["bldg_id", "applicability", "out.params.size_heating_system_primary_k_btu_h",
                   "out.params.size_cooling_system_primary_k_btu_h"]
UPGRADE_ROWS = [[i, "TRUE", 50.0 + i, 25.0 + i] for i in (*range(1, 12), 13)]

DAYS = [dt.date(2018, 1, 7), dt.date(2018, 3, 11), dt.date(2018, 7, 2), dt.date(2018, 11, 4)]

# constant per-reading values (kWh per quarter hour, kBtu)
VALUES = {
    "out.electricity.net.energy_consumption": 2.0,
    "out.electricity.heating.energy_consumption": 0.5,
    "out.electricity.heating_hp_bkup.energy_consumption": 0.25,
    "out.electricity.cooling.energy_consumption": 0.3,
    "out.electricity.cooling_fans_pumps.energy_consumption": 0.1,
    "out.natural_gas.total.energy_consumption": 1.0,
    "out.natural_gas.heating.energy_consumption": 0.6,
    "out.propane.heating.energy_consumption": 0.0,
    "out.fuel_oil.heating.energy_consumption": 0.2,
    "out.load.heating.energy_delivered.kbtu": 3.0,
    "out.load.cooling.energy_delivered.kbtu": 2.0,
}

NULL_HOUR = dt.datetime(2018, 7, 2, 11, 15)      # building 1, arm 0: readings 11:15..12:00 all NULL
ABSENT_UPG_HOUR = dt.datetime(2018, 7, 2, 13, 15)  # building 1, arm 5: readings 13:15..14:00 missing
ZERO_LOAD_HOUR = dt.datetime(2018, 1, 7, 3, 15)    # building 2, arm 0: delivered loads 0


def quarter_hours():
    for d in DAYS:
        start = dt.datetime.combine(d, dt.time()) + dt.timedelta(minutes=15)
        for k in range(96):
            yield start + dt.timedelta(minutes=15 * k)


def _in_hour(ts, first):
    return first <= ts <= first + dt.timedelta(minutes=45)


def series_table(bldg: int, upgrade: int, drop_column: str | None = None) -> pa.Table:
    ts = list(quarter_hours())
    if bldg == 1 and upgrade == 5:
        ts = [t for t in ts if not _in_hour(t, ABSENT_UPG_HOUR)]
    cols = {"timestamp": pa.array(ts, pa.timestamp("us"))}
    scale = 0.5 if upgrade == 5 else 1.0
    for name, v in VALUES.items():
        if name == drop_column:
            continue
        vals = []
        for t in ts:
            x = v * scale * bldg
            if bldg == 1 and upgrade == 0 and _in_hour(t, NULL_HOUR):
                x = None
            if bldg == 2 and upgrade == 0 and _in_hour(t, ZERO_LOAD_HOUR) and ".load." in name:
                x = 0.0
            vals.append(x)
        cols[name] = pa.array(vals, pa.float64())
    return pa.table(cols)


def write_series(root: str) -> None:
    for up in (0, 5):
        d = os.path.join(root, f"upgrade={up}", "state=VA")
        os.makedirs(d, exist_ok=True)
        for b in (1, 2, 3):
            drop = "out.fuel_oil.heating.energy_consumption" if (b == 3 and up == 5) else None
            pq.write_table(series_table(b, up, drop), os.path.join(d, f"{b}-{up}.parquet"))
        with open(os.path.join(d, f"4-{up}.parquet"), "wb") as f:   # corrupt file
            f.write(b"this is not parquet")
    # another state: never read
    d = os.path.join(root, "upgrade=0", "state=MD")
    os.makedirs(d, exist_ok=True)
    pq.write_table(series_table(1, 0), os.path.join(d, "1-0.parquet"))


def _write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow(["NA" if v is None else v for v in r])


def write_all(root: str) -> None:
    _write_csv(os.path.join(root, "baseline.csv"), META_COLUMNS, BASELINE_ROWS)
    _write_csv(os.path.join(root, "upgrade.csv"), UPGRADE_COLUMNS, UPGRADE_ROWS)
    write_series(os.path.join(root, "series"))


META_SCHEMA = ", ".join(
    f"`{c}` " + ("int" if c in ("bldg_id", "in.sqft") else
                 "double" if (c.startswith("out.") or c == "in.ground_thermal_conductivity") else "string")
    for c in META_COLUMNS)
UPGRADE_SCHEMA = "bldg_id int, applicability string, `out.params.size_heating_system_primary_k_btu_h` double, " \
                 "`out.params.size_cooling_system_primary_k_btu_h` double"

SERIES_SCHEMA = ", ".join(["`timestamp` timestamp_ntz", *[f"`{c}` double" for c in VALUES], "upgrade int", "state string"])
