"""Job parameters and the scenario table."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class JobParams:
    """Global constants of a run (the reference keeps them in its config script)."""
    # Fixed values that must equal the reference's for right results (defaults).
    state: str = "VA"
    timezone: str = "America/New_York"
    upgrade_baseline: int = 0
    upgrade_gshp: int = 5
    summer_peak_day: str = "2018-07-02"
    summer_peak_hour: str = "2018-07-02 16:00:00"
    summer_peak_label: str = "July 2, 4PM"
    winter_peak_day: str = "2018-01-07"
    winter_peak_hour: str = "2018-01-07 07:00:00"
    winter_peak_label: str = "Jan 7, 7AM"

    def __post_init__(self):
        from .functions.timecols import check_whole_hour_zone
        check_whole_hour_zone(self.timezone)


@dataclass(frozen=True)
class Scenario:
    """One sampling scenario: defaults plus optional filters (None = no filter)."""
    scenario: str
    building_type: str = "Single-Family Detached"
    ducts_required: str = "Yes"
    vacancy_required: str = "Occupied"
    cooling_type_required: str = "Central AC"
    sample_size: int = 100
    seed: int = 123
    sqft_allowed: Sequence[int] | None = None
    vintage_allowed: Sequence[str] | None = None
    hvac_efficiency: str | None = None
    heating_fuel: str | None = None

    def __post_init__(self):
        if int(self.sample_size) < 1:
            raise ValueError(f"{self.scenario}: sample_size must be at least 1")


# Fixed values that must equal the reference's for right results: its five scenarios.
REFERENCE_SCENARIOS: tuple[Scenario, ...] = (
    Scenario("scenario1", sqft_allowed=(1698, 2179, 2678), vintage_allowed=("1990s", "1980s", "1970s"),
             hvac_efficiency="Electric Furnace, 100% AFUE", heating_fuel="Electricity"),
    Scenario("scenario2", sqft_allowed=(1698, 2179, 2678), vintage_allowed=("1990s", "1980s", "1970s"),
             hvac_efficiency="Fuel Furnace, 80% AFUE", heating_fuel="Natural Gas"),
    Scenario("scenario3", sqft_allowed=(1698, 2179, 2678), vintage_allowed=("1990s",),
             hvac_efficiency="Fuel Furnace, 80% AFUE", heating_fuel="Natural Gas"),
    Scenario("scenario4"),
    Scenario("scenario5", sqft_allowed=(1698, 2179, 2678), vintage_allowed=("1990s",),
             hvac_efficiency="Electric Furnace, 100% AFUE", heating_fuel="Electricity"),
)

# Fixed values that must equal the reference's for right results: report labels.
REFERENCE_SCENARIO_LABELS: tuple[tuple[str, str], ...] = (
    ("scenario1", "Electric Furnace + Central AC"),
    ("scenario2", "Gas Furnace + Central AC"),
    ("scenario3", "Gas Furnace + Central AC"),
    ("scenario4", "Any Furnace + Central AC"),
    ("scenario5", "Electric Furnace + Central AC"),
)

# Fixed values that must equal the reference's for right results: the arm labels
# of the hourly tables (``type``), baseline first.
ARM_TYPE_LABELS = ("Baseline", "Upgrade")


def arm_labels(baseline_arm: int, upgrade_arm: int) -> dict[int, str]:
    return {baseline_arm: ARM_TYPE_LABELS[0], upgrade_arm: ARM_TYPE_LABELS[1]}


SCENARIO_SCHEMA = T.StructType([
    T.StructField("scenario", T.StringType(), False),
    T.StructField("building_type", T.StringType(), True),
    T.StructField("ducts_required", T.StringType(), True),
    T.StructField("vacancy_required", T.StringType(), True),
    T.StructField("cooling_type_required", T.StringType(), True),
    T.StructField("sample_size", T.IntegerType(), False),
    T.StructField("seed", T.IntegerType(), False),
    T.StructField("sqft_allowed", T.ArrayType(T.IntegerType()), True),
    T.StructField("vintage_allowed", T.ArrayType(T.StringType()), True),
    T.StructField("hvac_efficiency", T.StringType(), True),
    T.StructField("heating_fuel", T.StringType(), True),
])


def load_scenarios(path: str) -> tuple[Scenario, ...]:
    """Scenarios from a JSON file: a list of objects with ``Scenario`` field names;
    omitted fields take the defaults (absent optional filters = no filter)."""
    import json
    from dataclasses import fields
    known = {f.name for f in fields(Scenario)}
    with open(path) as fh:
        items = json.load(fh)
    out = []
    for item in items:
        unknown = set(item) - known
        if unknown:
            raise ValueError(f"unknown scenario fields: {sorted(unknown)}")
        for k in ("sqft_allowed", "vintage_allowed"):
            if item.get(k) is not None:
                item[k] = tuple(item[k])
        out.append(Scenario(**item))
    return tuple(out)


def scenario_table(spark: SparkSession, scenarios: Sequence[Scenario] = REFERENCE_SCENARIOS) -> DataFrame:
    """The scenarios as a small DataFrame (one row each); absent filters are NULL."""
    rows = [(s.scenario, s.building_type, s.ducts_required, s.vacancy_required, s.cooling_type_required,
             int(s.sample_size), int(s.seed),
             list(s.sqft_allowed) if s.sqft_allowed is not None else None,
             list(s.vintage_allowed) if s.vintage_allowed is not None else None,
             s.hvac_efficiency, s.heating_fuel) for s in scenarios]
    return spark.createDataFrame(rows, SCENARIO_SCHEMA)


def scenario_labels(spark: SparkSession, labels=REFERENCE_SCENARIO_LABELS) -> DataFrame:
    """Scenario -> display label."""
    return spark.createDataFrame(list(labels), "scenario string, label string")


def total_sample_bound(scenarios: Sequence[Scenario]) -> int:
    """Upper bound on sampled (scenario, building) rows -- known from the config alone."""
    return sum(int(s.sample_size) for s in scenarios)
