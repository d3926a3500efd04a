"""

* ``readings``: ``events`` as 15-minute series -- bldg_id = user_id, arm = event_id % 2
  (0 baseline, 1 upgrade: every event lands in exactly one arm), timestamp = ts, and
  each measure takes ``value`` for the event types listed below (NULL otherwise).
* ``baseline_metadata`` / ``upgrade_metadata``: ``customer`` joined with ``nation``,
  ``region`` and a per-customer summary of ``orders``; customers without orders are
  missing from the upgrade table.

All columns are built with DataFrame expressions over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Scenario, arm_labels

# Fixed values of the re-aim: event types feeding each series measure.
READING_MEASURES: dict[str, tuple[str, ...]] = {
    "out__electricity__net__energy_consumption": ("click", "view", "signup"),
    "out__electricity__heating__energy_consumption": ("click",),
    "out__electricity__heating_fans_pumps__energy_consumption": ("error",),
    "out__electricity__cooling__energy_consumption": ("view",),
    "out__electricity__cooling_fans_pumps__energy_consumption": ("signup",),
    "out__natural_gas__total__energy_consumption": ("purchase", "error"),
    "out__natural_gas__heating__energy_consumption": ("purchase",),
    "out__propane__heating__energy_consumption": ("error",),
    "out__load__heating__energy_delivered__kbtu": ("click", "purchase"),
    "out__load__cooling__energy_delivered__kbtu": ("view", "error"),
}
# sparse measure: large purchases only (leaves most hours all-NULL)
FUEL_OIL_MIN_VALUE = 300.0

DRIVER_BASELINE_ARM = 0
DRIVER_UPGRADE_ARM = 1
DRIVER_ARM_LABELS = arm_labels(DRIVER_BASELINE_ARM, DRIVER_UPGRADE_ARM)
# Peak constants for the driver data (events span 2024-01-01 .. 2024-01-30).
DRIVER_PEAK_DAY = "2024-01-15"
DRIVER_PEAK_HOUR = "2024-01-15 16:00:00"
DRIVER_WINTER_PEAK_HOUR = "2024-01-07 07:00:00"

# Scenarios over the re-aimed metadata (values that occur in the driver tables). Sample
# sizes lie below the pools at sf0.01, but for scenario2, whose pool is smaller.
DRIVER_SCENARIOS: tuple[Scenario, ...] = (
    Scenario("scenario1", building_type="AMERICA", sample_size=5, sqft_allowed=(1500, 2000, 2500),
             vintage_allowed=("MACHINERY", "FURNITURE", "BUILDING"),
             hvac_efficiency="Electric Furnace, 100% AFUE", heating_fuel="Electricity"),
    Scenario("scenario2", building_type="AMERICA", sqft_allowed=(1500, 2000, 2500),
             vintage_allowed=("MACHINERY", "FURNITURE", "BUILDING"),
             hvac_efficiency="Fuel Furnace, 80% AFUE", heating_fuel="Natural Gas"),
    Scenario("scenario3", building_type="AMERICA", sample_size=8, sqft_allowed=(1500, 2000, 2500),
             vintage_allowed=("MACHINERY", "BUILDING"),
             hvac_efficiency="Fuel Furnace, 80% AFUE", heating_fuel="Natural Gas"),
    Scenario("scenario4", building_type="AMERICA", sample_size=40),
    Scenario("scenario5", building_type="AMERICA", sample_size=10, sqft_allowed=(1000, 1500, 2000, 2500),
             vintage_allowed=("MACHINERY", "BUILDING", "AUTOMOBILE"),
             hvac_efficiency="Electric Furnace, 100% AFUE", heating_fuel="Electricity"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``nation`` (25 rows) or ``region`` (5 rows): fixed-size TPC-H dimension tables at
    every scale factor, so they are broadcast -- a shuffle join on 25 keys would put
    a hot nation's customers into one task."""
    return F.broadcast(table(spark, sf_dir, name))


def _value_if(types: tuple[str, ...]) -> Column:
    return F.when(F.col("event_type").isin(list(types)), F.col("value"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute style readings: bldg_id, upgrade, timestamp, measure columns."""
    return readings_from_events(table(spark, sf_dir, "events"))


def readings_from_events(ev: DataFrame) -> DataFrame:
    measures = {name: _value_if(types) for name, types in READING_MEASURES.items()}
    measures["out__fuel_oil__heating__energy_consumption"] = F.when(
        (F.col("event_type") == "purchase") & (F.col("value") > FUEL_OIL_MIN_VALUE), F.col("value"))
    return ev.select(
        F.col("user_id").alias("bldg_id"),
        (F.col("event_id") % 2).cast("int").alias("upgrade"),
        F.col("ts").alias("timestamp"),
        *[c.alias(n) for n, c in measures.items()],
    )


def requested_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buildings a series run is asked for: every building of the metadata, whether or
    not its readings load (T16)."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("bldg_id")).distinct()


# Types of the net electricity in the files of a folder with mixed types, by building id modulo their
# number; only the files with fractions hold the gas heating measure.
MIXED_TYPES = ("int", "double", "bigint")
# The buildings of an id table: customers of this segment.
SAMPLED_SEGMENT = "BUILDING"
# Of so many lines of a damaged CSV, three are bad (by customer key).
BAD_LINE_EVERY = 50
# Inputs of a run over the driver's tables; the last is not among them.
JOB_INPUTS = ("events", "customer", "orders", "nation", "region", "upgrade_metadata")
# Moves the January events over the clock change of November 3, 2024.
DRIVER_AUTUMN_SHIFT_DAYS = 300
# Samples of all buildings (name, size, seed): one above a thousand, one above the table
# at small scale factors.
LARGE_SAMPLES = (("large", 1200, 123), ("whole", 1_000_000_000, 7))
# Order-date cut-offs of the re-aim: early orders drive occupancy and the baseline
# heating size (NULL when a customer has none), late orders the upgrade table.
EARLY_BEFORE = "1996-01-01"
RECENT_FROM = "1998-01-01"
LATE_FROM = "2000-01-01"
UPGRADE_MIN_LATE_ORDERS = 3


def _orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    price = F.col("o_totalprice")
    early = d < F.lit(EARLY_BEFORE).cast("timestamp_ntz")
    late = d >= F.lit(LATE_FROM).cast("timestamp_ntz")
    recent = d >= F.lit(RECENT_FROM).cast("timestamp_ntz")
    return o.groupBy(F.col("o_custkey").alias("bldg_id")).agg(
        F.sum(price).alias("sum_price"),
        F.min(price).alias("min_price"),
        F.count(F.when(early, 1)).alias("n_early"),
        F.max(F.when(early, price)).alias("max_early"),
        F.count(F.when(late, 1)).alias("n_late"),
        F.max(F.when(late, price)).alias("max_late"),
        F.min(F.when(late, price)).alias("min_late"),
        F.min(F.when(recent, F.col("o_orderpriority"))).alias("top_recent"),
    )


def baseline_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per building with the columns the sampling and enrichment steps use."""
    c = table(spark, sf_dir, "customer")
    n = dimension(spark, sf_dir, "nation")
    r = dimension(spark, sf_dir, "region")
    o = _orders_by_customer(spark, sf_dir)
    bal = F.col("c_acctbal")
    nk = F.col("c_nationkey")
    fuel = (F.when(nk < 10, "Electricity").when(nk < 20, "Natural Gas")
            .when(nk < 23, "Propane").otherwise("Fuel Oil"))

    def by_fuel(name: str) -> Column:
        return F.when(fuel == name, F.col("sum_price") / 40.0).otherwise(F.lit(0.0))

    base = (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
             .join(r, n.n_regionkey == r.r_regionkey, "inner")
             .join(o, c.c_custkey == o.bldg_id, "left"))
    return base.select(
        F.col("c_custkey").alias("bldg_id"),
        F.when(bal >= -500, "True").otherwise("False").alias("applicability"),
        F.col("r_name").alias("in__geometry_building_type_acs"),
        F.when(bal >= 0, "Yes").otherwise("No").alias("in__hvac_has_ducts"),
        F.when(F.col("n_early") > 0, "Occupied").otherwise("Vacant").alias("in__vacancy_status"),
        F.when(F.col("top_recent").isin("1-URGENT", "2-HIGH"), "Central AC")
         .otherwise("Room AC").alias("in__hvac_cooling_type"),
        (F.lit(1000) + F.lit(500) * F.floor((bal + 1000.0) / 2200.0)).cast("int").alias("in__sqft"),
        F.col("c_mktsegment").alias("in__vintage"),
        F.when(nk < 10, "Electric Furnace, 100% AFUE").when(nk < 20, "Fuel Furnace, 80% AFUE")
         .otherwise("Fuel Boiler, 80% AFUE").alias("in__hvac_heating_efficiency"),
        fuel.alias("in__heating_fuel"),
        F.when(bal < 5000, "AC, SEER 13").otherwise("AC, SEER 15").alias("in__hvac_cooling_efficiency"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "100% Conditioned")
         .when(F.col("c_mktsegment") == "MACHINERY", "80% Conditioned")
         .when(F.col("c_mktsegment") == "FURNITURE", "60% Conditioned")
         .when(F.col("c_mktsegment") == "AUTOMOBILE", "<10% Conditioned")
         .otherwise("None").alias("in__hvac_cooling_partial_space_conditioning"),
        (F.lit(0.8) + F.lit(0.3) * F.col("n_regionkey")).alias("in__ground_thermal_conductivity"),
        (F.col("n_early").cast("double") / 2.0).alias("out__unmet_hours__cooling__hour"),
        (nk.cast("double") / 4.0).alias("out__unmet_hours__heating__hour"),
        (F.col("max_early") / 10000.0).alias("out__params__size_heating_system_primary_k_btu_h"),
        ((bal + 1000.0) / 400.0).alias("out__params__size_cooling_system_primary_k_btu_h"),
        (F.col("sum_price") / 100.0).alias("out__electricity__total__energy_consumption__kwh"),
        (F.col("max_early") / 50.0).alias("out__electricity__heating__energy_consumption__kwh"),
        (F.col("min_price") / 50.0).alias("out__electricity__heating_hp_bkup__energy_consumption__kwh"),
        (bal + 1000.0).alias("out__electricity__cooling__energy_consumption__kwh"),
        by_fuel("Natural Gas").alias("out__natural_gas__heating__energy_consumption__kwh"),
        by_fuel("Propane").alias("out__propane__heating__energy_consumption__kwh"),
        by_fuel("Fuel Oil").alias("out__fuel_oil__heating__energy_consumption__kwh"),
        (F.col("sum_price") / 20.0).alias("out__load__heating__energy_delivered__kbtu"),
        ((bal + 1000.0) * 3.0).alias("out__load__cooling__energy_delivered__kbtu"),
    )


def upgrade_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upgrade-arm metadata: only buildings with late orders appear."""
    o = _orders_by_customer(spark, sf_dir).where(F.col("n_late") > 0)
    return o.select(
        "bldg_id",
        (F.col("n_late") >= UPGRADE_MIN_LATE_ORDERS).alias("applicability"),
        (F.col("max_late") / 8000.0).alias("out__params__size_heating_system_primary_k_btu_h"),
        (F.col("min_late") / 8000.0).alias("out__params__size_cooling_system_primary_k_btu_h"),
    )
