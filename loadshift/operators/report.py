"""Reports over the hourly comparison."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S

# Fixed values that must equal the reference's for right results.
ANNUAL_SUMS = (  # output metric name, source column
    ("elec_heat_base", "all_heating_electricity_mwh_base"),
    ("elec_cool_base", "all_cooling_electricity_mwh_base"),
    ("gas_heat_base", "gas_heating_mwh_base"),
    ("elec_heat_scaled", "heating_mwh_scaled"),
    ("elec_cool_scaled", "cooling_mwh_scaled"),
    ("gas_heat_scaled", "gas_heating_mwh_scaled"),
    ("elec_heat_upg", "all_heating_electricity_mwh_upg"),
    ("elec_cool_upg", "all_cooling_electricity_mwh_upg"),
    ("gas_heat_upg", "gas_heating_mwh_upg"),
)
ARM_LABELS = {"base": "Baseline", "scaled": "Baseline (Scaled Up)", "upg": "Upgrade"}
END_USE_LABELS = {"elec_heat": "elec_heating_mwh", "elec_cool": "elec_cooling_mwh", "gas_heat": "gas_heating_mwh"}
ARM_ORDER = ["Baseline", "Baseline (Scaled Up)", "Upgrade"]
LAST_UNDERSCORE = r"_(?=[^_]+$)"

PROFILES = {
    "cooling": (("cooling_kw_base", "all_cooling_electricity_mwh_base"),
                ("cooling_kw_upg", "all_cooling_electricity_mwh_upg"),
                ("cooling_kw_scaled", "cooling_mwh_scaled")),
    "heating": (("heating_kw_base", "all_heating_electricity_mwh_base"),
                ("heating_kw_upg", "all_heating_electricity_mwh_upg"),
                ("heating_kw_scaled", "heating_mwh_scaled")),
}
PROFILE_SERIES = {  # chart series order and labels
    "cooling": (("cooling_kw_base", "cooling_kw_scaled", "cooling_kw_upg"),
                ("Baseline AC (Unscaled)", "Baseline AC (Scaled Up)", "GSHP Cooling")),
    "heating": (("heating_kw_base", "heating_kw_scaled", "heating_kw_upg"),
                ("Baseline AC (Unscaled)", "Baseline AC (Scaled Up)", "GSHP heating")),
}


def recode(c: Column, mapping: dict[str, str]) -> Column:
    """Map values; unmatched values are kept (a CASE chain: codegen-friendly)."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return c if out is None else out.otherwise(c)


def annual_energy(cmp: DataFrame, group_cols: Sequence[str] = (), groups: DataFrame | None = None) -> DataFrame:
    """Nine annual sums reshaped to one row per arm label with three end uses.

    agg -> unpivot (R1) -> split at the last underscore (R3) -> recode (R6) ->
    pivot with explicit values (R4, no extra job) -> custom order (O2).
    ``groups`` (the configured group keys) keeps groups without any hour, with
    zero sums, as the reference's summary of an empty table does.
    """
    sums = cmp.groupBy(*group_cols).agg(*[S.sum0(src).alias(name) for name, src in ANNUAL_SUMS])
    if groups is not None:
        # both sides hold one row per configured group
        sums = groups.select(*group_cols).join(sums, list(group_cols), "left") \
                     .fillna(0.0, subset=[n for n, _ in ANNUAL_SUMS])
    long = sums.unpivot(list(group_cols), [n for n, _ in ANNUAL_SUMS], "metric", "mwh")
    # split once into plain columns, then recode them (the split result reused inside
    # the CASE chains trips Spark's code generator)
    parts = F.split(F.col("metric"), LAST_UNDERSCORE)
    long = long.select(*group_cols, parts.getItem(0).alias("_end_use"), parts.getItem(1).alias("_arm"), "mwh")
    long = long.select(*group_cols,
                       recode(F.col("_end_use"), END_USE_LABELS).alias("fuel_enduse"),
                       recode(F.col("_arm"), ARM_LABELS).alias("scenario"),
                       "mwh")
    wide = long.groupBy(*group_cols, "scenario").pivot("fuel_enduse", list(END_USE_LABELS.values())) \
               .agg(F.first("mwh"))
    order = F.array_position(F.array(*[F.lit(x) for x in ARM_ORDER]), F.col("scenario"))
    if not group_cols:
        # three rows: one ordered partition, no range shuffle
        return wide.coalesce(1).sortWithinPartitions(order)
    # each group's three rows in one partition, in report order (groups are not ordered globally)
    return wide.repartition(*group_cols).sortWithinPartitions(*group_cols, order)


def peak_day_profile(cmp: DataFrame, day: str, kind: str = "cooling", group_cols: Sequence[str] = ()) -> DataFrame:
    """The 24 (25 at fall-back) hours of one local day, in kW per building."""
    day_col = F.to_date(F.col("time_hr"))
    out = cmp.where(day_col == F.lit(day).cast("date"))
    return out.select(*group_cols, "time_hr",
                      *[S.mwh_to_kw(F.col(src)).alias(name) for name, src in PROFILES[kind]])


def profile_long(profile: DataFrame, kind: str = "cooling", group_cols: Sequence[str] = ()) -> DataFrame:
    """Labelled long form behind the peak-day chart."""
    cols, labels = PROFILE_SERIES[kind]
    long = profile.unpivot([*group_cols, "time_hr"], list(cols), "series", "value")
    rank = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("series"))
    return long.select(*group_cols, "time_hr",
                       recode(F.col("series"), dict(zip(cols, labels))).alias("series"),
                       rank.cast("int").alias("series_rank"), "value")


def scenario_report(labels: DataFrame, results: DataFrame, key: str = "scenario_name") -> DataFrame:
    """Per-scenario results with their display label (broadcast: labels are config)."""
    lab = labels.withColumnRenamed("scenario", key)
    return results.join(F.broadcast(lab), key, "left")
