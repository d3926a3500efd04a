"""

Source columns are named like ``out.electricity.heating.energy_consumption``.
Dots are replaced by a double underscore when a table enters Spark
(:func:`sanitize_columns`) and put back when it leaves through a sink
(:func:`restore_columns`). Selectors match on the *restored* (dotted) name so
the patterns read exactly like the source naming. Everything here works on the
schema only; no data is scanned.
"""

from __future__ import annotations

import re
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEP = "__"

# Fixed values that must equal the reference's for right results: the two
# thermal selectors. "strict" (portfolio roll-up, metadata sums) needs a dot
# right after the end use; "broad" (per-building roll-up) is a prefix+suffix
# test and also takes e.g. cooling_fans_pumps.
STRICT_SERIES = r"^out\.electricity\.{end_use}\..*energy_consumption$"
STRICT_METADATA = r"^out\.electricity\.{end_use}\..*energy_consumption\.kwh$"
BROAD_PREFIX = "out.electricity.{end_use}"
BROAD_SUFFIX = "energy_consumption"


def sanitize(name: str) -> str:
    return name.replace(".", SEP)


def restore(name: str) -> str:
    return name.replace(SEP, ".")


def sanitize_columns(df: DataFrame) -> DataFrame:
    ren = {c: sanitize(c) for c in df.columns if "." in c}
    return df.withColumnsRenamed(ren) if ren else df


def restore_columns(df: DataFrame) -> DataFrame:
    ren = {c: restore(c) for c in df.columns if SEP in c}
    return df.withColumnsRenamed(ren) if ren else df


def cols_regex(columns: Iterable[str], pattern: str) -> list[str]:
    """Names whose dotted form matches ``pattern`` (regex search, order kept)."""
    rx = re.compile(pattern)
    return [c for c in columns if rx.search(restore(c))]


def cols_prefix_suffix(columns: Iterable[str], prefix: str, suffix: str) -> list[str]:
    """P10: names whose dotted form starts with ``prefix`` and ends with ``suffix``."""
    return [c for c in columns if restore(c).startswith(prefix) and restore(c).endswith(suffix)]


def strict_thermal(columns: Iterable[str], end_use: str, pattern: str = STRICT_SERIES) -> list[str]:
    return cols_regex(columns, pattern.format(end_use=re.escape(end_use)))


def broad_thermal(columns: Iterable[str], end_use: str) -> list[str]:
    return cols_prefix_suffix(columns, BROAD_PREFIX.format(end_use=end_use), BROAD_SUFFIX)


def apply_to_columns(df: DataFrame, names: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Replace every listed column by ``fn(column)`` in one projection."""
    names = set(names)
    return df.select(*[fn(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])


def col(name: str) -> Column:
    """A column reference that is safe for names with dots."""
    return F.col(f"`{name}`") if "." in name else F.col(name)
