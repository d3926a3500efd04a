"""Column builders that reproduce the reference's missing-value and type rules.

Each builder returns a ``Column`` (JVM-side, codegen'd); none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for right results.
TRUTHY_TEXT = ["true", "t", "1", "yes", "y"]          # text accepted as TRUE by the bool coercion
KBTUH_PER_TON = 12.0                                   # kBtu/h per ton of capacity
KWH_PER_MWH = 1000.0
KW_PER_MW = 1000.0
MWH_PER_KBTU = 0.000293071
PERCENT = 100.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sum0(x) -> Column:
    """Sum skipping NULL, 0 when every value is NULL (or the group is all NULL)."""
    return F.coalesce(F.sum(_c(x)), F.lit(0.0))


def mean_strict(x) -> Column:
    """Mean without skipping -- NULL as soon as one input is NULL."""
    c = _c(x)
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def mean_skipna(x) -> Column:
    """Mean skipping NULL (NULL where the reference gives NaN)."""
    return F.avg(_c(x))


def pmax_strict(a, b) -> Column:
    """T4: pairwise max that is NULL when either side is NULL."""
    a, b = _c(a), _c(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def row_sum(cols: Iterable) -> Column:
    """T5: horizontal sum skipping NULL; 0 when there are no columns."""
    terms = [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols]
    if not terms:
        return F.lit(0.0)
    return reduce(lambda x, y: x + y, terms)


def safe_ratio(num, den) -> Column:
    """den == 0 -> 0; NULL den -> NULL; otherwise num / den (never raises)."""
    num, den = _c(num), _c(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num, den))


def extract_number(x, scale: float = PERCENT) -> Column:
    """First run of digits as a number divided by ``scale``; NULL when none."""
    digits = F.regexp_substr(_c(x), F.lit(r"\d+"))
    return digits.try_cast("double") / F.lit(scale)


def as_bool(x, dtype: T.DataType) -> Column:
    """bool coercion chosen by the input's type.

    boolean stays as is; numbers are ``!= 0`` (NULL stays NULL); anything else is
    compared as lower-case text with the truthy list and never yields NULL.
    """
    c = _c(x)
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, T.NumericType):
        return c != 0
    return F.coalesce(F.lower(c.cast("string")).isin(TRUTHY_TEXT), F.lit(False))


def in_set(x, values) -> Column:
    """Membership that is FALSE (not NULL) for a NULL input."""
    return F.coalesce(_c(x).isin(list(values)), F.lit(False))


# ---- unit conversions (F17) -------------------------------------------------

def kbtuh_to_tons(x) -> Column:
    return _c(x).cast("double") / F.lit(KBTUH_PER_TON)


def kwh_to_mwh(x) -> Column:
    return _c(x).cast("double") / F.lit(KWH_PER_MWH)


def mwh_to_kw(x) -> Column:
    return _c(x) * F.lit(KW_PER_MW)


def kbtu_to_mwh(x) -> Column:
    return _c(x) * F.lit(MWH_PER_KBTU)
