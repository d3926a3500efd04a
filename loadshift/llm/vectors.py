"""Integer vectors for the operators over embeddings.

A component x becomes floor(scale * x) as a long (held at a long's limits). Vectors of
different lengths are compared as if the shorter ones ended in zeros; an empty vector is all
zeros. Rows whose vector is null, or holds a null or non-finite component, are left out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

# Integers up to here are exact as doubles.
EXACT = 1 << 53


def usable(vector: Column) -> Column:
    """True where the vector and all its components are present and finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """The integer components."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def width_and_peak(table: DataFrame, column: str = "q") -> tuple[int, int]:
    """The largest length and the largest absolute component of a written table."""
    top = lambda v: F.greatest(F.array_max(v), F.negative(F.greatest(F.array_min(v), F.lit(-(2**63) + 1))))
    row = table.agg(F.max(F.size(column)), F.max(top(F.col(column)))).first()
    return int(row[0] or 0), int(row[1] or 0)


def single(table: DataFrame, name: str) -> DataFrame:
    """``table`` (written; vec_id, label, q) with one row per vec_id: repeated rows count once,
    and of several texts of one id the smallest (label, vector) stays. Only repeated ids are
    regrouped; rows without an id are left out."""
    table = table.where("vec_id IS NOT NULL")
    again = C.materialise(table.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), f"{name}_again")
    if not again.limit(1).count():
        return table
    once = table.join(again, "vec_id", "left_anti")
    least = (table.join(again, "vec_id", "left_semi").groupBy("vec_id")
             .agg(F.min(F.struct("label", "q")).alias("least")).select("vec_id", "least.label", "least.q"))
    return C.materialise(once.unionByName(least), f"{name}_single")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of longs as rows of ``width`` components, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out
