"""Helpers shared by the training-data operators.

* :func:`materialise` cuts lineage with a table in the shared checkpoint folder.
* :func:`small_side` broadcasts a materialised table only when its counted rows are
  below a bound; :func:`salted_join` spreads hot keys when it is not.
* :func:`find_spans` is a native "all matches with positions": every match is marked
  with a control character, and positions are running sums of the piece lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Control characters used as marks; they are in no pattern's character class.
MARK, MARK_STAND_IN = "\u0001", "\u0002"
# Even number of pieces per block, so that odd positions stay matches in every block.
BLOCK_PIECES = 512
SPAN_TYPE = "array<struct<start:bigint,end:bigint,value:string>>"
# Largest number of rows of a table that is broadcast; beyond it the join is salted.
BROADCAST_ROWS = 100_000
SALTS = 16
# Bytes of a batch of rows that is sent to a Python worker.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (lineage cut)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Rows that go to Python travel in batches of at most ``size`` bytes (or one row), whatever
    the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def map_rows(df: DataFrame, carried: list[str], given: list[str], columns: str, rows: Callable) -> DataFrame:
    """``carried`` columns of ``df`` untouched (they stay Arrow columns, so a null beside a large
    id changes neither) and new ``columns`` (DDL). ``rows()`` is called once in a task and returns
    a function of the lists of the ``given`` columns of a batch, whose result is a list of
    rows of the new columns, one for each row of the batch."""
    bound_batches(df.sparkSession)
    made = T._parse_datatype_string(columns)
    kinds = [to_arrow_type(f.dataType) for f in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = rows()
        for b in batches:
            found = work(*[b.column(f"given{i}").to_pylist() for i in range(len(given))])
            new = [pa.array([r[i] for r in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[b.column(f"carried{i}") for i in range(len(carried))], *new],
                                             [*[f"carried{i}" for i in range(len(carried))], *made.names])

    inputs = df.select(*[F.col(f"`{c}`").alias(f"carried{i}") for i, c in enumerate(carried)],
                       *[F.col(f"`{c}`").alias(f"given{i}") for i, c in enumerate(given)])
    kept = T.StructType([f for f in inputs.schema if f.name.startswith("carried")])
    out = inputs.mapInArrow(run, T.StructType([*kept, *made]))
    return out.select(*[F.col(f"carried{i}").alias(c) for i, c in enumerate(carried)], *made.names)


def small_side(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame | None:
    """``df`` (a materialised table) marked for broadcast when it has at most ``bound``
    rows, else None: the caller then takes a shuffled join."""
    return F.broadcast(df) if df.count() <= bound else None


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """Equi-join in which a hot key of ``left`` is dealt to ``salts`` tasks: ``spread`` picks
    the salt of a left row, and every right row is repeated once per salt. ``right`` must be
    distinct on ``keys`` (its copies are bounded by ``salts``)."""
    many = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    few = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return many.join(few, [*keys, "_salt"], how).drop("_salt")


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str = "inner") -> DataFrame:
    """Join a large ``left`` to a materialised ``right`` (distinct on ``keys``): broadcast
    when the counted rows allow it, else salted."""
    small = small_side(right)
    return left.join(small, keys, how) if small is not None else salted_join(left, right, keys, spread, how)


def by_document(docs: DataFrame, hits: DataFrame, id_col: str, text_col: str, how: str = "left") -> DataFrame:
    """Documents (whole, as the struct ``row``, so that no column name can clash) joined to a
    materialised table keyed by ``_id`` and ``_hash`` (of the text), distinct on them."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("_own_id"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_own_hash"))
    small = small_side(hits)
    return keyed.join(small if small is not None else hits,
                      F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_hash") == F.col("_hash")), how)


def unpack(joined: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row``, some of them changed."""
    return joined.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row. Higher-order functions would
    otherwise evaluate an outer expression again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _block_spans(pieces: Column, start: Column) -> Column:
    zero = F.struct(start.alias("pos"), F.lit(False).alias("hit"), F.array().cast(SPAN_TYPE).alias("spans"))

    def step(acc, piece):
        end = acc["pos"] + F.length(piece)
        span = F.struct(acc["pos"].alias("start"), end.alias("end"), piece.alias("value"))
        return F.struct(end.alias("pos"), (~acc["hit"]).alias("hit"),
                        F.when(acc["hit"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(pieces, zero, step, lambda acc: acc["spans"])


def _blocks(pieces: Column) -> Column:
    last = ((F.size(pieces) - 1) / BLOCK_PIECES).cast("int")
    return F.transform(F.sequence(F.lit(0), last),
                       lambda b: F.slice(pieces, b * BLOCK_PIECES + 1, F.lit(BLOCK_PIECES)))


def _piece_spans(pieces: Column) -> Column:
    """Spans of the odd pieces. Works block by block, so a text with very many matches costs
    matches x block size, not matches squared."""
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    lengths = lambda blocks: F.transform(
        blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + F.length(x)))
    return let(_blocks(pieces), lambda blocks: let(lengths(blocks), lambda sums: F.flatten(
        F.transform(blocks, lambda b, i: _block_spans(b, total(F.slice(sums, F.lit(1), i)))))))


def _marked(text: Column, pattern: str) -> Column:
    """The text cut into pieces; the matches are the odd ones."""
    marked = F.regexp_replace(F.translate(text, MARK, MARK_STAND_IN), F.lit(pattern), F.lit(f"{MARK}$0{MARK}"))
    return F.split(marked, MARK, -1)


def find_spans(text: Column, pattern: str, only_if: Column) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as an array of (start, end, value),
    code-point offsets, end exclusive. ``only_if`` is a cheap necessary condition; where it
    does not hold (or the text is null) the result is the empty array."""
    spans = let(_marked(text, pattern), _piece_spans)
    return F.when(F.coalesce(only_if, F.lit(False)), spans).otherwise(F.array().cast(SPAN_TYPE))


def mask_spans(text: Column, spans: Column) -> Column:
    """``text`` with every span (start, end, mask; by start) replaced by its mask; a span that
    begins inside the one before is cut there."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        start, end = F.greatest(s["start"], acc["at"]), F.greatest(s["end"], acc["at"])
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (start - acc["at"]).cast("int"))
        return F.struct(end.alias("at"), F.concat(acc["out"], gap, F.when(end > start, s["mask"])
                                                  .otherwise(F.lit(""))).alias("out"))

    return F.aggregate(spans, zero, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def with_kind(spans: Column, kind: str, order: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(order).alias("kind_order"),
        F.lit(kind).alias("kind"), s["value"].alias("value")))


def span_digest_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined, in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
