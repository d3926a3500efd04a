"""Operator 13: SimHash near duplicates by multi-index hashing.

A document's fingerprint has a bit set where more than half of its 3-word shingles' hashes
(XXH64, seed 42, repeats included) have it set. Documents whose fingerprints differ in at
most two bits link; the result is the connected component of every document.

Method. Distinct fingerprints are cut into two segments of 32 bits. Of two linked ones either
the upper halves differ in at most one bit, or the lower halves are equal. So the tables of
both segments are probed with a small Hamming ball each: 33 values of the upper half, one of
the lower half. A pair that differs in one upper bit is met from the side where that bit is 0,
so only these flips are probed. Every match is verified by the complete distance.

Crowded buckets. A segment value with more than ``CROWD`` distinct fingerprints would make all
pairs of a bucket. Its members, and those one upper bit away from it, go another way: every
fingerprint is entered at the 65 points of its own ball of radius one. Two fingerprints meet
at a point exactly when they differ in at most two bits, at most 65 can meet there, and
each is linked with the smallest of them. The components are the same, the
work is linear, and nothing is capped.

Defined cases: a null, empty or wordless text has fingerprint zero and links like any other;
fewer than three words are one shingle. Rows without an id link with nothing and have no
component. An id on several rows is one document with the links of all its texts; each row
is returned. A text is read whole, ``SHINGLES`` hashes at a time. An empty table gives no
rows. Other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .components import components

WORDS, SEED = 3, 42
DISTANCE = 2
SEGMENT = 32                     # bits of a segment; two of them, searched with radius 1 and 0
CROWD = 64                       # distinct fingerprints of a segment value, beyond which points are used
SHINGLES = 1 << 16               # hashes held at a time


# ---- fingerprints --------------------------------------------------------------

def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint. A-Z are lower-cased and words split on bytes, whose white
    space is exactly the six separators."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(WORDS, len(words))
    joined = b" ".join(words)
    end = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    start = [0, *(e + 1 for e in end[:len(words) - width])]
    end = end[width - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, len(start), SHINGLES):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(start[lo:lo + SHINGLES], end[lo:lo + SHINGLES], strict=True)],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(start), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    C.bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py()) for t in b.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


# ---- links ---------------------------------------------------------------------

def _upper(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT)


def _lower(fp: Column) -> Column:
    return fp.bitwiseAND((1 << SEGMENT) - 1)


def _ball(value: Column, bits: int) -> Column:
    """The value and those that differ from it in one of the lowest ``bits`` bits."""
    return F.array(value, *[value.bitwiseXOR(F.lit(_signed(1 << b))) for b in range(bits)])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _marked(table: DataFrame, keys: DataFrame) -> DataFrame:
    """``table`` (key, fp) with ``crowded``: its key is in ``keys`` (written, distinct)."""
    out = C.keyed_join(table, keys.withColumn("crowded", F.lit(True)), ["key"], F.col("fp"), "left")
    return out.withColumn("crowded", F.coalesce("crowded", F.lit(False)))


def _crowded(table: DataFrame) -> DataFrame:
    return C.materialise(table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select("key"),
                         "simhash_crowded")


def _by_points(dense: DataFrame) -> DataFrame:
    """Links of crowded fingerprints: those that meet at a point, with the smallest of them."""
    points = dense.select("fp", F.explode(_ball(F.col("fp"), 64)).alias("point"))
    # at most 65 distinct fingerprints lie within one bit of a point
    met = points.groupBy("point").agg(F.array_sort(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    return (met.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))
            .where(_near("a", "b")).distinct())


def links(found: DataFrame) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` of a written table, enough of
    them for the components."""
    fp = F.col("fp")
    upper, lower = found.select(_upper(fp).alias("key"), "fp"), found.select(_lower(fp).alias("key"), "fp")
    hot_upper, hot_lower = _crowded(upper), _crowded(lower)
    around = C.materialise(hot_upper.select(F.explode(_ball(F.col("key"), SEGMENT)).alias("key")).distinct(), "simhash_around")
    # tables without the crowded values: at most CROWD rows to a key
    upper_cold, lower_cold = (_marked(t, hot).where("NOT crowded").drop("crowded")
                              for t, hot in ((upper, hot_upper), (lower, hot_lower)))
    flips = F.array(*[F.when(F.col("key").bitwiseAND(1 << b) == 0, F.col("key").bitwiseOR(F.lit(1 << b)))
                      for b in range(SEGMENT)])
    table = upper_cold.withColumnRenamed("fp", "b")
    probes = upper_cold.select("fp", F.explode(F.array_compact(flips)).alias("key"))
    one_off = probes.join(table, "key").where(_near("fp", "b")).select(F.col("fp").alias("a"), "b")
    same = [t.join(t.select("key", F.col("fp").alias("b")), "key").where((F.col("fp") < F.col("b")) & _near("fp", "b"))
            .select(F.col("fp").alias("a"), "b") for t in (upper_cold, lower_cold)]
    cold = one_off.unionByName(same[0]).unionByName(same[1])
    dense = (_marked(upper, around).where("crowded").select("fp")
             .unionByName(_marked(lower, hot_lower).where("crowded").select("fp")).distinct())
    return cold.unionByName(_by_points(dense))


def _same_id(prints: DataFrame) -> DataFrame:
    """Links between the fingerprints of one id that stands on several rows."""
    ids = prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("top"))
    again = C.materialise(ids.where("a <> top").select("doc_id", "a"), "simhash_again")
    return C.keyed_join(prints, again, ["doc_id"], F.col("fp")).where("a <> fp").select("a", F.col("fp").alias("b"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = C.materialise(fingerprints(docs), "simhash_prints")
    found = C.materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("doc_id").alias("n"))
                          .where("n > 0"), "simhash_found")
    pairs = C.materialise(links(found.select("fp")).unionByName(_same_id(prints)), "simhash_links")
    roots = components(pairs)  # (node, root) of fingerprints; roots themselves are left out
    rooted = C.materialise(C.keyed_join(found, roots.withColumnRenamed("node", "fp"), ["fp"], F.col("fp"), "left")
                           .select("fp", "first", "n", F.coalesce("root", "fp").alias("root")), "simhash_rooted")
    heads = C.materialise(rooted.groupBy("root").agg(F.min("first").alias("component"), F.sum("n").alias("docs"))
                          .where("docs > 1").select("root", "component"), "simhash_heads")
    known = C.materialise(C.keyed_join(rooted, heads, ["root"], F.col("fp")).select("fp", "component"), "simhash_known")
    out = C.keyed_join(prints, known, ["fp"], F.col("doc_id"), "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by their fingerprints."""
    return join(C.table(spark, sf_dir, "documents"))
