"""Operator 2: mixing sources to target weights by temperature.

A source with token share p gets weight p^t / sum(p^t): t = 1 keeps the natural shares,
t = 0 makes all sources equal. The exponent is bisected: the largest exponent whose weights
reach the target entropy (a share of the largest possible), or, where a repetition limit is
given, the smallest one that repeats no source more often than the limit; the limit wins.

The weights are realised as budgets of tokens. A source's documents are dealt by hash into
blocks. Whole epochs of a source use all its blocks, the last one the first blocks of a
permutation up to the budget; every epoch has its own permutation. Blocks of all sources
are then interleaved in proportion: the r-th of a source's n scheduled blocks stands at
(r + u) / n, u from a hash.

Only sums per (source, block) are gathered. The number of blocks of a source is a parameter,
so a cumulative sum runs over at most that many rows however large the source is, and a
source with a third of all rows is dealt out like any other. Documents join their blocks'
schedule by broadcast when its counted rows allow it, else salted.

Defined cases: tokens are words; a null or wordless text has none, is scheduled with its
block, and uses no budget. A null source is a source of its own. Repeated rows fall into the
same block and are scheduled alike; rows without an id are dealt by their text. An empty table, or
one without tokens, gives no rows. Other input columns pass through the pipeline stage (those
named like the schedule's own with the ending ``_input``) and are ignored by the query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

HALVINGS = 48
PER_PASS = 8                     # halvings resolved by one aggregate over the sources
SCHEDULED = ("epoch", "block", "position")


@dataclass(frozen=True)
class MixTarget:
    """What the mixture is to reach."""
    entropy_share: float = 0.995   # of log(number of sources)
    max_repeats: float = 2.0       # epochs of any source
    budget_share: float = 1.0      # scheduled tokens, as a share of the corpus' tokens
    blocks: int = 256              # per source
    seed: int = 17


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _block(target: MixTarget, doc_id: Column, text: Column) -> Column:
    """The block of a document, by its id; of one without an id, by its text."""
    deal = F.when(doc_id.isNull(), F.xxhash64(F.lit(target.seed), text)).otherwise(F.xxhash64(F.lit(target.seed), doc_id))
    return F.pmod(deal, F.lit(target.blocks)).cast("int")


def block_sums(docs: DataFrame, target: MixTarget, id_col: str = "doc_id") -> DataFrame:
    """(source, block, tokens, docs), pre-aggregated in the scan."""
    return docs.groupBy(F.col("source").cast("string").alias("source"), _block(target, F.col(id_col), F.col("text")).alias("block")).agg(
        F.sum(n_tokens(F.col("text"))).alias("tokens"), F.count(F.lit(1)).alias("docs"))


def _curves(sources: DataFrame, low: float, high: float, parts: int, budget: float) -> list[tuple[float, float]]:
    """(entropy, largest repetition) of the weights at ``parts`` + 1 exponents from low to
    high, in one aggregate over the sources."""
    step = (high - low) / parts
    t = F.lit(low) + F.col("k") * F.lit(step)
    power = F.exp(t * F.log("share"))
    rows = (sources.select("share", "tokens", F.explode(F.sequence(F.lit(0), F.lit(parts))).alias("k"))
            .groupBy("k").agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("m"),
                              F.max(power / F.col("tokens")).alias("r")).orderBy("k").collect())
    return [(math.log(x.z) - (low + step * x.k) * x.m / x.z, budget * x.r / x.z) for x in rows]


def _bisect(sources: DataFrame, budget: float, holds) -> tuple[float, float]:
    """The bracket (low, high) in [0, 1] in which ``holds(entropy, repetition)``, true for
    small exponents, becomes false. Each pass evaluates the points of PER_PASS halvings."""
    low, high = 0.0, 1.0
    first, last = _curves(sources, 0.0, 1.0, 1, budget)
    if not holds(*first):
        return 0.0, 0.0
    if holds(*last):
        return 1.0, 1.0
    for _ in range(HALVINGS // PER_PASS):
        parts = 1 << PER_PASS
        held = sum(holds(*c) for c in _curves(sources, low, high, parts, budget)[1:-1])
        low, high = (low + (high - low) * k / parts for k in (held, held + 1))
    return low, high


def temperature(sources: DataFrame, target: MixTarget) -> tuple[float, float]:
    """(exponent, budget in tokens) for a table (source, tokens, share)."""
    n, total = sources.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    budget = target.budget_share * (total or 0)
    if not n:
        return 1.0, 0.0
    wanted = target.entropy_share * math.log(n)
    even = _bisect(sources, budget, lambda entropy, _: entropy >= wanted - 1e-12)[0]
    seldom = _bisect(sources, budget, lambda _, repeats: repeats > target.max_repeats)[1]
    return max(even, seldom), budget


def weights(blocks: DataFrame, target: MixTarget) -> DataFrame:
    """(source, tokens, share, weight, budget): the mixture's weights."""
    sums = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    total = sums.agg(F.sum("tokens")).first()[0] or 1
    sources = C.materialise(sums.withColumn("share", F.col("tokens") / F.lit(float(total))), "mix_sources")
    t, budget = temperature(sources, target)
    power = F.exp(F.lit(t) * F.log("share"))
    norm = sources.agg(F.sum(power)).first()[0] or 1.0
    return sources.withColumn("weight", power / F.lit(norm)).withColumn("budget", F.col("weight") * F.lit(budget))


def schedule(blocks: DataFrame, target: MixTarget) -> DataFrame:
    """(source, block, epoch, position): every scheduled block. Windows run over the blocks
    of one source, whose number is a parameter."""
    w = weights(blocks, target).select(F.col("source").alias("_source"), F.col("tokens").alias("all"), "budget")
    epochs = (blocks.join(w, F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.floor(F.col("budget") / F.col("all")).cast("int"))))
              .withColumn("left", F.col("budget") - F.col("epoch") * F.col("all"))
              .withColumn("order", F.xxhash64(F.lit(target.seed), "epoch", "source", "block")))
    before = F.sum("tokens").over(Window.partitionBy("source", "epoch").orderBy("order", "block")) - F.col("tokens")
    # the block that crosses the budget is used when more than half of it lies inside
    used = epochs.withColumn("before", before).where(F.col("before") + F.col("tokens") / 2 <= F.col("left"))
    own = Window.partitionBy("source")
    rank = F.row_number().over(own.orderBy("epoch", "order", "block"))
    spot = F.pmod(F.xxhash64(F.lit(target.seed), F.lit("spot"), "source", "epoch", "block"), F.lit(1 << 20)) / (1 << 20)
    return used.select("source", "block", "epoch",
                       ((rank - 1 + spot) / F.count(F.lit(1)).over(own)).alias("position"))


def mix(docs: DataFrame, target: MixTarget = MixTarget(), id_col: str = "doc_id") -> DataFrame:
    """Every scheduled occurrence of every document: its columns (one named epoch, block or position
    gets the ending ``_input``), epoch, block, and position of its block in the mixture (0 to 1)."""
    plan = C.materialise(schedule(C.materialise(block_sums(docs, target, id_col), "mix_blocks"), target), "mix_plan")
    # a null source meets its block by the same stand-in on both sides
    name = F.concat(F.when(F.col("source").isNull(), "?").otherwise("="), F.coalesce(F.col("source").cast("string"), F.lit("")))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name.alias("_name"),
                        _block(target, F.col(id_col), F.col("text")).alias("_block"), F.col(id_col).alias("_own_id"))
    when = plan.select(name.alias("_name"), F.col("block").alias("_block"), "epoch", "block", "position")
    out = C.keyed_join(keyed, when, ["_name", "_block"], F.col("_own_id"))
    own = {c: c for c in docs.columns}
    for c in SCHEDULED:  # an input column of such a name keeps its values under another
        while c in own and own[c] in (SCHEDULED + tuple(x for k, x in own.items() if k != c)):
            own[c] += "_input"
    return out.select(*[F.col("row").getField(c).alias(x) for c, x in own.items()], *SCHEDULED)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixing schedule of all documents."""
    docs = C.table(spark, sf_dir, "documents")
    return mix(docs.select("doc_id", "source", "text")).drop("text")
