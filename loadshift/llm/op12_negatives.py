"""Operator 12: hard-negative mining with anchor spanning-tree bounds.

For every anchor its positives are the best-scoring other rows of its label, and for each
positive the negatives are the best-scoring rows of other labels whose score lies in a window
below the positive's. Scores are inner products of integer vectors, ties go to smaller ids.

Method. The anchors (a stated query set) are dealt into blocks of near ones, and each block
gets a minimum spanning tree (Prim, in one task of at most ``BLOCK`` anchors). For a candidate
x the score at a child anchor is the score at its parent plus <child - parent, x>, which is at
most the edge's length times the norm of x. Going down the tree, every candidate has a
lower and an upper bound at every anchor; its score is computed only where the bounds overlap
the anchor's window. Windows shrink while a task runs: below the best found so far nothing
counts. All scores that count are exact, so the result is, whatever the blocks and trees.

Spark. The vectors are written once as integers. Blocks of trees are sent to the executors in
waves of at most ``WAVE_BYTES``; the candidates are never shuffled. A task returns at
most its best rows per anchor (and positive), and a window function merges them. One round
finds the positives, a second one the negatives; both are written to the shared folder.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take
no part. Repeated rows count once; of rows that share an id the smallest (label, vector)
stays. Vectors of other lengths end in zeros. A positive with a negative score has an empty
window. Anchors without a positive, and positives without a row in the window, give no rows.
Equal scores are ordered by id. An empty table gives no rows. Other input columns are ignored,
whatever their names. Scores beyond a long are held at its limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import vectors as V

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90                 # window of a negative, percent of the positive's score
BLOCK = 512                        # anchors of a tree
MAX_PIVOTS = 64                    # anchors that deal the others into blocks
WAVE_BYTES = 32 << 20              # anchors sent to the executors at once
ROWS = 4096                        # candidates scored together
DENSE = 0.15                       # share of a level above which all of it is scored

TREE = "ids array<long>, labels array<long>, q array<long>, parent array<int>, edge array<double>"


# ---- trees ---------------------------------------------------------------------

def spanning_tree(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge length) of a minimum spanning tree over the rows of ``a``; the root, the
    row nearest to the mean, is its own parent. Lengths are rounded up."""
    x = a.astype(np.float64)
    root = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    parent, edge = np.full(len(x), root, np.int32), np.zeros(len(x))
    near = ((x - x[root]) ** 2).sum(axis=1)
    out = np.ones(len(x), bool)
    out[root] = False
    while out.any():
        k = int(np.where(out, near, np.inf).argmin())
        out[k] = False
        edge[k] = np.sqrt(near[k]) * (1 + 1e-12) + 1e-6
        d = ((x - x[k]) ** 2).sum(axis=1)
        closer = out & (d < near)
        near[closer], parent[closer] = d[closer], k
    return parent, edge


def levels(parent: np.ndarray) -> list[np.ndarray]:
    """The nodes by depth, the root first."""
    depth, at = np.zeros(len(parent), int), parent.copy()
    while True:
        moving = at != parent[at]
        depth += (np.arange(len(parent)) != at) & (depth == 0)
        if not moving.any():
            break
        depth += moving
        at = parent[at]
    return [np.flatnonzero(depth == d) for d in range(depth.max(initial=0) + 1)]


def _trees(anchors: DataFrame, width: int) -> DataFrame:
    """One row per block of near anchors (written): the anchors and their tree. A block is a
    salted part of the anchors nearest to one pivot, so copies do not fill one task."""
    spark, count = anchors.sparkSession, anchors.count()
    if not count:
        return spark.createDataFrame([], TREE)
    n_pivots = max(1, min(MAX_PIVOTS, -(-count // (BLOCK // 2))))
    first = anchors.orderBy("vec_id").limit(n_pivots).select("q").toArrow()  # at most MAX_PIVOTS rows
    pivots = spark.sparkContext.broadcast(V.matrix(first["q"], width).astype(np.float64))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        half = (p ** 2).sum(axis=1) / 2
        for b in batches:
            x = V.matrix(b.column("q"), width).astype(np.float64)
            yield b.append_column("pivot", pa.array((half - x @ p.T).argmin(axis=1).astype(np.int32)))

    dealt = C.materialise(anchors.mapInArrow(nearest, "vec_id long, label long, q array<long>, pivot int"), "negatives_pivots")
    parts = dealt.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / (BLOCK / 2)).alias("parts"))  # MAX_PIVOTS rows
    salted = dealt.join(F.broadcast(parts), "pivot").withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts"))

    def plant(group: pa.Table) -> pa.Table:
        rows = []
        for lo in range(0, group.num_rows, BLOCK):
            part = group.slice(lo, BLOCK)
            a = V.matrix(part["q"], width)
            parent, edge = spanning_tree(a)
            rows.append({"ids": part["vec_id"].to_numpy(), "labels": part["label"].to_numpy(), "q": a.ravel(),
                         "parent": parent, "edge": edge})
        kinds = {"ids": pa.int64(), "labels": pa.int64(), "q": pa.int64(), "parent": pa.int32(), "edge": pa.float64()}
        return pa.table({k: pa.array([r[k] for r in rows], pa.list_(t)) for k, t in kinds.items()})

    grouped = salted.select("pivot", "part", "vec_id", "label", "q").groupBy("pivot", "part")
    return C.materialise(grouped.applyInArrow(plant, TREE), "negatives_trees")


class Block:
    """A tree of anchors, as the tasks use it."""

    def __init__(self, ids, labels, q, parent, edge, exact: bool):
        self.ids, self.labels = np.asarray(ids, np.int64), np.asarray(labels, np.int64)
        self.parent, self.edge = np.asarray(parent), np.asarray(edge)
        self.a = np.asarray(q, np.int64).reshape(len(self.ids), -1).astype(np.float64 if exact else object)
        self.levels, self.exact = levels(self.parent), exact

    def scores(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, anchor, score) of the pairs of ``wanted`` whose score can lie in the
        anchor's window; scores outside it may be among them."""
        if not self.exact:  # too large for doubles: every pair, in Python integers
            row, col = np.nonzero(wanted)
            score = (x[row] * self.a[col]).sum(axis=1) if row.size else np.empty(0, object)
            return row, col, score
        norm = np.sqrt((x * x).sum(axis=1)) * (1 + 1e-12)
        lo, hi = np.empty(wanted.shape), np.empty(wanted.shape)
        found = []
        for depth, nodes in enumerate(self.levels):
            if depth:
                spread = norm[:, None] * self.edge[nodes] + 1e-6
                lo[:, nodes] = lo[:, self.parent[nodes]] - spread
                hi[:, nodes] = hi[:, self.parent[nodes]] + spread
                open_ = wanted[:, nodes] & (hi[:, nodes] >= low[nodes]) & (lo[:, nodes] <= high[nodes])
            if not depth or open_.mean() > DENSE:
                s = x @ self.a[nodes].T
                lo[:, nodes] = hi[:, nodes] = s
                row, col = np.nonzero(wanted[:, nodes] & (s >= low[nodes]) & (s <= high[nodes]))
                s = s[row, col]
            else:
                row, col = np.nonzero(open_)
                s = np.einsum("ij,ij->i", x[row], self.a[nodes[col]])
                lo[row, nodes[col]] = hi[row, nodes[col]] = s
            found.append((row, nodes[col], s))
        return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


class Best:
    """The k best (score, id) of every slot so far."""

    def __init__(self, slots: int, k: int):
        self.k, self.score, self.id = k, [np.empty(0)] * slots, [np.empty(0, np.int64)] * slots

    def floor(self, slot: int):
        """A score below this one cannot enter any more."""
        return self.score[slot][-1] if len(self.score[slot]) == self.k else -np.inf

    def offer(self, slot: int, score: np.ndarray, ids: np.ndarray) -> None:
        enough = score >= self.floor(slot)
        if not enough.any():
            return
        score, ids = np.concatenate([self.score[slot], score[enough]]), np.concatenate([self.id[slot], ids[enough]])
        by_id = np.argsort(ids, kind="stable")
        order = by_id[np.argsort(-score[by_id], kind="stable")][:self.k]
        self.score[slot], self.id[slot] = score[order], ids[order]


def _by_anchor(row, col, score):
    """The scores of each anchor among (row, anchor, score)."""
    order = np.argsort(col, kind="stable")
    cut = np.flatnonzero(np.diff(col[order], prepend=-1, append=-1))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        yield int(col[order[a]]), row[order[a:b]], score[order[a:b]]


def _pieces(batches: Iterator[pa.RecordBatch], width: int, exact: bool):
    """(ids, labels, vectors) of at most ROWS candidates at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            part = b.slice(lo, ROWS)
            x = V.matrix(part.column("q"), width)
            yield (part.column("vec_id").to_numpy(zero_copy_only=False), part.column("label").to_numpy(zero_copy_only=False),
                   x.astype(np.float64 if exact else object))


def _long(score) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


# ---- rounds --------------------------------------------------------------------

def _waves(trees: DataFrame, width: int) -> Iterator[list]:
    """The blocks, some at a time: at most WAVE_BYTES (or one block) are on the driver."""
    held, size = [], 0
    for row in trees.toLocalIterator():
        n = 8 * len(row.ids) * (width + 5)
        if held and size + n > WAVE_BYTES:
            yield held
            held, size = [], 0
        held.append(tuple(row))
        size += n
    if held:
        yield held


def _best_positives(vectors: DataFrame, wave, width: int, exact: bool, keep: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [Block(*t, exact) for t in wave.value]
        best = [Best(len(b.ids), keep) for b in blocks]
        for ids, labels, x in _pieces(batches, width, exact):
            for block, top in zip(blocks, best, strict=True):
                wanted = (labels[:, None] == block.labels) & (ids[:, None] != block.ids)
                low = np.array([top.floor(j) for j in range(len(block.ids))])
                for j, row, score in _by_anchor(*block.scores(x, low, np.full(len(low), np.inf), wanted)):
                    top.offer(j, score, ids[row])
        for block, top in zip(blocks, best, strict=True):
            out = [(int(block.ids[j]), int(i), _long(s)) for j in range(len(block.ids))
                   for s, i in zip(top.score[j], top.id[j], strict=True)]
            yield _rows(out, ("anchor_id", "positive_id", "positive_score"))

    found = vectors.mapInArrow(run, "anchor_id long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    return found.withColumn("place", rank).where(F.col("place") <= keep)


def _best_negatives(vectors: DataFrame, wave, positives, width: int, exact: bool, keep: int, low_pct: int,
                    high_pct: int) -> DataFrame:
    """``positives``: of each anchor of the wave, its (id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [Block(*t, exact) for t in wave.value]
        slots = [[positives.value.get(int(i), []) for i in b.ids] for b in blocks]
        windows = [[[(-(-low_pct * s // 100), high_pct * s // 100) for _, s in own] for own in block] for block in slots]
        best = [[Best(len(own), keep) for own in block] for block in slots]
        for ids, labels, x in _pieces(batches, width, exact):
            for block, window, top in zip(blocks, windows, best, strict=True):
                wanted = labels[:, None] != block.labels
                low = np.array([min((max(a, t.floor(k)) for k, (a, _) in enumerate(own)), default=np.inf)
                                for own, t in zip(window, top, strict=True)], np.float64)
                high = np.array([max((b for _, b in own), default=-np.inf) for own in window], np.float64)
                for j, row, score in _by_anchor(*block.scores(x, low, high, wanted)):
                    for k, (a, b) in enumerate(window[j]):
                        inside = (score >= a) & (score <= b)
                        top[j].offer(k, score[inside], ids[row[inside]])
        for block, own, top in zip(blocks, slots, best, strict=True):
            out = [(int(block.ids[j]), p, s, int(i), _long(v)) for j in range(len(block.ids)) for k, (p, s) in enumerate(own[j])
                   for v, i in zip(top[j].score[k], top[j].id[k], strict=True)]
            yield _rows(out, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))

    found = vectors.mapInArrow(run, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= keep)


def _rows(rows: list[tuple], names: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], list(names))


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(rows: DataFrame, is_anchor: Column, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low_pct: int = LOW, high_pct: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every
    anchor and positive. ``rows`` has vec_id, label and embedding; ``is_anchor`` is a condition
    on vec_id and label."""
    spark = rows.sparkSession
    kept = rows.where(F.col("label").isNotNull() & V.usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        V.floored(F.col("embedding"), scale).alias("q"))
    vectors = V.single(C.materialise(kept, "negatives_vectors"), "negatives")
    width, peak = V.width_and_peak(vectors)
    exact = peak * peak * max(width, 1) * 4 < V.EXACT
    trees = _trees(vectors.where(is_anchor), width)
    parts = []
    for blocks in _waves(trees, width):
        wave = spark.sparkContext.broadcast(blocks)
        found = C.materialise(_best_positives(vectors, wave, width, exact, positives), "negatives_positives")
        own: dict[int, list] = {}  # at most `positives` pairs of numbers for each anchor of the wave
        for r in found.orderBy("anchor_id", "place").collect():
            own.setdefault(r.anchor_id, []).append((r.positive_id, r.positive_score))
        sent = spark.sparkContext.broadcast(own)
        parts.append(C.materialise(_best_negatives(vectors, wave, sent, width, exact, negatives, low_pct, high_pct)
                                   .select(*COLUMNS), "negatives_found"))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100; labels of ids divisible
    by 7 are shifted first."""
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = C.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "embedding")
    return mine(rows, vec_id % 100 == 0)


ORACLE_OP12 = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (
  SELECT vec_id, label, unnest(q) AS v, generate_subscripts(q, 1) AS i FROM kept),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS other_id, b.label AS other_label,
         CAST(sum(a.v * b.v) AS BIGINT) AS score
  FROM parts a JOIN parts b ON a.i = b.i
  WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
  GROUP BY ALL),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place
        FROM scores WHERE anchor_label = other_label)
  WHERE place <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS place
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id
  WHERE s.anchor_label <> s.other_label
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 10
"""
