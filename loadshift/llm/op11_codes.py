"""Operator 11: vector code compression with Drake-Hamerly adaptive bounds.

Vectors become integers and are cut into equal consecutive parts; every part position has its
own codebook, refined by rounds of assignment (nearest entry by squared Euclidean distance,
ties to the lower index) and replacement (componentwise floor of the mean; unused entries
stay). The result is the code of every vector, its error, and the codebooks.

Method. An assignment keeps, for each part, its b closest entries in order with a lower bound
of their distances, the assigned one first, and one outer bound for all the others. When the
entries move, a bound falls by its entry's shift and the outer bound by the largest shift. The
distance to the assigned entry is computed anew; only entries whose bound does not exceed it
are uncertain, and these are compared by their integer distances. Where the outer bound does
not exceed it, all entries are, and the list is made anew. b adapts between rounds: it
shrinks to what nearly all parts needed, and doubles where the outer bound failed too often.
Bounds are rounded down and shifts up, so the result equals full search.

Spark. The state (vectors, lists, bounds) is a table written in the shared folder in every
round; a lost executor repeats its part of one round. Tasks sum their vectors by entry, and
Spark adds these sums. The driver holds the codebooks (entries x width numbers) only.

Defined cases: rows whose vector is null, or holds a null or non-finite component, are left
out. Vectors of other lengths end in zeros, up to the largest length rounded up to equal
parts. Fewer rows than entries give a smaller codebook. Rows with one vec_id are rows of
their own (the start takes the smallest vectors first); a null vec_id comes last. An empty
table gives no rows. Other input columns are ignored, whatever their names. Components too
large for doubles are handled in Python integers, without bounds; errors beyond a long are
held at its limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import vectors as V

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4       # an entry's index is one byte
START_KEEP, MIN_KEEP, MAX_KEEP = 32, 4, 64  # b, the listed entries of a part
SPARE = 64                               # one part in so many may need more than the next b
REFILL = 4                               # b doubles if the outer bound fails in one part of so many
ROWS = 4096                              # vectors handled together
SLACK = 1e-9                             # of a bound, for the rounding of roots

STATE = "vec_id long, label string, q array<long>, code string, error long, near binary, bound binary, need array<int>"


# ---- assignment of one part ----------------------------------------------------

def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all pairs (integers held as doubles, or Python integers)."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)


def _down(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared) * (1 - SLACK)


def search(x: np.ndarray, c: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Full search: (near, bound, squared distance to the first). ``bound`` has one more
    column than ``near``, the outer bound."""
    d = _squared(x, c)
    if d.dtype == object:
        first = (d * len(c) + np.arange(len(c))).argmin(axis=1)
        near = np.repeat(first[:, None], keep, axis=1)
        return near, np.zeros((len(x), keep + 1)), d[np.arange(len(x)), first]
    key = d.astype(np.int64) * len(c) + np.arange(len(c))  # ties to the lower index
    take = min(keep + 1, len(c))
    some = np.argpartition(key, take - 1, axis=1)[:, :take]
    some = np.take_along_axis(some, np.take_along_axis(key, some, axis=1).argsort(axis=1), axis=1)
    found = np.take_along_axis(d, some, axis=1)
    near, bound = np.repeat(some[:, :1], keep, axis=1), np.full((len(x), keep + 1), np.inf)
    near[:, :min(keep, take)] = some[:, :keep]
    bound[:, :take] = _down(found)
    return near, bound, found[:, 0]


def search_again(x: np.ndarray, c: np.ndarray, moved: np.ndarray, near: np.ndarray, bound: np.ndarray,
                 keep: int) -> tuple[np.ndarray, ...]:
    """Search by bounds, after every entry moved by at most ``moved``: (near, bound, squared
    distance to the first, entries of the list that were needed)."""
    b = near.shape[1]
    bound = np.hstack([bound[:, :b] - moved[near], bound[:, b:] - moved.max(initial=0)])
    squared = ((x - c[near[:, 0]]) ** 2).sum(axis=1)
    radius = np.sqrt(squared) * (1 + SLACK) + SLACK
    whole = bound[:, b] <= radius
    unsure = bound[:, :b] <= radius[:, None]
    unsure[:, 0] = True
    unsure[whole] = False
    need = np.where(whole, b + 1, b - unsure[:, ::-1].argmax(axis=1))
    # integer verification of the uncertain entries
    row, slot = np.nonzero(unsure)
    exact = np.full(near.shape, np.inf)
    exact[row, slot] = ((x[row] - c[near[row, slot]]) ** 2).sum(axis=1)
    bound[:, :b] = np.where(unsure, _down(np.where(unsure, exact, 0)), bound[:, :b])
    best = exact.min(axis=1)
    tied = exact == best[:, None]
    first = np.where(tied, near, len(c)).argmin(axis=1)
    order = bound[:, :b].copy()
    order[np.arange(len(x)), first] = -np.inf
    order = order.argsort(axis=1, kind="stable")
    near, bound[:, :b] = np.take_along_axis(near, order, axis=1), np.take_along_axis(bound[:, :b], order, axis=1)
    if keep < b:
        near, bound = near[:, :keep], np.hstack([bound[:, :keep], np.minimum(bound[:, keep:keep + 1], bound[:, b:])])
    elif keep > b:  # the added places never count: their bound is infinite
        near = np.hstack([near, np.repeat(near[:, :1], keep - b, axis=1)])
        bound = np.hstack([bound[:, :b], np.full((len(x), keep - b), np.inf), bound[:, b:]])
    if whole.any():
        near[whole], bound[whole], best[whole] = search(x[whole], c, keep)
    return near, bound, best, need


# ---- rounds --------------------------------------------------------------------

def _fixed(column: pa.Array, kind, *shape: int) -> np.ndarray:
    """A binary column of rows of one length as numbers."""
    return np.frombuffer(b"".join(v.as_py() for v in column), kind).reshape(len(column), *shape)


def _assign(state: DataFrame, books: list[np.ndarray], moved: list[np.ndarray] | None, had: int, keep: int,
            exact: bool) -> DataFrame:
    """The next state. ``moved`` is None in the first round, which has no lists yet."""
    parts, width = len(books), books[0].shape[1]
    sent = state.sparkSession.sparkContext.broadcast((books, moved))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.float64 if exact else object
        codebooks, shifts = sent.value
        codebooks = [c.astype(kind) for c in codebooks]
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                x = V.matrix(b.column("q"), parts * width).astype(kind)
                n, lists, bounds, errors, needs = len(x), [], [], 0, []
                if shifts is not None:
                    near = _fixed(b.column("near"), np.uint8, parts, had).astype(np.int64)
                    bound = _fixed(b.column("bound"), np.float32, parts, had + 1).astype(np.float64)
                for p, c in enumerate(codebooks):
                    own = x[:, p * width:(p + 1) * width]
                    if shifts is None or not exact:
                        l, u, e = search(own, c, keep)
                        need = np.full(n, keep + 1)
                    else:
                        l, u, e, need = search_again(own, c, shifts[p], near[:, p], bound[:, p], keep)
                    lists.append(l)
                    bounds.append(u)
                    needs.append(need)
                    errors = errors + e
                lists = np.ascontiguousarray(np.stack(lists, axis=1), dtype=np.uint8)
                down = np.stack(bounds, axis=1)
                down = np.ascontiguousarray(np.nextafter(down.astype(np.float32), np.float32(-np.inf)))
                down[np.stack(bounds, axis=1) == np.inf] = np.inf
                codes = [row.tobytes().hex() for row in lists[:, :, 0]]
                errors = [min(int(e), (1 << 63) - 1) for e in errors]
                need = np.stack(needs, axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    b.column("vec_id"), b.column("label"), b.column("q"), pa.array(codes), pa.array(errors, pa.int64()),
                    pa.array([r.tobytes() for r in lists], pa.binary()), pa.array([r.tobytes() for r in down], pa.binary()),
                    pa.array(list(need), pa.list_(pa.int32()))],
                    ["vec_id", "label", "q", "code", "error", "near", "bound", "need"])

    return C.materialise(state.mapInArrow(run, STATE), "codes_state")


def _means(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The next codebooks: the floor of the mean of each entry's parts."""
    parts, (size, width) = len(books), books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), object)
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                x = V.matrix(b.column("q"), parts * width)
                code = np.frombuffer(bytes.fromhex("".join(b.column("code").to_pylist())), np.uint8).reshape(-1, parts)
                safe = np.abs(x, dtype=np.float64).max(initial=0) * len(x) < V.EXACT
                for p in range(parts):
                    count[p] += np.bincount(code[:, p], minlength=size)
                    for j in range(width):
                        column = x[:, p * width + j]
                        if safe:
                            total[p, :, j] += np.bincount(code[:, p], weights=column, minlength=size).astype(np.int64).astype(object)
                        else:
                            np.add.at(total[p, :, j], code[:, p], column.astype(object))
        used = [(p, e) for p in range(parts) for e in np.flatnonzero(count[p])]
        rows = [(p, int(e), j, str(total[p, e, j]), int(count[p, e])) for p, e in used for j in range(width)]
        names = ["part", "entry", "pos", "total", "n"]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    sums = (state.select("q", "code").mapInArrow(run, "part int, entry int, pos int, total string, n long")
            .groupBy("part", "entry", "pos").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n")))
    out = [c.copy() for c in books]
    for r in sums.collect():  # at most entries x width rows
        out[r.part][r.entry, r.pos] = int(r.total) // r.n
    return out


def _next_keep(state: DataFrame, listed: int, keep: int, size: int) -> int:
    """b of the next round, from what the parts needed of their ``listed`` entries in this one."""
    needed = {r.need: r["count"] for r in state.select(F.explode("need").alias("need")).groupBy("need").count().collect()}
    total = sum(needed.values())
    if needed.get(listed + 1, 0) * REFILL > total:
        return min(2 * keep, MAX_KEEP, size)
    b, over = 0, total
    while over * SPARE > total and b < listed:
        b += 1
        over -= needed.get(b, 0)
    return min(max(b + 1, MIN_KEEP), keep)


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label as text, code, error) of every usable row of ``rows`` (vec_id, label,
    embedding), and the codebooks: one array (entry, component) for each part. ``entries`` is
    256 at most."""
    kept = rows.where(V.usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        V.floored(F.col("embedding"), scale).alias("q"))
    state = C.materialise(kept, "codes_vectors")
    longest, peak = V.width_and_peak(state)
    width = max(1, -(-longest // parts))
    exact = 4 * peak * peak * width * entries < V.EXACT
    start = state.orderBy(F.asc_nulls_last("vec_id"), "q").limit(entries).select("q").toArrow()
    first = V.matrix(start["q"], parts * width) if start.num_rows else np.zeros((0, parts * width), np.int64)
    books = [first[:, p * width:(p + 1) * width] for p in range(parts)]
    if not exact:
        books = [c.astype(object) for c in books]
    if not len(first):
        return state.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books
    had = keep = min(START_KEEP, len(first))
    state = _assign(state, books, None, 0, keep, exact)
    for left in reversed(range(rounds)):
        then, books = books, _means(state, books)
        moved = [np.sqrt(((a - b) ** 2).sum(axis=1).astype(np.float64)) * (1 + SLACK) + SLACK
                 for a, b in zip(books, then, strict=True)]
        state = _assign(state, books, moved, had, keep, exact)
        listed, had = had, keep
        if left and exact:
            keep = _next_keep(state, listed, keep, len(first))
    return state.select("vec_id", "label", "code", "error"), books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Digest of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for c in books for v in c.ravel()).encode()).hexdigest()


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, with the error summed over each label."""
    coded, books = compress(C.table(spark, sf_dir, "embeddings"))
    keyed = coded.withColumn("key", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    sums = C.materialise(keyed.groupBy("key").agg(F.sum("error").alias("label_error")), "codes_labels")
    return C.keyed_join(keyed, sums, ["key"], F.col("vec_id"), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    start = """
kept AS MATERIALIZED (
  SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
flat AS (SELECT vec_id, len(q) // 4 AS w, unnest(q) AS v, generate_subscripts(q, 1) - 1 AS i FROM kept),
comps AS MATERIALIZED (SELECT vec_id, i // w AS part, i % w AS pos, v FROM flat),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256),
book0 AS MATERIALIZED (SELECT part, entry, pos, v FROM comps JOIN first USING (vec_id))"""
    assign = """
dist{r} AS (
  SELECT c.vec_id, c.part, b.entry, CAST(sum((c.v - b.v) * (c.v - b.v)) AS BIGINT) AS d
  FROM comps c JOIN book{r} b ON c.part = b.part AND c.pos = b.pos GROUP BY ALL),
code{r} AS MATERIALIZED (
  SELECT vec_id, part, entry, d
  FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) AS place FROM dist{r}) WHERE place = 1)"""
    update = """
mean{s} AS (
  SELECT c.part, a.entry, c.pos, CAST(sum(c.v) AS BIGINT) AS t, count(*) AS n
  FROM comps c JOIN code{r} a ON c.vec_id = a.vec_id AND c.part = a.part GROUP BY ALL),
book{s} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, CASE WHEN n IS NULL THEN b.v ELSE (t - ((t % n + n) % n)) // n END AS v
  FROM book{r} b LEFT JOIN mean{s} m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)"""
    steps = [start]
    for r in range(ROUNDS):
        steps += [assign.format(r=r), update.format(r=r, s=r + 1)]
    steps.append(assign.format(r=ROUNDS))
    steps.append(f"""
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM code{ROUNDS} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{ROUNDS})""")
    return "WITH " + ",".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id) CROSS JOIN digest
"""


ORACLE_OP11 = _oracle()
