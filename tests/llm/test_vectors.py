"""Operators over embeddings and fingerprints against brute force, on small awkward tables."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from brute import BLANK_WORD, LOWER

from loadshift.llm import common, op11_codes, op12_negatives, op13_simhash, vectors

SCHEMA = "vec_id long, label int, embedding array<float>, q array<long>, pivot int, key string, n long, need int"
NAN, INF = float("nan"), float("inf")


def cloud(n, width=8, seed=3, groups=12):
    """Vectors around a few centers, with copies, ties and integers."""
    r = random.Random(seed)
    centers = [[r.uniform(-1, 1) for _ in range(width)] for _ in range(groups)]
    out = []
    for i in range(n):
        v = [float(np.float32(c + r.gauss(0, 0.05))) for c in r.choice(centers)]
        out.append((i, r.randrange(4) if i % 11 else None, [0.5] * width if i % 9 == 0 else v))
    return out


ODD = [(None, 1, [0.25] * 8), (9001, 1, None), (9002, 1, [0.1] * 7 + [None]), (9003, 1, [0.1] * 7 + [NAN]),
       (9004, 2, [INF] + [0.0] * 7), (9005, 2, []), (9006, 3, [0.3, -0.2]), (9100, 1, [0.2] * 8), (9200, None, [0.1] * 8),
       (9300, 0, [-0.0] * 8)]


def table(spark, rows):
    return spark.createDataFrame([(i, y, v, None, 5, "k", 7, 1) for i, y, v in rows], SCHEMA).repartition(3)


def usable(rows, scale):
    return [(i, y, [math.floor(x * scale) for x in v]) for i, y, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]


# ---- codes ---------------------------------------------------------------------

def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = usable(rows, scale)
    width = max(1, -(-max((len(v) for *_, v in kept), default=0) // parts))
    kept = [(i, y, v + [0] * (parts * width - len(v))) for i, y, v in kept]
    start = sorted(kept, key=lambda t: (t[0] is None, t[0] or 0, t[2]))[:entries]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for *_, v in start] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for r in range(rounds + 1):
        found = [[nearest(cut(v, p), books[p]) for p in range(parts)] for *_, v in kept]
        for p in range(parts) if r < rounds else ():
            own = defaultdict(list)
            for (*_, v), f in zip(kept, found):
                own[f[p][1]].append(cut(v, p))
            for e, xs in own.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for (i, *_), f in zip(kept, found)),
                  key=str), books


@pytest.mark.parametrize("rows,entries,rounds", [(cloud(400) + ODD, 256, 4), (cloud(300, seed=5), 20, 6),
                                                 (cloud(40) + cloud(40), 256, 3), ([], 256, 4), (ODD, 256, 4),
                                                 (cloud(3000, seed=9, groups=60), 64, 8)])
def test_codes_equal_full_search(spark, rows, entries, rounds):
    out, books = op11_codes.compress(table(spark, rows), entries=entries, rounds=rounds)
    want, plain = plain_codes(rows, entries=entries, rounds=rounds)
    assert sorted(((r.vec_id, r.code, r.error) for r in out.collect()), key=str) == want
    assert [c.tolist() for c in books] == plain


def test_codes_of_huge_components(spark):
    rows = [(i, 0, [float(np.float32(v)) for v in (1e18 + i * 1e14, -3e12, i, 7e15, 1, 2, 3, 4)]) for i in range(9)]
    out, books = op11_codes.compress(table(spark, rows), entries=4, rounds=2, scale=1)
    want, plain = plain_codes(rows, entries=4, rounds=2, scale=1)
    top = (1 << 63) - 1
    assert sorted((r.vec_id, r.code, r.error) for r in out.collect()) == [(i, c, min(e, top)) for i, c, e in want]
    assert [[list(map(int, e)) for e in c] for c in books] == plain


def test_bounds_spare_work():
    """Once the entries have settled, hardly a part needs more than its assigned entry."""
    r = np.random.default_rng(4)
    centers = r.integers(-3000, 3000, (64, 16))
    x = (centers[r.integers(0, 64, 2000)] + r.integers(-40, 40, (2000, 16))).astype(float)
    near, bound, _ = op11_codes.search(x, centers.astype(float), 8)
    moved = np.full(64, 1.0)
    again = (centers + r.integers(0, 2, centers.shape) * (np.arange(16) == 3)).astype(float)
    got = op11_codes.search_again(x, again, moved, near, bound, 4)
    full = op11_codes.search(x, again, 4)
    assert (got[0][:, 0] == full[0][:, 0]).all() and (got[2] == full[2]).all()
    assert (got[3] == 1).mean() > 0.9
    exact = np.sqrt(op11_codes._squared(x, again))
    assert (got[1][:, :4] <= np.take_along_axis(exact, got[0], axis=1) + 1e-6).all()
    rest = exact.copy()
    np.put_along_axis(rest, got[0], np.inf, axis=1)
    assert (got[1][:, 4] <= rest.min(axis=1) + 1e-6).all()


# ---- negatives -----------------------------------------------------------------

def plain_negatives(rows, anchor, n_pos=5, n_neg=10, low=30, high=90, scale=256):
    kept = [t for t in usable(rows, scale) if t[0] is not None and t[1] is not None]
    one = {}
    for t in sorted(kept, key=lambda t: (t[0], t[1], t[2]), reverse=True):
        one[t[0]] = t
    kept = list(one.values())
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, y, v in kept:
        if not anchor(i):
            continue
        scores = sorted((-dot(v, w), j, z) for j, z, w in kept if j != i)
        for p, pid, _ in [t for t in scores if t[2] == y][:n_pos]:
            inside = [(-s, j) for s, j, z in scores if z != y and low * -p <= 100 * -s <= high * -p][:n_neg]
            out += [(i, pid, k + 1, j, -p, s) for k, (s, j) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("rows,every", [(cloud(500) + ODD, 10), (cloud(120) + cloud(120) + cloud(120, seed=8), 7), ([], 100),
                                        (cloud(700, seed=6, groups=3), 1), ([(i, i % 2, [0.0] * 8) for i in range(30)], 3)])
def test_negatives_equal_brute_force(spark, monkeypatch, rows, every):
    from pyspark.sql import functions as F
    monkeypatch.setattr(op12_negatives, "WAVE_BYTES", 20_000)  # several waves
    out = op12_negatives.mine(table(spark, rows), F.col("vec_id") % every == 0)
    got = sorted(tuple(r[c] for c in op12_negatives.COLUMNS) for r in out.collect())
    assert got == plain_negatives(rows, lambda i: i % every == 0)


def test_negatives_of_huge_components(spark):
    from pyspark.sql import functions as F
    rows = [(i, i % 3, [float(np.float32((i * 37 % 11 - 3) * 1e6)), float(i), 2e6, -5.0]) for i in range(40)]
    out = op12_negatives.mine(table(spark, rows), F.col("vec_id") % 4 == 0)
    got = sorted(tuple(r[c] for c in op12_negatives.COLUMNS) for r in out.collect())
    assert got == plain_negatives(rows, lambda i: i % 4 == 0)


def test_tree_bounds_spare_scores():
    """Bounds along the tree hold every score, and most pairs of near anchors need none."""
    r = np.random.default_rng(2)
    a = (r.integers(-90, 90, 32) + r.integers(-3, 4, (200, 32))).astype(np.int64)
    parent, edge = op12_negatives.spanning_tree(a)
    true = np.sqrt(((a - a[parent]) ** 2).sum(axis=1))
    assert (edge >= true).all() and (edge <= true + 1e-5).all()
    assert sum(len(x) for x in op12_negatives.levels(parent)) == 200
    block = op12_negatives.Block(np.arange(200), np.zeros(200), a.ravel(), parent, edge, True)
    x = r.integers(-90, 90, (500, 32)).astype(float)
    s = x @ a.T
    low = np.quantile(s, 0.999) * np.ones(200)
    computed = []
    real = np.einsum
    op12_negatives.np.einsum = lambda *k: computed.append(len(k[1])) or real(*k)
    try:
        row, col, score = block.scores(x, low, np.full(200, np.inf), np.ones((500, 200), bool))
    finally:
        op12_negatives.np.einsum = real
    got = {(i, j) for i, j, v in zip(row, col, score) if v >= low[0]}
    assert got == set(zip(*np.nonzero(s >= low[0]))) and (score == s[row, col]).all()
    assert sum(computed) < 0.4 * s.size


# ---- fingerprints --------------------------------------------------------------

def plain_fingerprint(text):
    words = BLANK_WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_components(nodes):
    """{id: least reachable id} of (id, fingerprint); rows with one id are one document."""
    root = {i: i for i, _ in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, f) in enumerate(nodes):
        for j, g in nodes[:k]:
            if (f ^ g).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in nodes}


def text_rows():
    r = random.Random(11)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(200)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    big = (1 << 62) + 5
    base = prose(90)
    rows = [(0, None), (1, ""), (2, " \t\n\x0b\x0c\r "), (3, "one"), (4, "ONE"), (5, "One two"), (6, "one two  three"),
            (7, "x" * 200_000), (8, "a b " * 100_000), (9, "É é ÉÉ ſ K"), (big, base), (big + 1, base), (big + 2, base.upper()),
            (None, base), (None, None), (12, base), (12, prose(50)), (13, "a b c"), (13, "a b c")]
    rows += [(100 + k, " ".join(w if r.random() > 0.01 else "zz" for w in base.split())) for k in range(60)]
    return rows + [(300 + k, prose(r.randint(1, 40))) for k in range(150)]


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(op13_simhash, "CROWD", crowd)
    rows = text_rows()
    docs = spark.createDataFrame([(i, t, 1, 2, "c") for i, t in rows], "doc_id long, text string, fp long, key int, component string")
    out = op13_simhash.join(docs.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in out) == sorted((str(i), f"{plain_fingerprint(t):016x}") for i, t in rows)
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows if i is not None])
    assert all(r.component_id == (None if r.doc_id is None else want[r.doc_id]) for r in out)


@pytest.mark.parametrize("crowd", [64, 3, 0])
def test_links_of_crowded_segments(spark, monkeypatch, crowd):
    """Chains and clusters of fingerprints that share halves keep every component."""
    monkeypatch.setattr(op13_simhash, "CROWD", crowd)
    r = random.Random(crowd)
    prints = {0, (1 << 64) - 1, 1 << 63, 3 << 62}
    for _ in range(6):
        at = r.getrandbits(64)
        for _ in range(60):
            prints.add(at)
            for b in r.sample(range(64), r.choice([1, 2, 2, 3])):
                at ^= 1 << b
    half = r.getrandbits(32)
    prints |= {half << 32 | r.getrandbits(32) for _ in range(80)} | {r.getrandbits(32) << 32 | half for _ in range(80)}
    signed = [op13_simhash._signed(p) for p in sorted(prints)]
    found = common.materialise(spark.createDataFrame([(p,) for p in signed], "fp long"), "test_prints")
    pairs = op13_simhash.links(found).collect()
    assert all(1 <= ((p.a ^ p.b) & (1 << 64) - 1).bit_count() <= 2 for p in pairs)
    got = dict.fromkeys(signed)
    got = {p: p for p in signed}

    def find(x):
        while got[x] != x:
            x = got[x]
        return x

    for p in pairs:
        a, b = find(p.a), find(p.b)
        got[max(a, b)] = min(a, b)
    want = plain_components([(p, p & (1 << 64) - 1) for p in signed])
    assert {p: find(p) for p in signed} == want


def test_simhash_of_an_empty_table(spark):
    assert op13_simhash.join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_matrix_pads_with_zeros():
    import pyarrow as pa
    col = pa.array([[9, 9], [1, 2, 3], [], [4]], pa.list_(pa.int64())).slice(1)
    assert vectors.matrix(col, 4).tolist() == [[1, 2, 3, 0], [0] * 4, [4, 0, 0, 0]]
