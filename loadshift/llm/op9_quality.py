"""Operator 9: quality classifier by hierarchical empirical Bayes.

Document evidence is the log-odds of a logistic regression, without the odds of its classes,
over hashed features of the whole text (words, shapes of words, binned shares). The features
are those whose counts over all labelled documents differ most clearly between the classes;
the weights are fitted on about ``SAMPLE`` labelled documents (a documented bound: those
below a threshold of the id's hash). Documents are in two folds; each fold is scored by the weights of the
other, so no label meets its own document.

Site evidence is a posterior rate of good documents, for hosts and for paths within hosts:
expected good documents are summed by group over the whole corpus; the spread of the hosts'
rates fixes the strength of the global prior (method of moments), hosts shrink towards it
and paths towards their host, the more the sparser they are. A document's own share is taken
out of its groups, and its posterior is the log-odds of the path plus its own evidence.

The same is done for toxicity. A document is kept when it is probably good and not toxic.

Defined cases: a null or wordless text has no evidence and is scored by its site. A null host
or path is one more host or path. Labels that are null, or whose document is missing, are not
used; without labels of both classes there is no evidence and every score is the prior of one
half. Repeated rows each give a row; a document with several labels counts with each. An
empty table gives no rows. Other input columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 1 << 18                # hashed features; the model is 2 folds x 2 labels x BUCKETS
MIN_SUPPORT = 10                 # labelled documents with a feature
MIN_Z = 5.0                      # standard deviations from the class shares
MAX_FEATURES = 1000              # of a label, the clearest
SAMPLE = 6_000                   # labelled documents on which the weights are fitted
STEPS, RATE, RIDGE = 200, 0.05, 1e-4
MAX_EVIDENCE = 8.0               # log-odds
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0
MAX_LABELS = 1_000_000           # labels (24 bytes) that are broadcast; beyond, a shuffled join
LABELS = ("quality", "toxic")
# Bytes by class: upper case A, other letters a, digits 9, the rest as it is.
SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b > 127 else 57 if 48 <= b <= 57 else b
              for b in range(256))
EDGES = b"\"'()[]{}.,;:!?#*$%&|<>"


def _tenth(share: float) -> bytes:
    return b"%d" % min(9, int(10 * share))


def features(text: str | None) -> np.ndarray:
    """The distinct feature buckets of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.empty(0, np.int64)
    distinct = set(words)
    found = {b"w" + w.lower().strip(EDGES) for w in distinct}
    found |= {b"s" + s[:1] + s[-3:] for s in {w.translate(SHAPE) for w in distinct}}
    codes = np.frombuffer(raw, np.uint8)
    upper = float(((codes >= 65) & (codes <= 90)).mean())
    symbols = float(np.isin(codes, np.frombuffer(b"#*$%&|<>!", np.uint8)).mean())
    repeats = sum(map(bytes.__eq__, words, words[1:])) / len(words)
    found |= {b"d" + _tenth(len(distinct) / len(words)), b"u" + _tenth(4 * upper), b"y" + _tenth(10 * symbols),
              b"r" + _tenth(repeats), b"n%d" % len(words).bit_length()}
    return np.unique(np.fromiter((zlib.crc32(f) & (BUCKETS - 1) for f in found), np.int64, len(found)))


def fold(doc_id: Column) -> Column:
    return F.coalesce((F.crc32(doc_id.cast("string")) % 2).cast("int"), F.lit(0))


def count_features(labelled: DataFrame) -> DataFrame:
    """(fold, label, class, bucket, n) over all labelled documents; bucket BUCKETS counts
    the documents. Counted within each task, so at most the model's size leaves it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for b in batches:
            for i, text in zip(b.index, b["text"], strict=True):
                at = features(text)
                for label in LABELS:
                    if not pd.isna(value := b.at[i, label]):
                        counts = sums.setdefault((int(b.at[i, "fold"]), label, int(value > 0)),
                                                 np.zeros(BUCKETS + 1, np.int64))
                        counts[at] += 1
                        counts[BUCKETS] += 1
        for (part, label, value), counts in sums.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"fold": part, "label": label, "value": value,
                                "bucket": at, "n": counts[at]})

    parts = labelled.select("fold", *LABELS, "text").mapInPandas(
        run, "fold int, label string, value int, bucket int, n long")
    return parts.groupBy("fold", "label", "value", "bucket").agg(F.sum("n").alias("n"))


def clear_features(counts: DataFrame) -> pd.DataFrame:
    """(fold, label, bucket): of each fold and label the features whose documents differ most
    clearly between the classes, at most MAX_FEATURES. ``counts`` has at most 2 folds x 2
    labels x 2 classes x BUCKETS rows; only the chosen ones leave the executors."""
    n = lambda v: F.sum(F.when(F.col("value") == v, F.col("n")).otherwise(0))
    pair = counts.groupBy("fold", "label", "bucket").agg(n(0).alias("bad"), n(1).alias("good"))
    docs = pair.where(F.col("bucket") == BUCKETS).where("bad > 0 AND good > 0").select(
        "fold", "label", (F.col("good") / (F.col("good") + F.col("bad"))).alias("share"))
    total = F.col("good") + F.col("bad")
    z = F.abs(F.col("good") - total * F.col("share")) / F.sqrt(total * F.col("share") * (1 - F.col("share")))
    best = Window.partitionBy("fold", "label").orderBy(F.desc("z"), "bucket")
    return (pair.where((F.col("bucket") < BUCKETS) & (total >= MIN_SUPPORT)).join(F.broadcast(docs), ["fold", "label"])
            .withColumn("z", z).where(F.col("z") >= MIN_Z).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= MAX_FEATURES).select("fold", "label", "bucket").toPandas())


def regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and intercept of a ridge-penalised logistic regression (Adam, full batches)."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + RIDGE * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return w


def fit(labelled: DataFrame) -> np.ndarray:
    """fold x label x bucket: the log-odds weights learned from that fold, without the odds
    of its classes; the last bucket is the intercept. Features are chosen by their counts in
    all labelled documents, weights fitted on about SAMPLE of them."""
    counts = C.materialise(count_features(labelled), "quality_counts")
    clear = clear_features(counts)
    some = np.unique(clear["bucket"].to_numpy(np.int64))
    n_docs = counts.where(F.col("bucket") == BUCKETS).agg(F.sum("n")).first()[0] or 0
    share = min(1.0, SAMPLE * len(LABELS) / max(1, n_docs))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[["fold", *LABELS]].assign(at=[np.intersect1d(features(t), some, assume_unique=True)
                                                  .astype(np.int32).tobytes() for t in b["text"]])

    rows = sample.select("fold", *LABELS, "text").mapInPandas(run, "fold int, quality int, toxic int, at binary").toPandas()
    model = np.zeros((2, len(LABELS), BUCKETS + 1), np.float32)
    for (part, label), chosen in clear.groupby(["fold", "label"]):
        buckets = np.sort(chosen["bucket"].to_numpy(np.int64))
        own = rows[(rows["fold"] == part) & rows[label].notna()]
        y = (own[label].to_numpy(dtype=float) > 0).astype(float)
        if not 0 < y.sum() < y.size:
            continue
        x = np.zeros((len(own), buckets.size), np.float32)
        for i, at in enumerate(own["at"]):
            x[i] = np.isin(buckets, np.frombuffer(at, np.int32), assume_unique=True)
        w = regression(x, y)
        model[part, LABELS.index(label), buckets] = w[:-1]
        model[part, LABELS.index(label), -1] = w[-1] - np.log(y.mean() / (1 - y.mean()))
    return model


def evidence(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """doc_id, host, path and the evidence (log-odds) for each label, of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size


    def rows():
        ratios = sent.value

        def work(parts, texts):
            found = []
            for part, text in zip(parts, texts, strict=True):
                at, learned = features(text), ratios[1 - part]
                found.append(learned[:, at].sum(axis=1) + learned[:, -1] if at.size else np.zeros(len(LABELS)))
            return np.clip(np.array(found, float).reshape(len(parts), len(LABELS)), -MAX_EVIDENCE, MAX_EVIDENCE).tolist()

        return work

    return C.map_rows(docs, ["doc_id", "host", "path"], ["fold", "text"], ", ".join(f"e_{x} double" for x in LABELS), rows)


def _logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _log_odds(p: Column) -> Column:
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(q / (F.lit(1.0) - q))


def site_posteriors(scored: DataFrame, prior: dict[str, float]) -> DataFrame:
    """(host, path, n_path, and for each label host rate and sums): grouped expectations over
    the corpus, hosts shrunk towards the global rate. ``scored`` has p_<label> columns."""
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n_path"),
                                               *[F.sum(f"p_{x}").alias(f"path_{x}") for x in LABELS])
    hosts = C.materialise(paths.groupBy("host").agg(F.sum("n_path").alias("n_host"),
                                                    *[F.sum(f"path_{x}").alias(f"host_{x}") for x in LABELS]), "quality_hosts")
    # method of moments: variance between hosts beyond what sampling explains
    moments = hosts.agg(
        F.sum("n_host").alias("n"), F.count(F.lit(1)).alias("m"),
        *[F.sum(f"host_{x}").alias(f"s_{x}") for x in LABELS],
        *[F.sum(F.col(f"host_{x}") * F.col(f"host_{x}") / F.col("n_host")).alias(f"q_{x}") for x in LABELS]).first()
    for x in LABELS:
        n, m = moments["n"] or 0, moments["m"]
        rate = moments[f"s_{x}"] / n if n else prior[x]
        between = max(0.0, moments[f"q_{x}"] - n * rate * rate - (m - 1) * rate * (1 - rate)) / n if n else 0.0
        strength = MAX_STRENGTH if between <= 0 else rate * (1 - rate) / between - 1
        strength = min(MAX_STRENGTH, max(MIN_STRENGTH, strength))
        hosts = hosts.withColumn(f"rate_{x}", F.lit(rate)).withColumn(f"strength_{x}", F.lit(strength))
    named = hosts.withColumnRenamed("host", "_host")
    return paths.join(named, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")


def classify(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """doc_id, score and toxic_score (posterior probabilities), evidence, site rate, kept."""
    keyed = docs.select("doc_id", F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"),
                        "text", fold(F.col("doc_id")).alias("fold"))
    C.bound_batches(docs.sparkSession)
    known = labels.select("doc_id", *LABELS).where("doc_id IS NOT NULL")
    small = C.small_side(known, MAX_LABELS)
    model = fit(keyed.join(small if small is not None else known, "doc_id"))
    totals = known.agg(*[F.avg((F.col(x) > 0).cast("double")).alias(x) for x in LABELS]).first()
    prior = {x: 0.5 if totals[x] is None else min(0.999, max(0.001, totals[x])) for x in LABELS}
    base = {x: float(np.log(prior[x] / (1 - prior[x]))) for x in LABELS}
    scored = C.materialise(evidence(keyed, model).withColumns(
        {f"p_{x}": _logistic(F.col(f"e_{x}") + F.lit(base[x])) for x in LABELS}), "quality_evidence")
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("?"))
    sites = C.materialise(site_posteriors(scored, prior).withColumn("_h", key("host")).withColumn("_p", key("path"))
                          .drop("host", "path"), "quality_sites")
    joined = C.keyed_join(scored.withColumn("_h", key("host")).withColumn("_p", key("path")), sites, ["_h", "_p"],
                          F.col("doc_id"))
    out = {}
    for x in LABELS:
        own, k = F.col(f"p_{x}"), F.col(f"strength_{x}")
        host = (k * F.col(f"rate_{x}") + F.col(f"host_{x}") - own) / (k + F.col("n_host") - 1)
        path = (k * host + F.col(f"path_{x}") - own) / (k + F.col("n_path") - 1)
        out[x] = (_logistic(_log_odds(path) + F.col(f"e_{x}")), path)
    return joined.select("doc_id", out["quality"][0].alias("score"), out["toxic"][0].alias("toxic_score"),
                         F.col("e_quality").alias("evidence"), out["quality"][1].alias("site_rate")).withColumn(
        "kept", (F.col("score") >= 0.5) & (F.col("toxic_score") < 0.5))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; a source is a host, a language within it a path."""
    return classify(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
