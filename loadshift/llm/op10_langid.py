"""Operator 10: language identification of mixed-language text.

Training counts, for every language, the hashed letter trigrams and the scripts of all
training documents. In prediction the script of a word narrows its candidate languages
(script ranges below), each word gets a log-probability per candidate, and Viterbi with a
switching penalty labels the words, so that a text may change language. The prediction of a
document is the language with most letters, its score that language's share of the letters.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every
text when there is nothing to learn from. Rows with a null id are predicted and never
learned from; ``held_out`` is false for them. Ties go to the alphabetically first language.
Repeated rows each give a row; an empty table gives no rows. Input columns other than id,
text and language are ignored.

Work is linear in the text. A task holds one Arrow batch of bounded bytes and the word scores
(words x languages) of one chunk of texts, or of one text longer than a chunk. Labels take the
smallest type that holds the number of languages. The model is languages x ``BUCKETS`` counts,
whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 1 << 15
SWITCH_PENALTY = 12.0            # in log-probability; about three words of evidence
SMOOTHING = 0.3
MIN_SCRIPT_SHARE = 1e-4          # of a language's letters, for the script to count as its own
WRONG_SCRIPT = -1000.0
HELD_OUT_REMAINDER, FOLDS = 2, 4
CHUNK_CHARS = 1_000_000
CHUNK_CELLS = 2_000_000
# First code points of script ranges (fixed values of the Unicode block table).
SCRIPT_STARTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x1380, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"),
    (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
    (0x30000, "other"),
)


@dataclass(frozen=True)
class Words:
    """The words (runs of letters) of several texts, one after the other."""
    bucket: np.ndarray       # per letter: trigram bucket
    script: np.ndarray       # per word
    first: np.ndarray        # per word: index of its first letter
    start: np.ndarray        # per word: code point in its text
    letters: np.ndarray      # per word
    text: np.ndarray         # per word: which text


class Reader:
    """Cuts texts into words. Holds lookup tables for the 16-bit code points."""

    def __init__(self):
        chars = [chr(i) for i in range(0x10000)]
        self.letter = np.array([c.isalpha() for c in chars])
        self.lower = np.array([ord(x) if len(x := c.lower()) == 1 else i for i, c in enumerate(chars)], np.uint32)
        names = sorted({name for _, name in SCRIPT_STARTS})
        self.script_names = names
        self.range_start = np.array([at for at, _ in SCRIPT_STARTS])
        self.range_script = np.array([names.index(name) for _, name in SCRIPT_STARTS])

    def words(self, texts: list[str]) -> Words:
        sizes = np.array([len(t) + 1 for t in texts])
        begin = np.concatenate([[0], np.cumsum(sizes)])
        raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        small = np.minimum(raw, 0xFFFF)
        letter, code = self.letter[small], self.lower[small]
        if (far := np.flatnonzero(raw > 0xFFFF)).size:
            found, back = np.unique(raw[far], return_inverse=True)
            letter[far] = np.array([chr(c).isalpha() for c in found])[back]
            code[far] = np.array([ord(chr(c).lower()[0]) for c in found], np.uint32)[back]
        code = np.where(letter, code, 0).astype(np.uint32)
        at = np.flatnonzero(letter)
        before = np.where(at > 0, code[at - 1], 0)
        after = np.append(code, np.uint32(0))[at + 1]
        mixed = (before * np.uint32(0x9E3779B1)) ^ (code[at] * np.uint32(0x85EBCA77)) ^ (after * np.uint32(0xC2B2AE3D))
        mixed ^= mixed >> np.uint32(15)
        bucket = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        first = np.flatnonzero(np.diff(at, prepend=-9) > 1)
        place = at[first]
        text = np.searchsorted(begin, place, side="right") - 1
        script = self.range_script[np.searchsorted(self.range_start, raw[place], side="right") - 1]
        return Words(bucket.astype(np.int64), script, first, place - begin[text],
                     np.diff(np.append(first, at.size)), text)


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) in groups of about ``limit`` characters, whole texts."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield begin, texts[begin:i + 1]
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, texts[begin:]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prob: np.ndarray         # bucket x language
    allowed: np.ndarray          # script x language: 0, or WRONG_SCRIPT


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT_REMAINDER, F.lit(False))


def count_letters(train: DataFrame) -> DataFrame:
    """(lang, kind, slot, n): trigram buckets (kind 0) and scripts (kind 1) of all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                grams, scripts = sums.setdefault(
                    lang, (np.zeros(BUCKETS, np.int64), np.zeros(len(reader.script_names), np.int64)))
                for _, part in chunks(texts.tolist()):
                    w = reader.words(part)
                    grams += np.bincount(w.bucket, minlength=BUCKETS)
                    scripts += np.bincount(w.script, weights=w.letters, minlength=scripts.size).astype(np.int64)
        for lang, both in sums.items():
            for kind, counts in enumerate(both):
                slot = np.flatnonzero(counts)
                yield pd.DataFrame({"lang": lang, "kind": kind, "slot": slot, "n": counts[slot]})

    parts = train.select("lang", "text").mapInPandas(run, "lang string, kind int, slot int, n long")
    return parts.groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n"))


def fit(train: DataFrame) -> Model:
    """The model of all rows of ``train`` (lang, text, both not null)."""
    C.bound_batches(train.sparkSession)
    counts = count_letters(train).toPandas()
    languages = tuple(sorted(counts["lang"].unique()))
    n_scripts = len({name for _, name in SCRIPT_STARTS})
    grams, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((n_scripts, len(languages)))
    at = counts["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(dtype=np.int64)
    for kind, into in ((0, grams), (1, scripts)):
        own = (counts["kind"] == kind).to_numpy()
        into[counts["slot"].to_numpy()[own], at[own]] = counts["n"].to_numpy()[own]
    log_prob = np.log((grams + SMOOTHING) / (grams.sum(0) + SMOOTHING * BUCKETS))
    ours = scripts >= MIN_SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    ours[~ours.any(axis=1)] = True  # a script of no language narrows nothing
    return Model(languages, log_prob.astype(np.float32), np.where(ours, 0, WRONG_SCRIPT).astype(np.float32))


def viterbi(scores: np.ndarray, begin: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of every word. Word scores of text i are rows begin[i] to begin[i] + sizes[i];
    texts of like length advance together, one word at a time. Ties go to staying, then to the
    lower label."""
    kind = np.min_scalar_type(max(scores.shape[1] - 1, 0))  # holds every label
    labels = np.zeros(len(scores), kind)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    own = np.arange(scores.shape[1], dtype=kind)
    while order.size:
        longest = int(sizes[order[0]])
        group, order = np.split(order, [max(1, CHUNK_CELLS // longest)])
        size, at = sizes[group], begin[group]
        active = np.searchsorted(-size, -np.arange(longest), side="left")  # texts with more than t words
        came = np.zeros((longest, group.size, own.size), kind)
        best = scores[at].copy()
        for t in range(1, longest):
            n = active[t]
            v = best[:n]
            jump = v.max(axis=1, keepdims=True) - penalty
            came[t, :n] = np.where(v < jump, v.argmax(axis=1)[:, None].astype(kind), own)
            best[:n] = scores[at[:n] + t] + np.maximum(v, jump)
        now, texts = best.argmax(axis=1).astype(kind), np.arange(group.size)
        for t in range(longest - 1, -1, -1):
            n = active[t]
            labels[at[:n] + t] = now[:n]
            now[:n] = came[t, texts[:n], now[:n]]
    return labels


def _predict_chunk(texts: list[str], model: Model, reader: Reader) -> list[tuple]:
    n_langs, w = len(model.languages), reader.words(texts)
    if not (w.first.size and n_langs):
        return [("und", 0.0, "")] * len(texts)
    scores = np.add.reduceat(model.log_prob[w.bucket], w.first, axis=0) + model.allowed[w.script]
    begin = np.searchsorted(w.text, np.arange(len(texts)))
    labels = viterbi(scores, begin, np.diff(np.append(begin, len(w.text)))).astype(np.int64)
    weight = np.bincount(w.text * n_langs + labels, weights=w.letters, minlength=len(texts) * n_langs)
    weight = weight.reshape(len(texts), n_langs)
    total = weight.sum(axis=1)
    names = np.array([*model.languages, "und"], dtype=object)
    winner = names[np.where(total > 0, weight.argmax(axis=1), n_langs)].tolist()
    share = np.divide(weight.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0)
    cut = np.flatnonzero((np.diff(w.text, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
    last = np.append(cut[1:], len(w.text)) - 1
    spans: list[list[str]] = [[] for _ in texts]
    for i, a, b, k in zip(w.text[cut], w.start[cut], w.start[last] + w.letters[last], labels[cut], strict=True):
        spans[i].append(f"{names[k]}:{a}:{b}")
    return [(lang, float(p), ",".join(s)) for lang, p, s in zip(winner, share, spans, strict=True)]


def predict_texts(texts: list[str], model: Model, reader: Reader) -> list[tuple]:
    """(language, score, spans) of every text; spans are ``lang:start:end`` in code points. The
    word scores of one chunk (or one long text) are held at a time."""
    limit = max(CHUNK_CHARS // 4, min(8, 64 // max(1, len(model.languages))) * CHUNK_CHARS)  # words x languages are held
    return [row for _, part in chunks(texts, limit) for row in _predict_chunk(part, model, reader)]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans and spans of every document. Only the text
    is an input of the prediction."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.languages, model.log_prob, model.allowed))  # languages x BUCKETS

    def rows():
        reader, learned = Reader(), Model(*sent.value)
        return lambda texts: predict_texts([t or "" for t in texts], learned, reader)

    inputs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    out = C.map_rows(inputs, ["doc_id", "held_out"], ["text"], "lang_pred string, score double, spans string", rows)
    return out.select("doc_id", "held_out", "lang_pred", "score",
                      F.when(F.col("spans") == "", F.lit(0)).otherwise(F.size(F.split("spans", ","))).cast("long")
                      .alias("n_spans"), "spans")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from the documents that are not held out."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
                       & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return predict(docs, fit(train))
