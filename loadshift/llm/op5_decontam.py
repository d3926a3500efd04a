"""Operator 5: benchmark decontamination by winnowing.

A fingerprint of a text is the minimum hash of each run of ``GUARANTEE - K + 1`` consecutive
K-grams of words. Two texts that share ``GUARANTEE`` consecutive words share the K-grams of
that span, so they share its minimum: no span of that length is missed. Documents whose
fingerprints meet the benchmark's are joined with their text again; every window that a hit
can extend to is compared with the benchmark's windows word by word, so nothing is reported
on a hash alone.

Items shorter than ``GUARANTEE`` words are one window each; they are looked up by the hash
of that many words, for the lengths that the benchmark has.

All work is DataFrame expressions. The benchmark's tables are broadcast when their counted
rows allow it and shuffled otherwise; documents without a hit are never shuffled.

Defined cases: a null or wordless text has no words and no hit; a null or wordless item has
no window. Rows that repeat an item id are one item; a null item id is listed as the empty
string. Rows that repeat a document each give a row. Empty tables give no rows or no hits.
Other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

GUARANTEE = 10                   # words of a window, and of the shortest span surely found
K = 5                            # words of a hashed gram
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _split(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case."""
    return _split(C.ascii_lower(text))


def folded_words(text: Column) -> Column:
    """The words in full lower case: equal words stay equal, boundaries stay where they are.
    Much faster than :func:`words`; for fingerprints, which may agree too often."""
    return _split(F.replace(F.lower(text), F.lit("ς"), F.lit("σ")))


def _fold(base: Column, n: int, combine) -> Column:
    """``combine`` over the n elements from every position on, by doubling: arrays are zipped
    with themselves, shifted, so each step touches an element once. The last n - 1 positions
    have no n elements and are to be cut off."""
    def zipped(a, b, shift):
        return F.zip_with(a, F.slice(b, shift + 1, F.size(b)), lambda x, y: combine(x, y))

    def grow(have: dict[int, Column]) -> Column:
        width = max(have)
        if 2 * width <= n:
            return C.let(zipped(have[width], have[width], width), lambda x: grow({**have, 2 * width: x}))
        out, done = have[width], width
        for part in sorted(have, reverse=True)[1:]:
            if (n - done) & part:
                out, done = zipped(out, have[part], done), done + part
        return out

    return C.let(base, lambda x: grow({1: x}))


def window_hashes(folded: Column, length: int) -> Column:
    """For every window of ``length`` words the hash by which it is looked up: the winnowed
    minimum for windows of GUARANTEE words, the hash of all its words for shorter ones."""
    hashes = F.transform(folded, lambda w: F.xxhash64(w))
    if length < GUARANTEE:
        each = _fold(hashes, length, F.xxhash64)
    else:
        each = _fold(_fold(hashes, K, F.xxhash64), GUARANTEE - K + 1, F.least)
    return F.slice(each, F.lit(1), F.greatest(F.size(folded) - length + 1, F.lit(0)))


def _windows(ws: Column, starts: Column, length: int) -> Column:
    return F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.lit(length).alias("length"),
        F.array_join(F.slice(ws, s + 1, F.lit(length)), " ").alias("window")))


def _text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, length, print, items): every distinct window with its fingerprint and items."""
    base = (items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .select("item", words(F.col("text")).alias("ws"), folded_words(F.col("text")).alias("fs"))
            .where(F.size("ws") > 0))
    parts = []
    for length in range(1, GUARANTEE + 1):
        own = base.where(F.size("ws") == length) if length < GUARANTEE else base.where(F.size("ws") >= GUARANTEE)
        each = _windows(F.col("ws"), F.sequence(F.lit(0), F.size("ws") - length), length)
        both = F.arrays_zip(each.alias("w"), window_hashes(F.col("fs"), length).alias("print"))
        parts.append(own.select("item", F.explode(both).alias("x")).select(
            F.col("x.w.window").alias("window"), F.col("x.w.length").alias("length"),
            F.col("x.print").alias("print"), "item"))
    all_parts = parts[0]
    for p in parts[1:]:
        all_parts = all_parts.unionByName(p)
    return all_parts.groupBy("window", "length", "print").agg(F.collect_set("item").alias("items"))


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, start, length, items): every document window that is a benchmark
    window, in word positions. Repeated rows of a document count once here."""
    bench = C.materialise(benchmark_windows(items), "bench_windows")
    # at most GUARANTEE small numbers
    lengths = sorted(r[0] for r in bench.select("length").distinct().collect())
    keyed = _text(docs, id_col, text_col)
    # 1. fingerprints of all documents against those of the benchmark
    prints = C.materialise(bench.select("print").distinct(), "bench_prints")
    looked_up = C.let(folded_words(F.col("text")), lambda fs: F.array_distinct(
        F.concat(*[window_hashes(fs, n) for n in lengths]))) if lengths else F.array().cast("array<bigint>")
    mine = keyed.select("doc_id", "text_hash", F.explode(looked_up).alias("print"))
    small = C.small_side(prints)
    hits = (mine.join(small if small is not None else prints, "print", "left_semi")
            .groupBy("doc_id", "text_hash").agg(F.collect_set("print").alias("prints"))
            .withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}))
    hits = C.materialise(hits, "bench_hits")
    # 2. the documents with hits: every window that a hit lies in, compared word by word
    small = C.small_side(hits)
    texts = keyed.join(small if small is not None else hits,
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    texts = texts.select("doc_id", "text_hash", "prints", words(F.col("text")).alias("ws"),
                         folded_words(F.col("text")).alias("fs"))

    def extended(length: int) -> Column:
        def at(hashes):
            spots = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1),
                             lambda i: F.array_contains(F.col("prints"), F.get(hashes, i)))
            return F.when(F.size(hashes) > 0, spots).otherwise(F.array().cast("array<int>"))
        return C.let(F.col("ws"), lambda ws: _windows(ws, C.let(window_hashes(F.col("fs"), length), at), length))

    if not lengths:
        texts, extend = texts.limit(0), F.array().cast("array<struct<start:int,length:int,window:string>>")
    else:
        extend = F.concat(*[extended(n) for n in lengths])
    spans = texts.select("doc_id", "text_hash", F.explode(extend).alias("w")).select(
        "doc_id", "text_hash", F.col("w.start").alias("start"), F.col("w.length").alias("length"), "w.window")
    known = bench.select("window", "length", "items")
    small = C.small_side(known)
    return spans.join(small if small is not None else known, ["window", "length"]).drop("window").distinct()


def judge(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its words, hit words and the items that it contains."""
    found = find(docs, items, id_col, text_col)
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def cover(acc, s):  # spans by start: words beyond the end reached so far
        end = F.greatest(acc["end"], s["start"] + s["length"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], F.least(end, s["start"]))).alias("n"))

    per_doc = (found.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
                F.aggregate("spans", zero, cover, lambda acc: acc["n"]).alias("n_hit"), "item_ids"))
    per_doc = C.materialise(per_doc, "bench_per_doc")
    small = C.small_side(per_doc)
    n_words = F.regexp_count("text", F.lit(ANY_CASE_WORD)).cast("long")
    keyed = _text(docs, id_col, text_col).select("doc_id", "text_hash", n_words.alias("n_words"))
    out = keyed.join(small if small is not None else per_doc,
                     F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a benchmark window; the columns of ``docs``."""
    bad = C.materialise(find(docs, items).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
                        .distinct(), "bench_bad")
    return C.unpack(C.by_document(docs, bad, "doc_id", "text", "left_anti"), docs.columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark."""
    found = judge(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        C.sha256_hex(F.array_join("item_ids", ",")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
