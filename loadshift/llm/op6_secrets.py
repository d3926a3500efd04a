"""Operator 6: secret scans with corpus-wide ownership frequency.

Candidates are the matches of the base patterns (assignments, access keys, hex strings) and
other long mixed tokens. Their hashes are aggregated over the corpus by distinct
repositories and owners: a value that more than ``MAX_LIVE_OWNERS`` owners and
``MAX_LIVE_SHARE`` of all owners hold, each in a text of its own, is a widely copied example. One that
stays with fewer and looks random is live, in however many of their repositories; copies of one
text count as one owner, so a copied document still shows its secret. Assignments and access keys are
told by their keyword or prefix, whatever their characters; hex strings and mixed tokens
look random by their entropy per character, which needs no minimal length. The method adds the live mixed
tokens to the base spans; the base spans stay whatever their verdict, which is reported
beside them.

All work is DataFrame expressions. Only candidate rows (hash, owner, repository, offsets),
never texts, are shuffled; distinct counts are pre-aggregated and the verdicts come back by
a join that deals a hot value out by repository.

Defined cases: a null text has no spans and counts as the empty text. A null owner or
repository is one more owner or repository. Rows that repeat an id and a text are the same
repository; each gives its row. An empty table gives no rows. Other input columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

# kind, pattern (possessive where greedy cannot back off, so no match is quadratic), and
# the substrings of which one must occur.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)""")
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{32,}+"
# Unquoted long tokens of the URL-safe and standard base-64 alphabets, by the method alone.
MIXED = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+"
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex")
MIN_ASSIGN, MIN_ACCESS = 8, 16
# The method's parameters.
MAX_LIVE_OWNERS = 2              # a value that more owners hold in texts of their own is a copied example,
MAX_LIVE_SHARE = 0.05            # if they are also more than this share of all owners
MIN_BITS_PER_CHAR = 2.5          # "looks random", of hex strings and mixed tokens

SPAN = "struct<start:bigint,end:bigint,kind_order:int,kind:string,value:string>"


def base_spans(text: Column) -> Column:
    """The base spans of a text, by start and then kind."""
    lowered = F.lower(text)
    keyword = F.lit(False)
    for k in KEYWORDS:
        keyword = keyword | F.contains(lowered, F.lit(k))
    assign = F.filter(C.find_spans(text, ASSIGN, keyword),
                      lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= MIN_ASSIGN)
    access = F.filter(C.find_spans(text, ACCESS, F.contains(text, F.lit("AKIA"))),
                      lambda s: F.length(s["value"]) >= MIN_ACCESS)
    hexes = C.find_spans(text, HEX, text.rlike("[0-9a-f]{32}"))
    return F.array_sort(F.concat(*[C.with_kind(s, k, i) for i, (k, s) in enumerate(
        zip(KINDS, (assign, access, hexes), strict=True))]))


def mixed_spans(text: Column) -> Column:
    """Long tokens with upper-case and lower-case letters and digits."""
    found = C.find_spans(text, MIXED, text.rlike("[A-Za-z0-9+/_-]{24}"))
    return C.with_kind(F.filter(found, lambda s: s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]")
                                & s["value"].rlike("[0-9]")), "mixed", len(KINDS))


def secret_value(kind: Column, value: Column) -> Column:
    """What is compared across owners: of an assignment the value, without its keyword."""
    return F.when(kind == "assign", F.regexp_extract(value, ASSIGN, 2)).otherwise(value)


def bits_per_char(value: Column) -> Column:
    """Entropy of the characters of a value, in bits."""
    n = F.length(value)
    share = lambda c: (n - F.length(F.replace(value, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.filter(F.split(value, ""), lambda c: c != "")), F.lit(0.0),
                       lambda total, c: total - share(c) * F.log2(share(c)))


def looks_random(kind: Column, value: Column) -> Column:
    return kind.isin("assign", "access") | (bits_per_char(value) >= MIN_BITS_PER_CHAR)


def candidates(docs: DataFrame, repo_col: str, owner_col: str, text_col: str) -> DataFrame:
    """One narrow row per document: key, owner and candidate spans with value hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = F.concat(base_spans(text), mixed_spans(text))
    hashed = F.transform(spans, lambda s: C.let(secret_value(s["kind"], s["value"]), lambda v: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind_order"].alias("kind_order"),
        s["kind"].alias("kind"), C.sha256_hex(v).alias("hash"), looks_random(s["kind"], v).alias("random"))))
    return docs.select(F.col(repo_col).alias("repo"), F.col(owner_col).cast("string").alias("owner"),
                       F.xxhash64(text).alias("text_hash"), hashed.alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos, n_texts): distinct owners, repositories and texts of every candidate.
    Copies of one text belong to one owner, the first by name: whoever copies a document shows
    its secret, but does not hold it. The counts first drop repeats within each task, then deal by
    (hash, text, owner or repository)."""
    rows = found.where(F.size("spans") > 0).select(
        F.coalesce("owner", F.lit("\u0000")).alias("owner"), F.coalesce(F.col("repo").cast("string"), F.lit("\u0000")).alias("repo"),
        "text_hash", F.explode("spans.hash").alias("hash"))
    texts = rows.groupBy("hash", "text_hash").agg(F.min("owner").alias("owner"))
    owners = texts.select("hash", F.lit("owner").alias("what"), F.col("owner").alias("who")).distinct()
    repos = rows.select("hash", F.lit("repo").alias("what"), F.col("repo").alias("who")).distinct()
    each = texts.select("hash", F.lit("text").alias("what"), F.lit("").alias("who"))
    count = lambda what: F.count(F.when(F.col("what") == what, 1))
    return owners.unionByName(repos).unionByName(each).groupBy("hash").agg(
        count("owner").alias("n_owners"), count("repo").alias("n_repos"), count("text").alias("n_texts"))


def scan(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source",
         text_col: str = "text") -> DataFrame:
    """(repo, text_hash, base, spans, live): base spans, all spans, and the live ones, as
    arrays by start and then kind. One row per document."""
    found = C.materialise(candidates(docs, repo_col, owner_col, text_col), "secret_candidates")
    owners = C.materialise(ownership(found), "secret_owners")
    # verdicts: one row per candidate, a widely copied value dealt out by repository
    each = (found.where(F.size("spans") > 0).select("repo", "text_hash", F.explode("spans").alias("s")).distinct()
            .withColumn("hash", F.col("s.hash")))
    judged = C.keyed_join(each, owners, ["hash"], F.struct("repo", "text_hash", "s.start"))
    n_all = found.select("owner").distinct().count()
    live = F.col("s.random") & (F.col("n_owners") <= max(MAX_LIVE_OWNERS, MAX_LIVE_SHARE * n_all))
    span = F.struct("s.start", "s.end", "s.kind_order", "s.kind", live.alias("live"))
    verdicts = (judged.groupBy("repo", "text_hash").agg(F.array_sort(F.collect_list(span)).alias("all"))
                .withColumnsRenamed({"repo": "_repo", "text_hash": "_text_hash"}))
    none = found.where(F.size("spans") == 0).select("repo", "text_hash", F.array().cast(
        "array<struct<start:bigint,end:bigint,kind_order:int,kind:string,live:boolean>>").alias("all"))
    some = found.where(F.size("spans") > 0).select("repo", "text_hash").join(
        verdicts, F.col("repo").eqNullSafe(F.col("_repo")) & (F.col("text_hash") == F.col("_text_hash"))
    ).select("repo", "text_hash", "all")
    is_base = lambda s: s["kind_order"] < len(KINDS)
    return none.unionByName(some).select(
        "repo", "text_hash", F.filter("all", is_base).alias("base"),
        F.filter("all", lambda s: is_base(s) | s["live"]).alias("spans"),
        F.filter("all", lambda s: s["live"]).alias("live"))


def redact(docs: DataFrame, mask: str = "[SECRET]", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """``docs`` with the live secrets of ``text`` replaced by ``mask``; widely copied
    examples stay. Documents without a live secret pass unchanged and unshuffled."""
    hits = C.materialise(scan(docs, repo_col, owner_col).where(F.size("live") > 0)
                         .select(F.col("repo").alias("_id"), F.col("text_hash").alias("_hash"),
                                 F.transform("live", lambda s: F.struct(
                                     s["start"].alias("start"), s["end"].alias("end"), F.lit(mask).alias("mask")
                                 )).alias("_live"))
                         .dropDuplicates(["_id", "_hash"]), "secret_hits")
    joined = C.by_document(docs, hits, repo_col, "text")
    text, none = F.col("row").getField("text"), F.col("_live").isNull()
    changed = {"text": F.when(none, text).otherwise(C.mask_spans(text, F.col("_live")))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(none, F.col("row").getField("n_chars")).otherwise(
            F.length(changed["text"]).cast("long"))
    return C.unpack(joined, docs.columns, **changed)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a document is a repository, its source the owner."""
    found = scan(C.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(F.col("repo").alias("doc_id"), *[count(k) for k in KINDS],
                        C.sha256_hex(C.span_digest_text(F.col("base"))).alias("base_sha256"),
                        C.span_digest_text(F.col("spans")).alias("spans"),
                        F.size("live").cast("long").alias("n_live"))
