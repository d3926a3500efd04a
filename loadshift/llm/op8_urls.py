"""Operator 8: URL filters.

Host and path rules are judged first (the longest fitting rule wins). URLs that no rule
fits are looked up in a list of canonical URLs: a blocked Bloom filter passes possible
hits, and only those reach an exact hash join, which removes the false positives.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no
rule; it is never listed. Repeated rows each give a row. An empty page table gives no
rows, an empty list blocks nothing. Columns of the input other than the id and the URL
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

# (action, host and path prefix)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Words of host labels (parts between dots and hyphens) whose pages are put on the block list.
SPAM_WORDS = ("casino", "bets", "pills", "spam", "money", "deals")
# Query parameters that do not name a page.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"

BLOCK_BITS = 256                 # one block = four 64-bit words
WORDS = BLOCK_BITS // 64
BITS_PER_URL = 16
HASHES = 6
# 2^18 blocks x (8 + 4 x 8) bytes = 10 MB: the proven bound of the broadcast filter. With a
# longer list the filter passes more false positives; the exact join still removes them.
MAX_BLOCKS = 1 << 18


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query) of a URL; empty strings when it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = C.ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return host, path, query


def canonical(host: Column, path: Column, query: Column) -> Column:
    """Host without ``www.``, path without trailing slashes, query parameters sorted and
    without tracking; scheme and fragment dropped."""
    keep = F.array_sort(F.filter(F.split(query, "&"), lambda p: (F.length(p) > 0) & ~p.rlike(TRACKING)))
    tail = F.array_join(keep, "&")
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""),
                    F.when(tail == "", F.lit("")).otherwise(F.concat(F.lit("?"), tail)))


def _rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        at = text.index("/")
        r_host, r_path = text[:at], text[at:]
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def _parts(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    host, path, query = split_url(F.col("_url"))
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
            .select("page_id", host.alias("host"), path.alias("path"), query.alias("_query"))
            .withColumn("_canon", F.when(F.col("host") != "", canonical(F.col("host"), F.col("path"), F.col("_query"))))
            .drop("_query"))


def canonical_list(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The distinct canonical URLs of a list (one column, ``_canon``)."""
    return _parts(urls.select(F.lit(None).cast("long").alias("page_id"), F.col(url_col).alias("url")),
                  "page_id", "url").where(F.col("_canon").isNotNull()).select("_canon").distinct()


def _masks(n_blocks: int) -> list[Column]:
    """Block number and the bits of a URL in each of the block's words."""
    second = F.xxhash64(F.col("_canon"), F.lit(8))
    spots = [F.shiftrightunsigned(second, 8 * j).bitwiseAND(F.lit(BLOCK_BITS - 1).cast("long")) for j in range(HASHES)]
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    words = []
    for w in range(WORDS):
        mask = F.lit(0).cast("long")
        for p in spots:
            mask = mask.bitwiseOR(F.when(F.shiftright(p, 6) == w, bit(p)).otherwise(F.lit(0).cast("long")))
        words.append(mask.alias(f"_m{w}"))
    return [F.pmod(F.xxhash64("_canon"), F.lit(n_blocks)).alias("_block"), *words]


def blocked_bloom(listed: DataFrame, n_blocks: int) -> DataFrame:
    """One row per non-empty block: the or of the masks of its URLs."""
    return (listed.select(*_masks(n_blocks)).groupBy("_block")
            .agg(*[F.bit_or(f"_m{w}").alias(f"_f{w}") for w in range(WORDS)]))


def judge(pages: DataFrame, listed_urls: DataFrame, rules=RULES, id_col: str = "page_id",
          url_col: str = "url", list_col: str = "url") -> DataFrame:
    """Every page with its host, path, rule, verdict, whether the filter passed it
    (``maybe_listed``) and whether it is listed."""
    listed = C.materialise(canonical_list(listed_urls, list_col), "url_list")
    n_blocks = min(MAX_BLOCKS, max(1, -(-listed.count() * BITS_PER_URL // BLOCK_BITS)))
    filt = F.broadcast(blocked_bloom(listed, n_blocks))
    parts = _parts(pages, id_col, url_col)
    masked = parts.select("*", *_masks(n_blocks)).join(filt, "_block", "left")
    passed = F.col("_canon").isNotNull()
    for w in range(WORDS):
        passed = passed & (F.col(f"_m{w}").bitwiseAND(F.col(f"_f{w}")) == F.col(f"_m{w}"))
    tested = masked.select("page_id", "host", "path", "_canon", F.coalesce(passed, F.lit(False)).alias("maybe_listed"))
    # only possible hits are shuffled; a URL that many pages share is dealt out by page id
    sure = tested.where(~F.col("maybe_listed")).withColumn("listed", F.lit(False))
    hits = C.salted_join(tested.where("maybe_listed"), listed.withColumn("_in", F.lit(True)), ["_canon"],
                         F.col("page_id"), "left").withColumn("listed", F.coalesce("_in", F.lit(False))).drop("_in")
    rule, verdict = _rule(F.col("host"), F.col("path"), rules)
    other = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return sure.unionByName(hits).select("page_id", "host", "path", rule.alias("rule"),
                                         F.coalesce(verdict, other).alias("verdict"), "maybe_listed", "listed")


def spam_urls(pages: DataFrame, words=SPAM_WORDS) -> DataFrame:
    """The URLs of pages on junk hosts: those with a spam word as a part of a label. The list
    grows with the pages."""
    host, _, _ = split_url(F.col("url"))
    return pages.select("url").where(host.rlike(r"(^|[.-])(" + "|".join(words) + r")[.-]"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, then by the list of URLs on junk hosts."""
    pages = C.table(spark, sf_dir, "pages")
    return judge(pages, spam_urls(pages)).select("page_id", "host", "path", "rule", "verdict", "listed")


ORACLE_OP8 = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
  FROM parts),
canon AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'),
              lambda p: length(p) > 0 AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&') AS kept
  FROM split),
urls AS (
  SELECT page_id, host, path,
         CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
              || CASE WHEN coalesce(kept, '') = '' THEN '' ELSE '?' || kept END END AS c
  FROM canon),
listed AS (
  SELECT DISTINCT c FROM urls
  WHERE regexp_matches(host, '(^|[.-])(casino|bets|pills|spam|money|deals)[.-]')),
ruled AS (
  SELECT u.*, (l.c IS NOT NULL) AS listed,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM urls u LEFT JOIN listed l ON u.c = l.c)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block'
                 WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
                 ELSE CASE WHEN listed THEN 'block' ELSE 'allow' END END AS verdict,
       listed
FROM ruled
"""
