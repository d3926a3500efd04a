"""Operator 3: quality rules, line first.

Every line of a document is judged by punctuation, navigation and boilerplate rules;
failing lines are removed, and a document that loses too much of its text is rejected.
Independently a base verdict rejects documents that are too short or repeat themselves.

Rules, per line with a word (a blank line neither fails nor counts):

* punctuation: too large a share of symbols or exclamation marks, or no letter at all, or a
  short line that no sentence mark ends;
* navigation: separators (``|``, ``>``, a bullet) between parts of a few words;
* boilerplate: a set phrase (rights, licences, cookies), or the same line seen before in
  the text.

Defined cases: a null text has no words and no lines; it and an empty text fail the base
rules. Repeated rows each give a row. An empty table gives no rows. Work per document is
linear in its length, whole texts only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

WINDOW = 5                       # words in a window that may repeat
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
SEPARATORS = "|>»•·"
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "we use cookies", "accept cookies", "enable javascript",
    "requires javascript", "lorem ipsum", "subscribe to our newsletter", "skip to content",
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the document verdict."""
    max_symbol_share: float = 0.05     # of a line's characters without blanks
    max_bang_share: float = 0.08
    min_unended_words: int = 4         # fewer words need a sentence mark at the end
    max_part_words: int = 3            # words between two separators of a navigation line
    min_separators: int = 2
    min_short_parts: float = 0.7
    max_lost_share: float = 0.4        # of the text's characters in lines with a word


STATS_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                "base_failed boolean, kept boolean, n_lines long, n_punctuation long, n_navigation long, "
                "n_boilerplate long, lost_share double, clean_text string")


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more. Windows are
    compared exactly: as numbers in base (distinct words), or as rows where those overflow."""
    if len(words) <= window:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    number = np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=len(words))
    grams = np.lib.stride_tricks.sliding_window_view(number, window)
    if len(ids) ** window < 2 ** 63:
        grams = grams @ (len(ids) ** np.arange(window, dtype=np.int64))
    else:
        grams = np.ascontiguousarray(grams).view([("", np.int64)] * window).ravel()
    distinct, which, counts = np.unique(grams, return_inverse=True, return_counts=True)
    if len(distinct) == len(grams):
        return 0
    starts = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def line_fault(line: str, n_words: int, repeated: bool, rules: LineRules, phrases: list[str]) -> str | None:
    """The rule that a line with words breaks, or None. ``phrases``: the set phrases that
    occur in the text at all."""
    chars = len(line) - sum(line.count(c) for c in BLANKS)
    if sum(line.count(c) for c in SYMBOLS if c != "|") > rules.max_symbol_share * chars:
        return "punctuation"
    if line.count("!") > max(3, rules.max_bang_share * chars):
        return "punctuation"
    if any(c in line for c in SEPARATORS):
        parts = re.split(f"[{SEPARATORS}]", line)
        short = sum(len(p.split()) <= rules.max_part_words for p in parts)
        if len(parts) > rules.min_separators and short >= rules.min_short_parts * len(parts):
            return "navigation"
    if repeated or (phrases and any(p in line.lower() for p in phrases)):
        return "boilerplate"
    ended = line.rstrip(BLANKS + "\"'”’)»]").endswith((".", "!", "?", "…", ":", ";", "。"))
    if not any(c.isalpha() for c in line) or (not ended and n_words < rules.min_unended_words):
        return "punctuation"
    return None


def judge_text(text: str | None, rules: LineRules) -> tuple:
    """The columns of STATS_SCHEMA for one whole text. Words are split on bytes, whose white
    space is exactly the six separators."""
    text = text or ""
    lowered = text.lower()
    phrases = [p for p in BOILERPLATE if p in lowered]
    words: list[bytes] = []
    seen: set[str] = set()
    kept_lines: list[str] = []
    faults = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    lines = dup_lines = total = lost = 0
    for line in text.split("\n"):
        own = line.encode("utf-8", "surrogatepass").split()
        if own:
            lines += 1
            total += len(line)
            repeated = line in seen
            dup_lines += repeated
            seen.add(line)
            words += own
            if fault := line_fault(line, len(own), repeated, rules, phrases):
                faults[fault] += 1
                lost += len(line)
                continue
        kept_lines.append(line)
    n, repeats = len(words), repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    share = lost / total if total else 1.0
    return (n, len(text) - sum(text.count(c) for c in BLANKS), sum(text.count(c) for c in SYMBOLS), dup_lines,
            repeats, failed, not failed and share <= rules.max_lost_share, lines, faults["punctuation"],
            faults["navigation"], faults["boilerplate"], share, "\n".join(kept_lines))


def judge(docs: DataFrame, rules: LineRules = LineRules(), text_col: str = "text",
          keep_columns: tuple[str, ...] = ("doc_id",), clean_text: bool = True) -> DataFrame:
    """``keep_columns`` of every document with the columns of STATS_SCHEMA. One narrow pass:
    no shuffle."""
    schema = STATS_SCHEMA if clean_text else STATS_SCHEMA.rpartition(",")[0]
    names = [c.split()[0] for c in schema.split(", ")]

    def rows():
        return lambda texts: [judge_text(t, rules)[:len(names)] for t in texts]

    return C.map_rows(docs, list(keep_columns), [text_col], schema, rows)


def clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents with their failing lines removed; the columns of ``docs``."""
    others = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c not in ("text", "n_chars")}
    plain = docs.select("text", *[F.col(f"`{c}`").alias(x) for c, x in others.items()])
    out = judge(plain, rules, keep_columns=tuple(others.values())).where("kept")
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return out.select(*[(F.col(others[c]) if c in others else new[c]).alias(c) for c in docs.columns])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by the base rules and the line rules."""
    return judge(C.table(spark, sf_dir, "documents"), clean_text=False)
