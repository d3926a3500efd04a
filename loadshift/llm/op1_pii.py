"""Operator 1: information-theoretic sanitisation of personal data.

The base patterns find protected entities (e-mail, IP, card and phone numbers). Corpus
co-occurrence then estimates how strongly the words of its documents reveal it:

* entities are judged by themselves where they stand in two documents or more, and by their
  group always: the domain of an e-mail, the network of an address, the prefix of a phone or
  card number. An entity of one document can so be revealed by the terms of its group;
* n(t): documents with term t, n(x, t): documents that hold both t and entity or group x, at any
  distance. Copies of one text are one document: they are no independent evidence;
* the term discloses log2(n(x, t) N / (n(x) n(t))) bits of x (pointwise mutual information);
* what x keeps, given the term, is -log2 p(x | t) bits. p is the lower confidence bound (Wilson,
  ``CONFIDENCE_Z``) of n(x, t) / n(t), and one document is no evidence: chance alone puts
  every rare word of a text beside every rare entity of it. Two documents of two leave 0.9 bits;
* a term that is part of an e-mail's own name (before the @) counts as ``NAME_DOCS`` further
  documents with both, so that a name seen nowhere else is found at its first address, while an
  everyday word in the name is not.

A term that discloses at least ``MIN_DISCLOSED_BITS`` and leaves an entity at most ``REMOVE_BITS`` is
removed; one that leaves an entity or a group at most ``GENERALISE_BITS`` is generalised, wherever it
stands in a document that mentions the entity. Documents without an entity stay as they are.
Terms are words of ``MIN_TERM_LETTERS`` letters or more.

All work is DataFrame expressions. The patterns run over every text once; its narrow result (spans,
entities, and terms where there are entities) is written. Pairs of one document only
are dropped after a pre-aggregated count, and so are terms too common in the documents with
entities themselves, before the corpus is read again for n(t) of the terms that are left. Words of
a text meet their verdicts by a join, so the work is linear in the text.

Defined cases: a null text is the empty text, without spans. Repeated rows and copies of a
text are one document in the counts; each row gives its row. Null ids are ids like others. An
empty table gives no rows. Other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

# Patterns whose classes cannot back off are possessive; an e-mail starts where its run of
# local-part characters starts, or where the last match ended. The matches are those of the
# plain greedy patterns.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"^0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")

MIN_TERM_LETTERS = 3
CONFIDENCE_Z = 1.28              # one-sided 90 %
MIN_DOCS = 2                     # documents with both, for co-occurrence to be evidence
NAME_DOCS = 3                    # weight of a term that is part of the entity's own name, in documents
MIN_DISCLOSED_BITS = 4.0
GENERALISE_BITS = 2.0
REMOVE_BITS = 1.0
TERM = r"\p{L}++"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _checks(text: Column):
    """(kind, pattern, cheap necessary condition, check of a match)."""
    n_digits = lambda v: F.length(_digits(v))
    return (
        ("email", EMAIL, F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        ("ip", IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
         lambda v: F.forall(F.split(v, r"\."), lambda p: p.rlike(BYTE))),
        ("card", CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
         lambda v: n_digits(v).between(16, 19) & F.when(n_digits(v) <= 19, F.call_function("luhn_check", _digits(v)))),
        ("phone", PHONE, F.contains(text, F.lit("+")), lambda v: n_digits(v).between(8, 15)),
    )


def base_spans(text: Column) -> Column:
    """The base spans of a text, by kind and then start."""
    def of(order, kind, pattern, cheap, ok):
        return C.with_kind(F.filter(C.find_spans(text, pattern, cheap), lambda s: ok(s["value"])), kind, order)

    return F.concat(*[of(i, *check) for i, check in enumerate(_checks(text))])


def keys_of(spans: Column) -> Column:
    """The distinct (key, whole) of base spans: normalised entities (whole), and the groups they
    belong to."""
    def of(s):
        v, k = s["value"], s["kind"]
        digits = F.regexp_replace(v, "[^0-9.]", "")
        own = F.concat(k, F.lit(":"), F.when(k == "email", C.ascii_lower(v)).otherwise(digits))
        group = (F.when(k == "email", F.concat(F.lit("domain:"), F.substring_index(C.ascii_lower(v), "@", -1)))
                 .when(k == "ip", F.concat(F.lit("network:"), F.substring_index(digits, ".", 3)))
                 .otherwise(F.concat(k, F.lit(" prefix:"), F.substring(digits, 1, 6))))
        return F.array(F.struct(own.alias("key"), F.lit(True).alias("whole")),
                       F.struct(group.alias("key"), F.lit(False).alias("whole")))

    return F.array_distinct(F.flatten(F.transform(spans, of)))


def terms(text: Column) -> Column:
    """The distinct lower-case words (runs of letters) of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda t: F.length(t) >= MIN_TERM_LETTERS))


SLIM = "array<struct<kind_order:int,start:bigint,end:bigint,kind:string>>"


def _slim(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind_order"].alias("kind_order"), s["start"].alias("start"),
                                                 s["end"].alias("end"), s["kind"].alias("kind")))


def _lower_bound(both: Column, n: Column) -> Column:
    """Wilson lower bound of both / n."""
    z2 = CONFIDENCE_Z ** 2
    spread = CONFIDENCE_Z * F.sqrt(both * (n - both) / n + z2 / 4)
    return (both + z2 / 2 - spread) / (n + z2)


def document_pairs(found: DataFrame, n_docs: int) -> DataFrame:
    """(copy, key, whole, n_key, term, named): the terms and keys that share a document; a term that is
    both beside a key and part of its name has a row for each. ``found`` has a row for
    each distinct text with entities: ``copy`` (its digest), ``keys`` and ``terms``. Keys that cannot be
    disclosed (of one document, but for names, or in too large a share of all) are left out. The parts
    of an e-mail's name are terms of its documents. Nothing but the keys is shuffled here."""
    held = found.select("copy", F.explode("keys").alias("k")).select("copy", "k.key", "k.whole")
    counts = C.materialise(held.groupBy("key").agg(F.count(F.lit(1)).alias("n_key"))
                           .where((F.col("n_key") <= n_docs / 2 ** MIN_DISCLOSED_BITS)
                                  & ((F.col("n_key") >= MIN_DOCS) | F.col("key").startswith("email:"))), "pii_keys")
    kept = (C.keyed_join(held, counts, ["key"], F.col("copy")).groupBy("copy")
            .agg(F.collect_list(F.struct("key", "whole", "n_key")).alias("held")))
    near = C.materialise(found.select("copy", "terms").join(kept, "copy"), "pii_near")
    columns = ["copy", "h.key", "h.whole", "h.n_key", "term"]
    beside = (near.select("copy", "terms", F.explode(F.filter("held", lambda h: h["n_key"] >= MIN_DOCS)).alias("h"))
              .select("copy", "h", F.explode("terms").alias("term")).select(*columns, F.lit(False).alias("named")))
    local = F.substring_index(F.substring(F.col("h.key"), len("email:") + 1, 1 << 30), "@", 1)
    names = (near.select("copy", F.explode(F.filter("held", lambda h: h["key"].startswith("email:"))).alias("h"))
             .select("copy", "h", F.explode(terms(local)).alias("term")).select(*columns, F.lit(True).alias("named")))
    return beside.unionByName(names)


def disclosing_terms(pairs: DataFrame, found: DataFrame, texts: DataFrame, n_docs: int) -> DataFrame:
    """(key, term, kind): the terms to generalise or remove. ``texts`` has the corpus as (text,
    weight), the weights of copies of one text adding up to one."""
    both = pairs.groupBy("key", "whole", "n_key", "term").agg(
        F.greatest(F.count_if("named"), F.count_if(~F.col("named"))).alias("n_both"), F.max("named").alias("named"))
    # n(t) in the documents with entities is at most n(t): a bound before the corpus is counted
    there = (found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_there")))
    prior = F.when(F.col("named"), NAME_DOCS).otherwise(0)
    least = F.lit(2.0 ** -GENERALISE_BITS)
    maybe = both.where((F.col("n_both") >= MIN_DOCS) | F.col("named")).join(there, "term", "left").where(
        F.col("n_there").isNull() | (F.col("n_both") + prior >= least * (F.col("n_there") + prior)))
    maybe = C.materialise(maybe.drop("n_there"), "pii_maybe")
    wanted = C.materialise(maybe.select("term").distinct(), "pii_terms")
    words = texts.select("weight", F.explode(terms(F.col("text"))).alias("term"))
    small = C.small_side(wanted)
    counted = (words.join(small if small is not None else wanted, "term", "left_semi").groupBy("term")
               .agg(F.round(F.sum("weight")).cast("long").alias("n_term")))
    counted = C.materialise(counted, "pii_counts")
    judged = C.keyed_join(maybe, counted, ["term"], F.col("key"), "left").withColumn(
        "n_term", F.greatest("n_term", "n_both"))
    kept = -F.log2(_lower_bound(F.col("n_both") + prior, F.col("n_term") + prior))
    disclosed = F.log2(F.col("n_both") / F.col("n_term")) - F.log2(F.col("n_key") / F.lit(float(max(n_docs, 1))))
    kind = F.when(F.col("whole") & (kept <= REMOVE_BITS), "remove").when(kept <= GENERALISE_BITS, "generalise")
    return judged.select("key", "term", F.when(disclosed >= MIN_DISCLOSED_BITS - 1e-9, kind).alias("kind")).where(
        F.col("kind").isNotNull())


def words_outside(text: Column) -> Column:
    """The words of a text that do not overlap an e-mail (the other base spans have no letters):
    both are found in one pass, and a word that goes on into an e-mail, or out of one, is dropped."""
    both = C.find_spans(text, rf"{EMAIL}|(?:(?!{EMAIL})\p{{L}})++", F.lit(True))
    mail = lambda s: F.contains(s["value"], F.lit("@"))

    def apart(spans):
        def alone(s, i):
            before, after = F.get(spans, i - 1), F.get(spans, i + 1)
            goes_on = mail(after) & (after["start"] == s["end"]) & after["value"].rlike("^[A-Za-z]")
            came = mail(before) & (before["end"] == s["start"]) & before["value"].rlike("[A-Za-z]$")
            return ~mail(s) & ~F.coalesce(goes_on, F.lit(False)) & ~F.coalesce(came, F.lit(False))
        return F.filter(spans, alone)

    return C.let(both, apart)


def term_spans(texts: DataFrame, flagged: DataFrame) -> DataFrame:
    """(copy, added): the flagged terms of the texts (copy, text) outside their base spans, by kind
    and then start. ``flagged`` (copy, term, kind) is a written table. Texts whose flagged terms
    stand in their addresses only are not cut into words."""
    by_text = C.materialise(flagged.groupBy("copy").agg(F.collect_set("term").alias("flagged")), "pii_by_text")
    few = C.small_side(by_text)
    some = texts.join(few if few is not None else by_text, "copy").where(
        F.arrays_overlap(terms(F.regexp_replace("text", F.lit(EMAIL), F.lit(" "))), F.col("flagged")))
    words = (some.select("copy", F.explode(words_outside(F.col("text"))).alias("s"))
             .select("copy", F.lower("s.value").alias("term"), "s.start", "s.end"))
    order = F.when(F.col("kind") == "generalise", len(KINDS)).otherwise(len(KINDS) + 1)
    span = F.struct(order.alias("kind_order"), "start", "end", "kind")
    return (C.keyed_join(words, flagged, ["copy", "term"], F.col("start")).groupBy("copy")
            .agg(F.array_sort(F.collect_set(span)).cast(SLIM).alias("added")))  # copies of a text give the same spans


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, base, added): base spans and the method's spans, both by kind and
    then start. One row per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("copy"))
    spans = keyed.select("doc_id", "copy", F.xxhash64("text").alias("text_hash"), base_spans(F.col("text")).alias("spans"),
                         "text")
    some = F.size("spans") > 0
    base = C.materialise(spans.select(
        "doc_id", "copy", "text_hash", _slim(F.col("spans")).alias("base"),
        F.when(some, keys_of(F.col("spans"))).alias("keys"), F.when(some, terms(F.col("text"))).alias("terms")), "pii_base")
    found = C.materialise(base.where("keys IS NOT NULL").select("copy", "keys", "terms").dropDuplicates(["copy"]), "pii_found")
    copies = C.materialise(base.groupBy("copy").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1), "pii_copies")
    n_docs = base.count() - (copies.agg(F.sum(F.col("n_rows") - 1).alias("n")).first()["n"] or 0)
    pairs = document_pairs(found, n_docs)
    few = C.small_side(copies)
    weighted = keyed.join(few if few is not None else copies, "copy", "left").select(
        "text", (1 / F.coalesce("n_rows", F.lit(1))).alias("weight"))
    told = C.materialise(disclosing_terms(pairs, found, weighted, n_docs), "pii_disclosing")
    flagged = C.materialise(C.keyed_join(pairs.select("copy", "key", "term"), told, ["key", "term"], F.col("copy"))
                            .groupBy("copy", "term").agg(F.max("kind").alias("kind")), "pii_flagged")  # "remove" over "generalise"
    added = C.materialise(term_spans(keyed.select("copy", "text"), flagged), "pii_added")
    few = C.small_side(added)
    joined = base.select("doc_id", "copy", "text_hash", "base").join(few if few is not None else added, "copy", "left")
    return joined.select("doc_id", "text_hash", "base", F.coalesce("added", F.array().cast(SLIM)).alias("added"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced by its kind in brackets, generalised terms by
    ``[TERM]`` and removed terms by nothing. Documents without spans pass unshuffled when the
    others fit a broadcast."""
    mask = lambda k: F.when(k == "remove", F.lit("")).when(k == "generalise", F.lit("[TERM]")).otherwise(
        F.concat(F.lit("["), F.upper(k), F.lit("]")))
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), mask(s["kind"]).alias("mask"))))
    hits = C.materialise(find(docs, id_col, text_col).where(F.size("base") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), spans.alias("_spans"))
        .dropDuplicates(["_id", "_hash"]), "pii_hits")
    text = F.col("row").getField(text_col)
    joined = C.by_document(docs, hits, id_col, text_col)
    return C.unpack(joined, docs.columns, **{text_col: F.when(F.col("_spans").isNull(), text).otherwise(
        C.mask_spans(text, F.col("_spans")))})


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of all documents."""
    found = find(C.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS],
                        C.sha256_hex(C.span_digest_text(F.col("base"))).alias("base_sha256"),
                        C.span_digest_text(F.concat("base", "added")).alias("spans"),
                        F.size("added").cast("long").alias("n_terms"),
                        (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
