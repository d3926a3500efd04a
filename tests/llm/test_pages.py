"""WARC round trips and URL filters."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loadshift.llm import op4_warc as W
from loadshift.llm import op8_urls as U

r = random.Random(4)
LONG = "".join(r.choice("abc é😀\r\n\n") for _ in range(60_000))
PAGES = [
    (5, "http://a.net/x", "<p>" + "same " * 40), (3, "https://a.net/y", "<p>" + "same " * 40), (9, None, "<p>" + "same " * 40),
    (3, "https://a.net/y", "<p>" + "same " * 40),                                 # the smallest id again
    (1, "http://b.org/", None), (2, "http://b.org/", ""), (4, "no scheme", "short"), (6, "http://c", "short"),
    (7, "http://d.com/\r\nX-Evil: 1", LONG), (8, "http://d.com/2", LONG + "!"), (None, "http://e.com", "<p>" + "same " * 40),
    (None, "http://f.com", "lonely " * 30), (10, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9), (11, "v", "x" * 99),
    (12, "w", "x" * 99), (13, "e", "é" * 50), (14, "e", "é" * 50),
]


def expected():
    out, first = [], {}
    for i, _, html in PAGES:
        p = (html or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    for i, url, html in PAGES:
        p = (html or "").encode()
        ref = first.get(p)
        again = ref is not None and i != ref
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", ref if again else None))
    return out


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in PAGES],
                                 "page_id long, url string, html string, digest string, n_bytes int").repartition(3)


def key(row):
    return tuple((x is None, str(x)) for x in row)


def test_round_trip(pages, spark, out_dir):
    W.write_archives(pages, out_dir + "/warc")
    got = W.read_archives(spark, out_dir + "/warc")
    rows = [(None if x.page_id is None else int(x.page_id), x.payload_bytes, x.payload_digest, x.record_type,
             None if x.refers_to is None else int(x.refers_to)) for x in got.collect()]
    assert sorted(rows, key=key) == sorted(expected(), key=key)
    assert got.where("NOT ok").count() == 0
    payloads = {x.page_id: bytes(x.payload) for x in got.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert all(payloads[str(i)] == (h or "").encode() for i, _, h in PAGES if str(i) in payloads) and len(payloads) >= 9


def test_segments(pages, spark, out_dir):
    W.write_archives(pages, out_dir + "/warc")
    records = W.read_records(spark, out_dir + "/warc")
    parts = records.where("segment IS NOT NULL")
    assert parts.where("record_type = 'continuation'").count() > 10
    assert parts.where(F.octet_length("block") > W.SEGMENT_BYTES).count() == 0
    # a lost segment, a lost end: the record is refused, not shortened
    broken = W.reassemble(parts.where("segment <> 3"))
    assert broken.where("block IS NOT NULL").count() == 0 and broken.count() == 2
    no_end = parts.where("total_length IS NULL")
    assert W.reassemble(no_end).where("block IS NOT NULL").count() == 0


def test_a_long_page_is_linear(spark, out_dir):
    """A page of 24 MB in many segments comes back whole, in seconds."""
    import time
    page = "0123456789abcdef" * (3 << 19)
    df = spark.createDataFrame([(1, "http://a/", page), (2, "http://b/", page)], "page_id long, url string, html string")
    began = time.time()
    path = W.write_archives(df, f"{out_dir}/long")
    back = {r.page_id: (r.n, r.record_type, r.ok) for r in W.read_archives(spark, path).select(
        "page_id", F.octet_length("payload").alias("n"), "record_type", "ok").collect()}
    assert back == {"1": (len(page), "response", True), "2": (None, "revisit", True)}
    assert time.time() - began < 90


def test_empty_pages(pages, spark, out_dir):
    W.write_archives(pages.where("page_id > 1000"), out_dir + "/warc")
    assert W.read_archives(spark, out_dir + "/warc").count() == 0


@pytest.mark.parametrize("payload", [b"", b"a", b"x" * W.CHUNK_BYTES, b"y" * (3 * W.CHUNK_BYTES + 1), "é😀\r\n0\r\n\r\n".encode() * 700])
def test_chunked_framing(payload):
    framed = W._frame(payload)
    assert W.unchunk(framed) == payload
    assert W.unchunk(framed[:-3]) is None and W.unchunk(b"zz\r\n" + framed) is None


def test_archives_of_several_gzip_members():
    import gzip
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi"
    one = W._record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), ("X-Page-ID", 1)], block) + b"\r\n\r\n"
    rows = list(W.parse_archive(gzip.compress(one) + gzip.compress(one.replace(b"<a>", b"<b>"))))
    assert [x[0] for x in rows] == ["<a>", "<b>"] and rows[1][-1] == block
    assert W.payload_of(block) == (b"hi", 2)


URLS = [
    ("http://x.net/a", "net/", "block"), ("http://NET/", "net/", "block"), ("http://x.net", None, "allow"),
    ("http://x.example.net/en/1", "example.net/en/", "allow"), ("https://example.net/de/", "net/", "block"),
    ("https://sub.EXAMPLE.com/de/?q", "example.com/de/", "block"), ("https://example.com/de", None, "allow"),
    ("http://notexample.com/de/1", None, "allow"), ("http://a.org/fr/x#y", "org/fr/", "allow"), ("http://a.org?/fr/", None, "allow"),
    (None, None, "allow"), ("", None, "allow"), ("x.net/", None, "allow"), ("http://a.net:80/", None, "allow"),
    ("http://spam.example.com/p?b=1&a=2&utm_source=z", None, "block"), ("https://www.spam.example.com/p/?a=2&b=1#f", None, "block"),
    ("http://spam.example.com/p?a=2", None, "allow"), ("http://spam.example.com/q", None, "allow"),
    ("ftp://u?x://y.net/", None, "allow"),
]


def test_urls(spark):
    data = [(i, u, "h", "p", "c") for i, (u, _, _) in enumerate(URLS)] + [(None, "http://x.net/a", "h", "p", "c")] * 2
    pages = spark.createDataFrame(data, "page_id long, url string, host string, path string, _canon string")
    listed = spark.createDataFrame([("http://spam.example.com/p/?a=2&b=1",), (None,), ("",)], "url string")
    got = U.judge(pages, listed).collect()
    assert len(got) == len(data)
    by = {x.page_id: x for x in got if x.page_id is not None}
    for i, (u, rule, verdict) in enumerate(URLS):
        assert (by[i].rule, by[i].verdict) == (rule, verdict), u
    assert (by[5].host, by[5].path) == ("sub.example.com", "/de/") and (by[9].host, by[9].path) == ("a.org", "")
    assert (by[10].host, by[10].path) == ("", "") and (by[18].host, by[18].path) == ("u", "")


def test_bloom_filter_passes_every_listed_url_and_few_others(spark):
    listed = spark.range(3000).select(F.concat(F.lit("http://h.com/l"), "id").alias("url"))
    pages = spark.range(9000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://www.h.com/l"), "id", F.lit("/")).alias("url"))
    got = U.judge(pages, listed).cache()
    assert got.where("listed").count() == 3000 and got.where("listed <> (page_id < 3000)").count() == 0
    assert got.where("maybe_listed AND NOT listed").count() < 100
    nothing = U.judge(pages, listed.where("url IS NULL"))
    assert nothing.where("listed OR maybe_listed").count() == 0 and nothing.count() == 9000
    assert U.judge(pages.where("page_id < 0"), listed).count() == 0


def test_junk_hosts_are_listed_by_the_words_of_their_labels(spark):
    urls = ["http://m.casino-win.example.com/a", "https://free-bets.example.org/", "http://www.spam-farm.example.com/x",
            "http://cheap-pills.example.com/", "http://casinos.example.com/", "http://example.com/casino/", "http://spammer.com/", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert sorted(x.url for x in U.spam_urls(pages).collect()) == sorted(urls[:4])
