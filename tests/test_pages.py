import random
import time
from html.parser import HTMLParser
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from webglean.functions import html, urls
from webglean.functions.encodings import cap_and_decode
from webglean.functions.text import WHITESPACE, truncate_text
from webglean.operators import membership, pages
from webglean.sources.tables import as_responses

ARTICLE = """
<!doctype html><html lang="en"><head><title>Tides of the northern bay</title>
<script>window.countVisit("bay")</script></head>
<body><nav><ul><li>Start</li><li>Charts</li></ul></nav>
  <article>
    <h2>High water</h2>
    <p>The water rises twice a day.</p>
    <blockquote>Sailors say <p>never trust the moon</p> and wait.</blockquote>
  </article>
  <aside>Buy a boat</aside>
</body></html>
"""


def extracted(spark, *texts, max_chars=8000):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, html string")
    return [(r.title, r.text) for r in pages.extract_text(df, "html", max_chars).orderBy("id").collect()]


def test_article_page(spark):
    assert extracted(spark, ARTICLE) == [
        ("Tides of the northern bay",
         "High water\nThe water rises twice a day.\nSailors say\nnever trust the moon\nand wait.")
    ]


def test_text_behind_inner_blocks_and_nested_noise(spark):
    cases = [
        ("<ul><li>intro <p>para</p> tail text</li></ul>", "intro\npara\ntail text"),
        ("<blockquote>a <p>b</p> c</blockquote>", "a\nb\nc"),
        ("<ul><li>one <ul><li>two</li></ul> three</li></ul>", "one\ntwo\nthree"),
        ("<p>a</p> out </p></p> out <p>b</p>", "a\nb"),
        ("<nav><p>x</p> <nav>y</nav> <p>z</p></nav><p>a</p>", "a"),
        ("<aside><p>x</p> <form>y <aside>z</aside></form> <p>w</p></aside><p>a</p>", "a"),
        ("<p>a</p><nav>never closed <p>b</p>", "a\nb"),
        ("<article><p>one</p><article><p>reply</p></article><p>tail kept</p></article><p>out</p>", "one\nreply\ntail kept"),
        ("<article><p>open</p><article><p>in</p></article> <p>to the end</p>", "open\nin\nto the end"),
        ("</main><main><main></main><p>a</p></main><p>out</p>", "a"),
        ("<p>0</p></nav><nav><p>x</p></nav><p>1</p><form><nav></form><p>2</p><aside><p>y</p></aside></nav><p>3</p>", "0\n1\n2\n3"),
        ("<NAV>x<Svg/></nav><p>a</p><svg>y", "a"),
        ("<p>a</p>" + "".join(f"<nav><p>p{i}</p>" for i in range(1000)) + "</nav>" * 1000 + "<p>b</p>", "a\nb"),
        ("<article><p>1</p>" * 1000 + "</article>" * 999 + "<p>2</p></article><p>out</p>", "1\n" * 1000 + "2"),
    ]
    got = extracted(spark, *[text for text, _ in cases])
    assert [text for _, text in got] == [want for _, want in cases]


@pytest.mark.parametrize("unit, size", [
    ("<button>x ", 2_000_000), ("<a ", 2_000_000), ("<title>", 2_000_000), ("<meta property ", 2_000_000),
    ("<h1>x ", 400_000), ("<nav><p>x", 2_000_000), ("<li>a<p>b</p>c", 400_000), ("<article>", 2_000_000),
    ("<article ", 2_000_000), ("</nav><aside>", 2_000_000), ("<form><p>x</p></form>", 2_000_000),
])
def test_large_broken_pages_take_seconds(spark, unit, size):
    started = time.time()
    extracted(spark, unit * (size // len(unit)))
    assert time.time() - started < 60


def test_truncation_adds_one_character(spark):
    [(_, text)] = extracted(spark, "<article><p>" + "x" * 5000 + "</p></article>", max_chars=100)
    assert text == "x" * 100 + "…"
    df = spark.createDataFrame([("ab 　cd",), ("abc",)], "t string")
    assert [r[0] for r in df.select(truncate_text(F.col("t"), 4)).collect()] == ["ab…", "abc"]
    assert df.select(truncate_text(F.col("t"), 0)).first()[0] == "ab 　cd"


def test_extraction_corners(spark):
    cases = [
        ("<title> A &amp;lt; B </title>", ("A &lt; B", "A &lt; B")),
        ("<meta content='Og &#x26; x' property='og:title'><p>a</p>", ("Og & x", "a")),
        ('<meta property="og:title" content="Two"><h1>One</h1>', ("Two", "One")),
        ("<header><h1>In <b>header</b></h1></header><p>b</p>", ("In header", "b")),
        ("<!-- <title>no</title> --><p>c<br>d</p>e", (None, "c d")),
        ("<main>x <b>y</b> z</main><p>out</p>", (None, "x\ny\nz")),
        ("<article></article><p>out</p>", (None, "out")),
        ("<body><p>one<p>two<li>three</body>", (None, "one\ntwo\nthree")),
        ("<script>var a='<p>no</p>'</script><p>yes &nbsp; &hellip;&unknown; &copy</p>", (None, "yes \xa0 …&unknown; &copy")),
        ("<p>a</p><script>never closed <p>no</p>", (None, "a")),
        ("<ul><li><p>inner</p></li></ul>", (None, "inner")),
        ("<p>1 < 2 and 3 > 2</p>", (None, "1 < 2 and 3 > 2")),
        ("<P CLASS=x>upper</P>&#0;", (None, "upper")),
        ("<p>&#128512;&#xD800;</p>", (None, "😀�")),
        ("plain text, no tags", (None, "plain text, no tags")),
        ("", (None, "")),
        (None, (None, "")),
    ]
    got = extracted(spark, *[c[0] for c in cases])
    assert got == [c[1] for c in cases]


class _Walker(HTMLParser):
    """A small independent walker: text per block, noise skipped, first article only."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.open, self.skip, self.inside = [], None, 0, False

    def handle_starttag(self, tag, attrs):
        if tag in html.NOISE_TAGS + html.RAW_TEXT_TAGS:
            self.skip += 1
        elif tag == "article":
            self.inside = True
        elif tag in html.BLOCK_TAGS:
            self.close()
            self.open = []

    def handle_endtag(self, tag):
        if tag in html.NOISE_TAGS + html.RAW_TEXT_TAGS:
            self.skip -= 1
        elif tag == "article":
            self.close()
            self.inside = False
        elif tag in html.BLOCK_TAGS:
            self.close()

    def handle_data(self, data):
        if self.open is not None and self.inside and not self.skip and data.strip():
            self.open.append(data.strip())

    def close(self):
        if self.open:
            self.blocks.append(" ".join(self.open))
        self.open = None


def test_driver_pages_equal_an_independent_walker(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html")
    rows = pages.extract_text(df, "html", None).collect()
    for row in rows:
        walker = _Walker()
        walker.feed(row.html)
        assert row.text == "\n".join(walker.blocks)


def test_entities_follow_the_standard_library(spark):
    from html import unescape
    text = "&lt;b&gt; &eacute;&amp;amp; &#8364;&#x1F600; &middot;&Omega; & &; &#; a&b; &quot;"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(html.unescape(F.col("t"))).first()[0] == unescape(text)


def test_decoding(spark):
    cases = [
        (b"caf\xc3\xa9", None, "café"), (b"caf\xe9", "ISO-8859-1", "café"), (b"\x93x\x94\x81", "windows-1252", "“x”�"),
        (b"caf\xe9", "utf-8", "caf�"), (b"caf\xe9", "us-ascii", "caf�"), ("日本".encode("shift_jis"), "Shift_JIS", "日本"),
        ("日本".encode(), "no-such-name", "日本"), (None, "gbk", None), ("é".encode("utf-16-le"), "UTF-16LE", "é"),
    ]
    df = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "id int, body binary, enc string")
    got = df.orderBy("id").select(cap_and_decode(F.col("body"), F.col("enc")).alias("t")).collect()
    assert [r.t for r in got] == [c[2] for c in cases]
    assert df.limit(1).select(cap_and_decode(F.col("body"), F.col("enc"), 4)).first()[0] == "caf�"
    plain = df.select(cap_and_decode(F.col("body"), F.lit(None).cast("string")))
    assert "ArrowEvalPython" not in plain._jdf.queryExecution().executedPlan().toString()


def test_whitespace_is_pythons():
    assert " \t\n\x1f\x85\xa0　".strip() == "" and set(" \t\n\x1f\x85\xa0　") <= set(WHITESPACE)


def _random_robots(rng):
    agents = ["*", "webglean", "WebGlean/2", "other", "glean", "", "nobody"]
    paths = ["/", "/a", "/a/b", "", "/a%20b", "/*", "*", "/q?x=1", "/caf%C3%A9", "/A", "/a?", "b", "/50%", "/x+y"]
    lines = []
    for _ in range(rng.randint(0, 14)):
        lines.append(rng.choice([
            lambda: rng.choice(["User-agent", "user-AGENT ", " User-agent"]) + ":" + rng.choice([" ", ""]) + rng.choice(agents),
            lambda: rng.choice(["Disallow", "Allow", "disallow"]) + ": " + rng.choice(paths) + rng.choice(["", " # note"]),
            lambda: "", lambda: "   ", lambda: "# comment", lambda: "Crawl-delay: 5", lambda: "Request-rate: 1/5",
            lambda: "Sitemap: http://x/y.xml", lambda: "nonsense", lambda: "Unknown: z",
        ])())
    return rng.choice(["\n", "\r\n", "\r"]).join(lines) + rng.choice(["", "\n"])


def test_robots_equal_the_standard_library_parser(spark):
    rng = random.Random(5)
    agent = "webglean/1.0"
    targets = ["", "/", "/a", "/a/b/c", "/a b", "/a%20b", "/A", "/q?x=1&y", "/q?x=2", "/café", "/b", "?x=1", "/a?", "/x#top", "/50%25", "/x+y"]
    robots, asked, expected = [], [], []
    for i in range(250):
        body, host = _random_robots(rng), f"h{i}.com"
        robots.append(("https", host, 200, body))
        parser = RobotFileParser()
        parser.parse(body.splitlines())
        for target in targets:
            url = f"https://{host}{target}"
            asked.append((len(asked), url))
            expected.append(parser.can_fetch(agent, url))
    rules = pages.parse_robots(spark.createDataFrame(robots, "scheme string, authority string, status int, body string"), agent)
    got = pages.robots_allowed(spark.createDataFrame(asked, "id int, url string"), rules).orderBy("id").collect()
    wrong = [(r.url, robots[r.id // len(targets)][3], r.allowed) for r in got if r.allowed != expected[r.id]]
    assert wrong == []
    assert 0 < sum(expected) < len(expected)


def responses(spark):
    ok, kind = ARTICLE.encode(), "text/html; charset=utf-8"
    rows = [
        ("https://a.com/ok", 200, kind, ok, None), ("https://a.com/404", 404, kind, b"", None),
        ("https://a.com/pdf", 200, "application/pdf", b"%PDF", None), ("https://a.com/boom", None, None, None, "boom-net"),
        ("https://a.com/private/x", 200, kind, ok, None), ("https://a.com/public", 200, "", ok, None),
        ("https://b.com/x", 200, "Application/XHTML+xml", ok, None),
    ]
    df = spark.createDataFrame(rows, "url string, status int, content_type string, body binary, transport_error string")
    return as_responses(df.withColumn("fetched_at", F.lit("2024-05-06 07:08:09").cast("timestamp")))


def test_extract_articles(spark):
    asked = ["https://a.com/ok", " https://a.com/ok\n", "https://a.com/404", "https://a.com/pdf", "https://a.com/boom",
             "https://a.com/private/x", "https://a.com/public", "https://b.com/x", "https://c.com/none", "", None]
    urls_df = spark.createDataFrame([(u, i) for i, u in enumerate(asked)], "url string, position int")
    robots = spark.createDataFrame(
        [("https", "a.com", 200, "User-agent: *\nDisallow: /private"), ("https", "b.com", 500, "User-agent: *\nDisallow: /")],
        "scheme string, authority string, status int, body string",
    )
    got = {r.url: r for r in pages.extract_articles(urls_df, responses(spark), robots).collect()}
    assert {u: r.error for u, r in got.items()} == {
        "https://a.com/ok": None, "https://a.com/404": "HTTP 404", "https://a.com/pdf": "unsupported content-type: application/pdf",
        "https://a.com/boom": "boom-net", "https://a.com/private/x": "blocked by robots.txt", "https://a.com/public": None,
        "https://b.com/x": None, "https://c.com/none": "HTTP 404",
    }
    ok = got["https://a.com/ok"]
    assert (ok.title, ok.status, ok.finalUrl, ok.fetchedAt) == ("Tides of the northern bay", 200, "https://a.com/ok", "2024-05-06T07:08:09Z")
    assert ok.chars == len(ok.text) > 0
    assert got["https://a.com/private/x"].status is None and got["https://a.com/private/x"].finalUrl is None
    assert got["https://a.com/404"].status == 404 and got["https://a.com/404"].text == ""
    free = {r.url: r.error for r in pages.extract_articles(urls_df, responses(spark), None).collect()}
    assert free["https://a.com/private/x"] is None
    summary = pages.fetch_summary(pages.extract_articles(urls_df, responses(spark), robots)).first()
    assert summary == (8, 5, 8)


def test_extract_articles_rejects_other_schemes(spark):
    bad = spark.createDataFrame([("ftp://a", 0), ("https://a.com/ok", 1)], "url string, position int")
    with pytest.raises(PySparkException, match="only http"):
        pages.extract_articles(bad, responses(spark)).collect()
    got = {r.url: r.error for r in pages.extract_articles(bad, responses(spark), mode="capture").collect()}
    assert got == {"ftp://a": "only http(s) URLs are supported: ftp://a", "https://a.com/ok": None}


def test_extract_articles_needs_urls(spark):
    blank = spark.createDataFrame([(" ", 0), (None, 1)], "url string, position int")
    with pytest.raises(ValueError, match="no URLs"):
        pages.extract_articles(blank, responses(spark))


def test_dedupe_urls_keeps_first_position(spark):
    rows = [(f"https://h.com/{i % 8}", i) for i in range(16)] + [(" ", 90), (None, 91)]
    got = pages.dedupe_urls(spark.createDataFrame(rows, "url string, position int")).orderBy("position").collect()
    assert [(r.url, r.position) for r in got] == [(f"https://h.com/{i}", i) for i in range(8)]


def test_url_parts(spark):
    df = spark.createDataFrame([("HTTPS://u:p@Ex.com:80/a b?x=1#f",), ("nothing",)], "url string")
    url = F.col("url")
    got = df.select(urls.scheme(url), urls.authority(url), urls.hostname(url), urls.target(url), urls.query_string(url)).collect()
    assert tuple(got[0]) == ("https", "u:p@Ex.com:80", "ex.com", "/a b?x=1#f", "x=1")
    assert tuple(got[1]) == ("", "", "", "", "")


@pytest.mark.parametrize("rows", [1000, 0])
def test_page_bodies_are_not_shuffled(spark, monkeypatch, rows):
    monkeypatch.setattr(pages, "LISTED_HASHES", rows)
    asked = spark.createDataFrame([("https://a.com/ok", 0)], "url string, position int")
    plan = pages.extract_articles(asked, responses(spark))._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        assert not ("Exchange" in line and "body" in line)
    assert ("LeftSemi" in plan) == (rows > 0)
    assert pages.extract_articles(asked, responses(spark)).first().title == "Tides of the northern bay"


@pytest.mark.parametrize("rows", [1000, 0])
def test_one_capture_of_a_url_is_parsed(spark, monkeypatch, rows):
    monkeypatch.setattr(pages, "LISTED_HASHES", rows)
    captures = spark.range(3000).select(
        F.concat(F.lit("https://h.com/"), F.col("id") % 30).alias("url"), F.lit("x").alias("final_url"),
        F.lit(200).alias("status"), F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("string").alias("encoding"),
        F.encode(F.concat(F.lit("<title>"), F.col("id"), F.lit("</title>")), "UTF-8").alias("body"),
        F.lit(None).cast("string").alias("transport_error"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("fetched_at"),
    )
    asked = spark.createDataFrame([(f"https://h.com/{i}", i) for i in range(0, 40, 2)], "url string, position int")
    parsed = []
    inner = pages.read_articles

    def counting(responses, *limits):
        parsed.append(responses.count())
        return inner(responses, *limits)

    monkeypatch.setattr(pages, "read_articles", counting)
    got = {r.url: r.title for r in pages.extract_articles(asked, captures).collect()}
    assert got == {f"https://h.com/{i}": str(2970 + i) if i < 30 else None for i in range(0, 40, 2)}
    at = F.lit("1970-01-01 00:01:00").cast("timestamp_ntz")
    early = {r.url: r.title for r in pages.extract_articles(asked, captures, at=at).collect()}
    assert early == {f"https://h.com/{i}": ("60" if i == 0 else str(30 + i)) if i < 30 else None for i in range(0, 40, 2)}
    # A URL more at most slips through the filter of fixed size.
    assert parsed[0] <= 15 + (rows == 0) and parsed[1] <= 15 + (rows == 0)


def test_captures_of_one_time_differ_by_their_text(spark):
    row = ("https://a.com/", "f", 200, None, None, bytearray(b"<p>one</p>"), None, None)
    shape = ("url string, final_url string, status int, content_type string, encoding string, body binary, "
             "transport_error string, fetched_at timestamp_ntz")
    captures = spark.createDataFrame([row, row, (*row[:5], bytearray(b"<p>two</p>"), *row[6:])], shape)
    asked = spark.createDataFrame([("https://a.com/", 0)], "url string, position int")
    assert [r.text for r in pages.extract_articles(asked, captures).collect()] == ["two"]


def test_filter_of_fixed_size_keeps_all_that_is_listed(spark):
    rows = spark.range(200_000).select("id", F.lit(1).alias("_bitmap"))
    listed = spark.range(0, 200_000, 50).select(F.xxhash64("id").alias("_hash"))
    for few in (True, False):
        kept = membership.keep_listed(rows, F.xxhash64("id"), listed, few)
        assert kept.columns == ["id", "_bitmap"]
        assert kept.filter("id % 50 = 0").count() == 4000 and kept.count() <= 4000 + (0 if few else 400)
    none = membership.keep_listed(rows, F.xxhash64("id"), listed.limit(0), False)
    assert none.count() == 0


def test_python_decodes_only_the_branch_of_rare_encodings(spark):
    shape = ("url string, final_url string, status int, content_type string, encoding string, body binary, "
             "transport_error string, fetched_at timestamp_ntz")
    rows = [
        (name or "none", "f", 200, None, name, bytearray(body), None, None) for name, body in [
            (None, b"<p>caf\xc3\xa9</p>"), ("latin-1", b"<p>caf\xe9</p>"), ("koi8-r", b"<p>\xc1</p>"), ("nosuch", b"<p>\xff</p>"),
        ]
    ]
    known = spark.createDataFrame(rows[:2], shape)
    plan = pages.read_articles(known)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    mixed = pages.read_articles(spark.createDataFrame(rows, shape))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Union" in plan
    assert {r.url: r.text for r in mixed.collect()} == {"none": "café", "latin-1": "café", "koi8-r": "а", "nosuch": "�"}
