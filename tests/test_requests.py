import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from webglean.operators import requests
from webglean.sources.tables import load_queries


def test_load_queries_keeps_positions(spark):
    lists = spark.createDataFrame([(7, ["x", "y"])], "batch int, asks array<string>")
    assert [tuple(r) for r in load_queries(lists, "asks", keep=("batch",)).collect()] == [(7, 0, "x"), (7, 1, "y")]
    texts = spark.createDataFrame([(3, "x")], "at int, ask string")
    assert load_queries(texts, "ask", "at").first() == (3, "x")
    with pytest.raises(ValueError):
        load_queries(texts, "ask")


def test_validate_queries(spark):
    texts = ["hello", "", "   ", " \x1f", None, "x" * 200, "x" * 201]
    df = spark.createDataFrame(list(enumerate(texts)), "query_idx int, query string")
    got = [r.error for r in requests.validate_queries(df, "capture").orderBy("query_idx").collect()]
    empty = "query is empty"
    assert got == [None, empty, empty, empty, empty, None, "query must be <= 200 characters (got 201)"]
    with pytest.raises(PySparkException, match="query (is empty|must be)"):
        requests.validate_queries(df).select("query").collect()
    assert requests.validate_queries(df.limit(1)).count() == 1


def test_validate_max_results(spark):
    df = spark.createDataFrame([(None,), (1,), (25,), (0,), (26,), (-1,)], "max_results int")
    out = "max_results must be between 1 and 25"
    assert [r.error for r in requests.validate_max_results(df, mode="capture").collect()] == [None, None, None, out, out, out]
    kind = "max_results must be an integer"
    for value in (F.lit("5"), F.lit(True), F.lit(5.0)):
        row = requests.validate_max_results(spark.range(1).select(value.alias("max_results")), mode="capture").first()
        assert row.error == kind
    json = spark.createDataFrame([("5",), ('"5"',), ("true",), ("5.5",), ("null",), ("26",)], "j string")
    typed = json.select(F.parse_json("j").alias("max_results"))
    assert [r.error for r in requests.validate_max_results(typed, mode="capture").collect()] == [None, kind, kind, kind, None, out]


def test_clamp_max_results(spark):
    cases = {"150": 25, "0": 1, "5.7": 10, "x": 10, None: 10, " 7 ": 7, "-3": 1, "+4": 4, "1_5": 15, "1_2_3": 25, "9" * 40: 25, "": 10, "1_": 10}
    df = spark.createDataFrame([(k,) for k in cases], "max_results string")
    assert [r.max_results for r in requests.clamp_max_results(df).collect()] == list(cases.values())
    typed = {"5.7": 5, '"5.7"': 10, '"8"': 8, "true": 1, "false": 1, "[3]": 10, "{}": 10, "1e20": 25, "99999999999999999999": 25, "-1": 1, "null": 10}
    df = spark.createDataFrame([(k,) for k in typed], "j string").select(F.parse_json("j").alias("max_results"))
    assert [r.max_results for r in requests.clamp_max_results(df).collect()] == list(typed.values())


def test_split_exclude(spark):
    df = spark.createDataFrame([("a.com, b.com\tc.com,,",), (None,), (" ",)], "exclude string")
    assert [r.exclude for r in requests.split_exclude(df).collect()] == [["a.com", "b.com", "c.com"], [], []]
    df = spark.createDataFrame([([" a b ", "", None, "c,d"],)], "exclude array<string>")
    assert requests.split_exclude(df).first().exclude == ["a b", "c,d"]


REQUESTS = [
    # url, content type, body -> query, max, exclude
    ("/s?q=one&count=150", None, None, ("one", 25, [])),
    ("/s?q=&q=b", None, None, ("b", 10, [])),
    ("/s?q=a+b%20c%26", None, None, ("a b c&", 10, [])),
    ("/s?q=50%&n=3", None, None, ("50%", 3, [])),
    ("/s?q=qs", "application/json", '{"query":"body"}', ("qs", 10, [])),
    ("/s?q=qs", "application/json", '{"q":"body","limit":5.7}', ("body", 5, [])),
    ("/s?q=qs", "application/json", '{"q":"","limit":"5.7"}', ("qs", 10, [])),
    ("/s?q=qs", "application/json", '{"q":null,"n":0}', ("qs", 1, [])),
    ("/s?q=qs&input=i", "application/json", '{"q":[]}', ("i", 10, [])),
    ("/s?q=qs", "application/json", "{broken", ("qs", 10, [])),
    ("/s?q=qs", "application/json", "[1]", ("qs", 10, [])),
    ("/s", "application/x-www-form-urlencoded", "text=f+g&exclude=x.com,+y.com", ("f g", 10, ["x.com", "y.com"])),
    ("/s", None, '{"keyword":"k","exclude":["a b"," c "],"num":"7"}', ("k", 7, ["a b", "c"])),
    ("/s", "text/plain", '{"search":"s","blacklist":"p, q"}', ("s", 10, ["p", "q"])),
    ("/s?maxResults=4&n=9#q=no", None, None, (None, 4, [])),
    ("/s", "application/json", '{"q":0}', (None, 10, [])),
    ("/s", "application/json", '{"q":5}', (None, 10, [])),
    (None, None, None, (None, 10, [])),
]


def test_normalize_requests(spark):
    rows = [(i, url, kind, body) for i, (url, kind, body, _) in enumerate(REQUESTS)]
    log = spark.createDataFrame(rows, "req_id int, url string, content_type string, body string")
    got = requests.normalize_requests(log).orderBy("req_id").collect()
    assert [(r.query, r.max_results, r.exclude) for r in got] == [case[3] for case in REQUESTS]
    errors = {r.req_id: r.error for r in got if r.error}
    assert errors == {14: requests.NO_QUERY, 15: requests.NO_QUERY, 16: requests.QUERY_NOT_TEXT, 17: requests.NO_QUERY}


def test_allow_hosts(spark):
    urls = [
        "https://abc1.search.service.us-east-1.example.com/x", "https://x.search.service.eu-west-1.example.com", "",
        "http://abc1.search.service.us-east-1.example.com", "https://evil.example.org/x",
        "https://search.service.example.com/x", "https://abc1.search.service.us-east-1.example.com.evil.org/",
        "HTTPS://u:p@ABC1.search.service.us-east-1.example.com:443/", None,
    ]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = requests.allow_hosts(
        df, "url", r"[a-z0-9-]+\.search\.service\.[a-z0-9-]+\.example\.com", r"search\.service\.([a-z0-9-]+)\.example\.com"
    ).collect()
    assert [r.error is None for r in got] == [True, True, False, False, False, False, False, True, False]
    assert [r.host_part for r in got][:2] == ["us-east-1", "eu-west-1"] and got[4].host_part is None
    with pytest.raises(PySparkException, match="must use https"):
        requests.allow_hosts(df.filter("url like 'http:%'"), "url", ".*", mode="fail").collect()


def test_check_fetch_urls(spark):
    df = spark.createDataFrame([(" HTTP://a.com ",), ("ftp://a",), (None,)], "url string")
    got = requests.check_fetch_urls(df, mode="capture").collect()
    assert [(r.url, r.error) for r in got][:2] == [("HTTP://a.com", None), ("ftp://a", requests.ONLY_HTTP + "ftp://a")]
    assert got[2].error
    with pytest.raises(PySparkException, match="only http"):
        requests.check_fetch_urls(df).collect()
