"""The API crawl on hand-made responses: odd sources, every stop of a chain, budgets, the documentation queue."""

import json

import pytest

from lodestrata.operators import api_crawl as C

A = "https://a.org"


def page(k, n, items=1, key="p", **more):
    return json.dumps({"items": list(range(items)), "page": k, "total_pages": n, "key": f"{key}{k}", **more})


def chain(name, pages):
    return [(f"{A}/{name}?page={i + 1}", *p) for i, p in enumerate(pages)]


J, X = "application/json", "text/csv"
OK = lambda body, kind=J: (None, body, kind, None)
RESPONSES = [
    *chain("long", [OK(page(i, 9)) for i in range(1, 10)]),
    *chain("dull", [OK(page(1, 9, 0)), OK(page(2, 9)), OK(page(3, 9, 0)), OK(page(4, 9, 0)), OK(page(5, 9))]),
    *chain("idle", [OK(page(1, 9, 0)), OK(page(2, 9, 0)), OK(page(3, 9)), OK(page(4, 9))]),
    *chain("turn", [OK(page(1, 9)), OK("a,b\n1,2", X)]),
    *chain("same", [OK(page(1, 9)), OK(page(1, 9))]),
    *chain("hole", [OK(page(1, 9))]),
    *chain("many", [OK(page(1, 9, 6000)), OK(page(2, 9))]),
    *chain("ring", [OK(page(1, 9)), OK(json.dumps({"items": [1], "next": "?page=1"}))]),
    *chain("away", [OK(json.dumps({"items": [1], "next": "https://b.org/away?page=2"}))]),
    (f"{A}/plain", None, "[1, 2, 3]", J, None),
    (f"{A}/plain", None, "[1, 2, 3]", J, None),  # a repeated response
    (f"{A}/bad", None, "{oops", J, None),
    (f"{A}/late", "TIMEOUT", None, None, None),
    (f"{A}/huge", "RESPONSE_TOO_LARGE", "x" * 100, J, None),
    (f"{A}/home", None, '<a href="/api/x">x</a><a href="/d/openapi.json">d</a><a href="/e/swagger.json">e</a><a href="/e/swagger.json">again</a>', "text/html", None),
    (f"{A}/d/openapi.json", None, json.dumps({"openapi": "3.0.0", "paths": {"/z": {"get": {}}, "/b": {"get": {}}, "/c": {"post": {}}}}), J, None),
    (f"{A}/e/swagger.json", None, '<a href="/f/openapi.json">f</a>', "text/html", None),
    (f"{A}/f/openapi.json", None, '<a href="/g/openapi.json">too deep</a>', "text/html", None),
]


@pytest.fixture(scope="module")
def crawl(spark):
    names = ["long", "dull", "idle", "turn", "same", "hole", "many", "ring", "away"]
    sources = [(i, [f"{A}/{n}?page=1"], 250, 200) for i, n in enumerate(names)]
    sources += [
        (20, [f"{A}/plain", None, f"{A}/PLAIN#f", f"{A}/bad", f"{A}/late", f"{A}/huge"], 250, 200),
        (21, [f"{A}/home", f"{A}/plain", f"{A}/late"], 250, 5), (22, [f"{A}/home", f"{A}/plain"], 250, 3), (23, [f"{A}/long?page=1", f"{A}/plain", f"{A}/late"], 3, 200),
        (24, [f"{A}/home", f"{A}/plain"], 4, 200), (25, None, 250, 200), (26, [], 250, 200), (27, [f"{A}/late", f"{A}/bad"], 250, 200), (28, [f"{A}/nowhere"], 250, 200), (None, [f"{A}/plain"], 250, 200),
    ]
    s = spark.createDataFrame(sources, "source_id long, seeds array<string>, max_requests int, max_endpoints int")
    r = spark.createDataFrame(RESPONSES, "url string, error string, body string, content_type string, link string")
    out = C.api_crawl(s, r)
    return {n: [x.asDict() for x in df.collect()] for n, df in out.items()}


def test_chains(crawl):
    got = {x["source_id"]: (x["stop"], x["pages"], x["records"], x["strategy"]) for x in crawl["seeds"] if x["source_id"] is not None and x["source_id"] < 20}
    assert got == {
        0: ("MAX_PAGES", 5, 5, "numeric_page"), 1: ("STAGNANT", 4, 1, "numeric_page"), 2: ("FETCH_ERROR", 4, 2, "numeric_page"), 3: ("FORMAT_CHANGED", 1, 1, "numeric_page"),
        4: ("REPEATED_PAYLOAD", 1, 1, "numeric_page"), 5: ("FETCH_ERROR", 1, 1, "numeric_page"), 6: ("MAX_RECORDS", 1, 6000, None), 7: ("REPEATED_URL", 2, 2, "numeric_page"), 8: ("NEXT_HOST_CHANGED", 1, 1, None),
    }
    # of source 2 the first page does not count as stagnant; its fifth is not captured


def test_sources(crawl):
    got = {x["source_id"]: x for x in crawl["sources"]}
    pick = lambda i, *names: tuple(got[i][n] for n in names)
    assert pick(20, "requests", "urls_failed", "api_endpoints", "success", "stop_reason") == (5, 3, 2, True, "API_SEEDS_EXHAUSTED")
    # three links and a seed, then one operation of the first specification up to the limit of five
    assert pick(21, "requests", "documents_probed", "openapi_documents", "api_endpoints", "stop_reason") == (6, 3, 1, 5, "API_SEEDS_EXHAUSTED")
    assert pick(22, "requests", "api_endpoints", "stop_reason") == (4, 3, "MAX_API_ENDPOINTS")
    assert pick(23, "requests", "api_pages_visited", "stop_reason", "pagination_stopped") == (3, 3, "REQUEST_BUDGET_EXCEEDED", 1)
    assert pick(24, "requests", "documents_probed") == (4, 2)
    assert pick(25, "requests", "success") == pick(26, "requests", "success") == (0, True)
    assert pick(27, "success", "failure_code") == (False, "INVALID_RESPONSE") and pick(28, "success", "failure_code") == (False, "NOT_CAPTURED")


def test_documents(crawl):
    docs = sorted((x["request_no"], x["url"].removeprefix(A), x["error"]) for x in crawl["attempts"] if x["source_id"] == 21 and x["phase"] == "DOCUMENT")
    assert [d[1:] for d in docs] == [("/d/openapi.json", None), ("/e/swagger.json", None), ("/f/openapi.json", None)]
    keys = [x["identity"].removeprefix(f"GET {A}") for x in sorted((x for x in crawl["resources"] if x["source_id"] == 21), key=lambda x: x["place"])]
    assert keys == ["/api/x", "/d/openapi.json", "/e/swagger.json", "/plain", "/z"]


def test_no_rows(spark):
    s = spark.createDataFrame([], "source_id long, seeds array<string>")
    r = spark.createDataFrame([], "url string, error string, body string, content_type string, link string")
    assert all(df.count() == 0 for df in C.api_crawl(s, r).values())
    one = spark.createDataFrame([(1, ["https://a.org/x"])], s.schema)
    assert [x.failure_code for x in C.api_crawl(one, r)["sources"].collect()] == ["NOT_CAPTURED"]


def test_data_endpoints(spark):
    df = spark.createDataFrame([(1, ["a"], [" b ", " "]), (2, ["a"], None), (3, [], [""])], "source_id long, seeds array<string>, data_endpoints array<string>")
    assert [(r.seeds, r.failure_code) for r in C.data_endpoint_sources(df).orderBy("source_id").collect()] == [(["b"], None), (["a"], None), ([], "CUSTOM_DATA_ENDPOINT_MISSING")]


def test_a_document_counts_before_its_operations(spark):
    """A specification that only another document names takes a place itself: its operations fill what is left after it."""
    body = json.dumps({"openapi": "3.0.0", "paths": {"/y": {"get": {}}, "/z": {"get": {}}}})
    r = [(f"{A}/in", None, '<a href="/e/swagger.json">e</a>', "text/html", None), (f"{A}/e/swagger.json", None, '<a href="/f/openapi.json">f</a>', "text/html", None), (f"{A}/f/openapi.json", None, body, J, None)]
    s = spark.createDataFrame([(cap, [f"{A}/in"], cap) for cap in (1, 2, 3, 9)], "source_id long, seeds array<string>, max_endpoints int")
    out = C.api_crawl(s, spark.createDataFrame(r, "url string, error string, body string, content_type string, link string"))
    assert {x.source_id: x.api_endpoints for x in out["sources"].collect()} == {1: 2, 2: 2, 3: 3, 9: 4}


def test_seeds_without_the_queue(spark, monkeypatch):
    """Seeds need no documents: the queue is not made for them, nor where no source may ask for any."""
    s = spark.createDataFrame([(1, [f"{A}/home", f"{A}/plain"])], "source_id long, seeds array<string>")
    r = spark.createDataFrame(RESPONSES, "url string, error string, body string, content_type string, link string")
    whole = C.api_crawl(s, r)
    few = C.api_crawl(s, r, documents=False)
    assert list(few) == ["seeds"] and sorted(few["seeds"].collect()) == sorted(whole["seeds"].collect())
    tables = []
    none = C.api_crawl(s.selectExpr("*", "0 AS max_documents"), r, lambda df: tables.append(df.columns) or C.to_shared(df))
    assert not [c for c in tables if "taken" in c]
    assert {x.phase for x in none["attempts"].collect()} == {"SEED"} and none["sources"].first().documents_probed == 0


def test_a_next_page_is_decided_once(spark):
    """The plan mentions a URL's way to its next page once, not for each field of the result."""
    from pyspark.sql import functions as F

    from lodestrata.functions import api, urls

    df = spark.createDataFrame([('{"next": "?page=2"}', None, f"{A}/x?page=1")], "body string, link string, url string")
    got = df.select(api.next_page(F.col("body"), F.col("link"), F.col("url")).alias("n"))
    assert tuple(got.first().n) == (f"{A}/x?page=2", "json_next", "OK")
    assert got._jdf.queryExecution().analyzed().toString().count("NEXT_IDENTITY_CHANGED") == 1
    rows = [("http://a/x?page=1", "http://a/x?page=2", True), ("http://a/x?page=1&b=1", "http://a/x?page=2", False), ("http://a/x ", "http://a/x", True), ("http://a/x ?page=1", "http://a/x ", False)]
    odd = spark.createDataFrame(rows, "a string, b string, same boolean")
    assert [r.same for r in odd.collect()] == [r.got for r in odd.select(urls.same_identity(F.col("a"), F.col("b")).alias("got")).collect()]


def test_plain_urls_are_their_normal_form(spark):
    from pyspark.sql import functions as F

    from lodestrata.functions import urls

    rows = ["http://a/x", "http://a/x?b=1", "http://a/x?utm_source=1", "http://a/x?UTM_Source=1", "http://a:80/x", "http://a/x?b", "http://a/x?b=~\n", "http://A/x", "http://a", "http://a/x?b=2&a=1", " http://a/x "]
    df = spark.createDataFrame([(u,) for u in rows], "url string").select("url", urls.normalize(F.col("url")).alias("short"), urls._normal(F.trim("url")).alias("long"), F.col("url").rlike(urls.PLAIN).alias("plain"))
    got = df.collect()
    assert all(r.short == r.long for r in got) and [r.url for r in got if r.plain] == rows[:2]
