import pytest
from pyspark.sql import functions as F

from lodestrata.operators import resolution as R
from lodestrata.operators import rules


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_scalars(spark):
    none = F.lit(None).cast("string")
    got = spark.range(1).select(
        R.effective_title(F.lit(" "), F.lit("https://a.org/x/y.csv")).alias("a"), R.api_title(none, F.lit("get"), F.lit("https://a.org/v1/x?y")).alias("b"), R.description(none, F.lit(" "), F.lit("t"), F.lit("u")).alias("c"),
        R.method_label(F.lit("JavaScript")).alias("d"), R.redirect_allowed(F.lit("https://a.org/x"), F.array(F.lit("a.org"))).alias("e"), R.forbidden_methods(F.array(F.lit("get"), F.lit("post"))).alias("f"),
        R.form_confirmed(F.lit("https://a.org/form"), F.lit("<FORM>"), ["/form"]).alias("g"), R.is_data_event(F.lit("https://a.org/api/x"), F.lit("image/png")).alias("h"),
        rules.network_category(F.lit("https://a.org/x.csv"), F.lit(""), F.lit("https://www.a.org/")).alias("i"), R.host_variants(F.lit("http://www.a.org/p")).alias("j"),
        R.interesting_lines(F.lit("ok\nerror 1\nfine\nerror 2"), "error", 1).alias("k"), R.decode_body(F.unhex(F.lit("E9")), F.lit("text/html; charset=ISO-8859-1")).alias("l"),
        R.default_sitemap(F.lit("https://A.org/x")).alias("m"), R.identity_keys(F.lit("A/"), F.lit("a"), F.lit(" ")).alias("n"), R.probe_level(F.lit(0), F.lit(3)).alias("o"),
        R.headers(F.create_map(F.lit("A"), F.lit("1"), F.lit("B"), F.lit("2")), F.create_map(F.lit("a"), F.lit("3"))).alias("p"), F.date_format(R.utc(F.lit("2024-01-01T00:00:00Z")), "yyyy").alias("q"), R.utc(F.lit("x")).alias("r"),
    ).first()
    assert (got.a, got.b, got.c, got.d, got.e, got.f, got.g, got.h, got.i) == ("y.csv", "API GET /v1/x", "t", "rendered_dom", True, ["POST"], True, False, "DATA_ENDPOINT")
    assert got.j == ["http://www.a.org/p", "https://a.org/p", "https://www.a.org/p", "http://a.org/p"] and got.k == "error 2" and got.l == "é"
    assert got.m == "https://a.org/sitemap.xml" and got.n == ["a"] and tuple(got.o) == (3, "L0") and got.p == {"a": "3", "b": "2"} and got.q == "2024" and got.r is None


def test_tables(spark):
    mk = spark.createDataFrame
    rows = mk([("a", "u1", 1), ("a", "u1", 2), ("a", "u2", 3), ("a", "u3", 4), ("b", "u1", 5)], "k string, u string, o int")
    assert sorted((r.k, r.u, r.o) for r in R.capped(rows, "k", "u", "o", 2).collect()) == [("a", "u1", 1), ("a", "u2", 3), ("b", "u1", 5)]
    stages = mk([("s", "x", 1, 0), ("s", "y", 2, 3), ("s", "z", 3, 9), ("t", "x", 1, 0)], "source_id string, stage string, o int, resources int")
    assert sorted((r.source_id, r.stage) for r in R.first_success(stages, "source_id", "o").collect()) == [("s", "y"), ("t", "x")]
    variants = mk([("s", "A", "OK", 2), ("s", "B", "OK", 1), ("s", "C", "BAD", 0)], "source_id string, v string, status string, o int")
    assert [r.v for r in R.best_variant(variants, "source_id", {"OK": 2, "BAD": 1}, "o").collect()] == ["B"]
    pages = mk([("c", 1, "u1", "h1", "json", 5), ("c", 2, "u2", "h2", "json", 0), ("c", 3, "u3", "h3", "json", 0), ("c", 4, "u4", "h4", "json", 7)], "c string, o int, url string, page_hash string, format string, records int")
    assert [r.stop_reason for r in R.pagination_chain(pages, "c", "o").orderBy("o").collect()] == [None, None, "STAGNANT", "STAGNANT"]
    req = mk([("h", 1, 0.0), ("h", 2, 1.0), ("h", 3, 20.0)], "host string, o int, at_s double")
    assert [r.start_s for r in R.host_schedule(req, "o", mk([("h", 5.0), ("h", 2.0)], "host string, interval_s double")).orderBy("o").collect()] == [0.0, 5.0, 20.0]
    tries = mk([("r", 1, 503), ("r", 2, None), ("r", 3, 200), ("q", 1, 429), ("q", 2, 429), ("q", 3, 429), ("q", 4, 200)], "k string, attempt int, status int")
    assert sorted((r.k, r.status, r.attempts) for r in R.final_attempt(tries, "k", [429, 503]).collect()) == [("q", 429, 3), ("r", 200, 3)]
    plan = mk([("a", True), ("b", True), ("c", False), ("d", True)], "source_id string, operational boolean")
    assert sorted((r.source_id, r.outcome) for r in R.mapping_report(plan, mk([("b",), ("b",), ("c",), ("d",)], "source_id string")).collect()) == [("a", "MISSING"), ("b", "AMBIGUOUS"), ("c", "UNEXPECTED"), ("d", "OK")]
    look = mk([("s", "r1", 1, "x"), ("s", "r2", 2, "y")], "source_id string, run_id string, at int, v string")
    assert sorted((r.run_id, r.v) for r in R.with_fallback(mk([("s", "r1"), ("s", "r9")], "source_id string, run_id string"), "run_id", look, "at", ["v"]).collect()) == [("r1", "x"), ("r9", "y")]
    conf = mk([("l1", "p", "u", "w", 2), ("p", "p", "v", "w", 1)], "logical_id string, physical_id string, entrypoint string, workflow string, ord int")
    g = R.groups_of_config(conf).first()
    assert (g.representative, g.seeds, g.one_entrypoint, g.one_workflow) == ("p", "v,u", False, True)
    state = lambda classes, ready: R.pipeline_state(mk([(c,) for c in classes], "classification string"), mk([(r,) for r in ready], "package_ready boolean")).first().state
    good = ["DATAX_READY", "EXTERNAL_BLOCKER", "ACQUISITION_JOB_READY"]
    assert [state(good, [True]), state(good, [None]), state(good, []), state([*good, None], [True]), state([*good, "EXECUTION_FAILED", "PENDING"], [True]), state([], [])] == ["READY", "PACKAGE_REVIEW", "PACKAGE_NOT_BUILT", "FAILED", "PARTIAL", "PACKAGE_NOT_BUILT"]
    forms = mk([("https://a.org/p", "/s", "get", [("q", "text", "x y"), ("pw", "password", "1")]), ("https://a.org/p", "https://b.org/", "GET", [])], "page_url string, action string, method string, fields array<struct<name:string,type:string,value:string>>")
    assert [r.url for r in R.form_queries(forms).collect()] == ["https://a.org/s?q=x+y"]
    docs = mk([(1, '{"items": [{"url": "https://a/x.csv"}, {"link": "https://a/y"}]}'), (2, '[{"download_url": "https://a/z.pdf"}]')], "k int, b string")
    assert sorted(r.link for r in R.file_links(docs, "k", "b").collect()) == ["https://a/x.csv", "https://a/z.pdf"]
    links = mk([("https://a.org/?page=3",), ("https://a.org/x",)], "url string")
    assert [r.url for r in R.open_links(links, mk([("https://a.org/?page=%2A",)], "family string")).collect()] == ["https://a.org/x"]
    with pytest.raises(LookupError):
        R.only_source(plan, "zz")
    w = R.Workflows()
    w.register("Html", lambda df: df.limit(1))
    assert w.run("HTML", plan).count() == 1 and not w.is_registered("none")
    ck = R.new_checkpoint(mk([("a", "OPERATIONAL_CONFIG"), ("b", "NONE")], "source_id string, next_phase string"))
    assert sorted(r.state for r in ck.collect()) == ["PENDING", "SKIPPED_STATUS"]
    f = mk([("u", 1, "e1", None), ("u", 2, None, "m2")], "url string, at int, etag string, last_modified string")
    assert tuple(R.conditional_headers(f, "at").first()) == ("u", "e1", "m2")
