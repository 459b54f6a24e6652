import pytest
from pyspark.sql import functions as F

from lodestrata.operators import packages as P


def test_packages(spark):
    mk = spark.createDataFrame
    src = mk([("a", "https://www.a.org/"), ("b", "https://b.org")], "source_id string, entrypoint string")
    assert P.stage_configs(src).where("discover_apis").count() == 2
    assert P.require_rows(src, 2).count() == 2
    with pytest.raises(Exception, match="expected 3 rows"):
        P.require_rows(src, 3).collect()
    assert P.setting(None, "", "json", default="x") == "json"
    v = mk([('"u"',), ('{"href": "h"}',), ("plain",)], "v string").select(P.link_of(F.col("v")).alias("l"))
    assert [r.l for r in v.collect()] == ["u", "h", "plain"]
    f = mk([("a", "https://a.org/x", 5), ("a", "https://c.org/", 5), ("a", "https://a.org/y", 9 << 20)], "source_id string, url string, size long")
    assert [r.outcome for r in P.apply_policy(f, mk([("a", ["a.org"])], "source_id string, allowed_hosts array<string>")).collect()] == ["OK", "OUT_OF_SCOPE_HOST", "RESPONSE_TOO_LARGE"]
    api = P.api_catalog(mk([("https://a.org/x?page=1", "[1,2]", "application/json"), ("u", "zzz", "")], "url string, body string, content_type string")).collect()
    assert [(r.identity, r.format, r.records, r.has_pagination, r.shape) for r in api] == [("GET https://a.org/x", "json", 2, True, "LIST_SMALL_OR_SCALAR")]
    assert spark.range(1).select(P.candidate_urls(F.array(F.lit("a"), F.lit("b")), F.lit(None).cast("array<string>"), F.array(F.lit("a"), F.lit("c"))).alias("c")).first().c == ["a", "b", "c"]
    got = P.promoted(mk([("A", "https://x.org/1"), ("k", "https://y.org/")], "source_id string, entrypoint string"), mk([("a", "q"), ("n", "https://Y.org"), ("z", "https://z.org")], "source_id string, entrypoint string"))
    assert sorted((r.source_id, r.config_id, r.origin) for r in got.collect()) == [("a", "A", "KEPT_BY_ID"), ("n", "k", "KEPT_BY_URL"), ("z", "z", "GENERATED")]
    files = mk([("s", "other/1"), ("s", "canon/1"), ("t", "o/1"), ("t", "o/2")], "k string, path string")
    assert sorted((r.k, r.path, r.outcome) for r in P.choose_file(files, "k", F.col("path").startswith("canon")).collect()) == [("s", "canon/1", "OK"), ("t", "o/1", "AMBIGUOUS")]
    man = mk([("l1", 3), ("l2", 4)], "logical_source_id string, legacy_records int")
    assert tuple(P.package_totals(man, man).first()) == (True, True, 7)
    assert P.consumer_contract(man, man.limit(1)).first().contract == '{"sources":2,"records":7,"duplicate_groups":1,"ids":["l1","l2"]}'
    res = mk([("a", "api"), ("a", "file")], "source_id string, resource_type string")
    rows = P.audit_row(res, mk([("a", 2, 0)], "source_id string, valid long, invalid long"), mk([("a", "SUCCESS"), ("b", "SUCCESS"), ("c", "FAILED")], "source_id string, state string")).collect()
    assert sorted((r.source_id, r.classification) for r in rows) == [("a", "DATAX_READY"), ("b", "SUCCESS_EMPTY"), ("c", "EXECUTION_NOT_SUCCESS")]
    rep = mk([([("a", 1), ("b", 2)],)], "source_results array<struct<source_id:string,n:int>>")
    assert P.source_result(rep, F.lit("b")).first().result.n == 2
    assert P.report_table(man.orderBy("logical_source_id")).splitlines()[2] == "| l1 | 3 |"
    assert P.compatibility_rows(mk([({"html": ["js"]},)], "compatible map<string,array<string>>")).first().special == "js"
    assert [r.term for r in P.keyword_hits(mk([("p", "uses browser")], "path string, text string"), "path", "text", ["browser", "x"]).collect()] == ["browser"]
    assert spark.range(1).select(P.observed_workflow(F.lit("Workflow: Html-Deep")).alias("w")).first().w == "htmldeep"
    assert sorted((r.state, r.attempts) for r in P.remediation_state(src, mk([("a", "FAILED", 2)], "source_id string, state string, attempts int")).collect()) == [("FAILED", 2), ("PENDING", 0)]
