import pytest
from pyspark.sql import functions as F

from lodestrata.functions import text as T
from lodestrata.functions import urls as U
from lodestrata.operators import catalog, frontier, projection, state


def value(spark, column, **literals):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()]) if literals else spark.range(1)
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "raw,base,expected",
    [
        ("HTTPS://WWW.Example.org:443/data/?utm_source=t&b=2&a=1#s", None, "https://www.example.org/data/?a=1&b=2"),
        ("http://a.org:80", None, "http://a.org/"),
        ("http://a.org/x?y", None, "http://a.org/x?y="),
        ("../c.csv?x=~*", "https://a.org/p/q/r.html", "https://a.org/p/c.csv?x=~%2A"),
        ("//b.org/x", "https://a.org/p", "https://b.org/x"),
        ("?page=2", "https://a.org/p", "https://a.org/p?page=2"),
        ("mailto:x@y.z", None, "mailto:x@y.z"),
        ("http://a_b.org/p q|r", None, "http://a_b.org/p q|r"),
    ],
)
def test_normalize(spark, raw, base, expected):
    assert value(spark, U.normalize(F.col("raw"), None if base is None else F.lit(base)), raw=raw) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("Boletín Mayo 2026.pdf", "2026-05"), ("reporte_03_2025.xlsx", "2025-03"), ("serie-2024-11.csv", "2024-11"), ("Indicadores T2 2026", "2026-Q2"), ("Anuario 2023", "2023"), ("11 de septiembre de 2026", "2026-09-11"), ("2024/02/31", "2024-02-31"), ("1er trimestre 1999", "1999-Q1"), ("nada", None)],
)
def test_period(spark, text, expected):
    none = F.lit(None).cast("string")
    assert value(spark, T.period(none, F.col("t"), none, none, F.lit("")), t=text) == expected


def test_best_period_keeps_fields_apart(spark):
    assert value(spark, T.best_period(F.lit("Base 2016 = 100"), F.lit("5 de enero de 2021"))) == "2021-01-05"
    assert value(spark, T.best_period(F.lit("nada"), F.lit("x_03_2020"), F.lit("2021"))) == "2020-03"


@pytest.mark.parametrize(
    "title,context,url,expected",
    [("", "", "https://a.org/financiera_01_2026.xlsx", "financiera"), ("Descargar", "Reporte Financiero Mensual Mayo 2026 Descargar", "https://a.org/x.pdf", "reporte-financiero-mensual"), ("", "", "https://a.org/", "resource")],
)
def test_family_key(spark, title, context, url, expected):
    assert value(spark, T.family_key(F.col("t"), F.col("c"), F.lit(None).cast("string"), F.col("u")), t=title, c=context, u=url) == expected


def test_fold_and_slug(spark):
    assert value(spark, T.slugify(F.lit("Índice — Año Básico"))) == "indice-ano-basico"
    assert spark.createDataFrame([("N.º ﬁn",), (None,)], "t string").select(T.fold(F.col("t")).alias("v")).collect()[0].v == "n.o fin"


def test_extension(spark):
    assert value(spark, U.extension(F.lit("https://a.org/get?file=x.XLSX&y"))) == ".xlsx"
    assert value(spark, U.extension(F.lit("https://a.org/data.CSV?x=1"))) == ".csv"
    assert value(spark, U.extension(F.lit("https://a.org/page"))) == ""


def test_render_missing_capture_fails(spark):
    with pytest.raises(Exception, match="missing capture"):
        value(spark, T.render(F.lit("{a}-{b}"), F.create_map(F.lit("a"), F.lit("1"))))


def test_traps(spark):
    assert value(spark, frontier.trap(F.lit("http://a.org/x/x/x/x/y"))) == "REPEATED_PATH_SEGMENTS"
    assert value(spark, frontier.trap(F.lit("http://a.org/x/y/x/y"))) is None
    assert value(spark, frontier.trap(F.lit("http://a.org/?" + "&".join(f"k{i}=1" for i in range(13))))) == "TOO_MANY_QUERY_KEYS"


def test_change_then_no_change(spark):
    now = spark.createDataFrame([("s", "a", "1"), ("s", "b", "2")], "source_id string, resource_key string, evidence string")
    got = {r.resource_key: r.change_status for r in catalog.snapshot_diff(now, now.where("resource_key = 'a'").withColumn("evidence", F.lit("0"))).collect()}
    assert got == {"a": "MODIFIED", "b": "NEW"}
    assert {r.change_status for r in catalog.snapshot_diff(now, now).collect()} == {"UNCHANGED"}
    assert {r.change_status for r in catalog.snapshot_diff(now.limit(0), now).collect()} == {"REMOVED"}


def test_hash_ignores_order(spark):
    r = [("s", "a", "1"), ("s", "b", "2")]
    schema = "source_id string, resource_key string, evidence string"
    h = lambda x: catalog.resources_hash(spark.createDataFrame(x, schema), ["source_id"]).first().resources_hash
    assert h(r) == h(r[::-1])


def test_cadence_steps(spark):
    runs = spark.createDataFrame([(1, i, "NO_CHANGE") for i in range(9)] + [(1, 9, "CHANGED")], "source_id int, run_id int, status string").withColumn("ts", F.timestamp_seconds(F.col("run_id") * 86400))
    got = [r.cadence for r in state.cadence(runs).orderBy("run_id").collect()]
    assert got == ["DAILY"] * 6 + ["WEEKLY"] + ["MONTHLY"] * 2 + ["DAILY"]
    weekly = [r.cadence for r in state.cadence(runs, base="WEEKLY").orderBy("run_id").collect()]
    assert weekly[2:4] == ["WEEKLY", "MONTHLY"]


def test_backoff_and_retry_after(spark):
    assert value(spark, state.backoff(F.lit(3))) == 4.0
    now = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    got = [value(spark, state.retry_after(F.lit(v), now)) for v in ("5", "500", "Mon, 01 Jan 2024 00:00:30 GMT", "x", "-1", " ", "Sun, 31 Dec 2023 00:00:30 GMT")]
    assert got == [5.0, 120.0, 30.0, None, None, None, 0.0]


def test_api_ranks_at_least_as_api(spark):
    assert value(spark, projection.rank(F.lit("api"), F.lit("zip"))) == 98
    assert value(spark, projection.rank(F.lit("file"), F.lit("zip"))) == 80


def test_contract_requires_equal_captures(spark):
    rule = projection.Rule("r", {"url": r"/(?P<y>\d{4})/", "title": r"(?P<y>\d{4})"}, "serie {y}")
    df = spark.createDataFrame([("http://a/2020/", "x 2020"), ("http://a/2020/", "x 2021")], "url string, title string")
    assert [(r.contract_key, r.excluded) for r in projection.group_by_contract(df, [rule]).collect()] == [("serie-2020", False), (None, True)]


def test_files(spark):
    import gzip

    from lodestrata.functions import api as A
    from lodestrata.sources import files

    df = spark.createDataFrame([(bytearray(gzip.compress(b"abc")),), (bytearray(b"plain"),), (None,), (bytearray(gzip.compress(b"x" * 99)),)], "c binary")
    assert [bytes(r.v) if r.v is not None else None for r in df.select(files.gunzip(F.col("c"), 50).alias("v")).collect()] == [b"abc", b"plain", None, None]
    logs = spark.createDataFrame([(bytearray("GET https://a/x -> 200".encode(e)),) for e in ("utf-8", "utf-8-sig", "utf-16-le", "utf-16")], "c binary").select(files.decode_log(F.col("c")).alias("d")).select("d.*")
    assert {r.text for r in logs.collect()} == {"GET https://a/x -> 200"}
    assert [(r.method, r.code) for r in files.request_trace(logs.select("text"), "text").collect()] == [("GET", 200)] * 4
    nodes = spark.createDataFrame([(1, '{"a": {"resources": [{"u": 1}, 2]}}'), (2, "x"), (3, None)], "k int, body string")
    assert [r.node for r in files.json_nodes(nodes, "k", "body", "resources").collect()] == ['{"u": 1}', "2"]
    b = spark.createDataFrame([('{"b": 1, "a": "é"}', "json"), ('{"a": "é","b":1}', "json"), ("a\r\nb", "text"), ("a\nb", "text")], "b string, f string")
    h = [r.h for r in b.select(A.page_hash(F.col("b"), F.col("f")).alias("h")).collect()]
    assert h[0] == h[1] and h[2] == h[3] and h[0] != h[2]


def test_configs_and_sinks(spark, tmp_path):
    from lodestrata.sources import files, sinks

    (tmp_path / "c.json").write_text('{"sources": {"a": {"entrypoint": "https://WWW.a.org/x", "seeds": ["https://b.org/", "https://WWW.a.org/x"], "allowed_hosts": ["C.org"]}}}')
    c = files.source_configs(spark, str(tmp_path / "c.json"))
    assert [(r.ord, r.url) for r in files.seed_urls(c).collect()] == [(0, "https://WWW.a.org/x"), (1, "https://b.org/")]
    assert {r.host for r in files.scope_hosts(c).collect()} == {"www.a.org", "b.org", "c.org"}
    r = spark.createDataFrame([("s", "k2", "u2", "p"), ("s", "k1", "u1", "p")], "source_id string, resource_key string, url string, discovered_from_url string")
    docs = [sinks.snapshot_documents(r, ["source_id"], ["resource_key", "url"], f).first().document for f in ("map", "compact", "tree")]
    assert docs[0].startswith('{"k1":') and docs[1].startswith('[{"resource_key":"k1"') and '"discovered_from_url":"p"' in docs[2]
    sinks.write_partitions(r, str(tmp_path / "out"), ["source_id"])
    sums = sinks.checksums(spark, str(tmp_path / "out")).where("path like '%.json'")
    assert sinks.parse_checksums(sums.select(F.col("line").alias("value"))).where("n = 1").count() == sums.count() == 1
    assert sinks.zip_package([("b", b"2"), ("a", b"1")]) == sinks.zip_package([("a", b"1"), ("b", b"2")])


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    from lodestrata.streaming.health import run_available

    folder = tmp_path / "in"
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    half = e.selectExpr("percentile(unix_micros(cast(ts as timestamp)), 0.5) as m").first().m
    early = F.unix_micros(F.col("ts").cast("timestamp")) <= half
    e.where(early).write.parquet(str(folder))
    run_available(spark, str(folder), str(tmp_path / "c"), str(tmp_path / "o"))
    e.where(~early).write.mode("append").parquet(str(folder))
    run_available(spark, str(folder), str(tmp_path / "c"), str(tmp_path / "o"))
    got = {(r.source_id, r.run_id): (r.failures, r.health) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    from lodestrata.plans.catalog import QUERIES

    want = {(r.source_id, r.run_id): (r.failures, r.health) for r in QUERIES["health_state"](spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_api_expressions_stay_small(spark):
    """Each rule mentions the URL's extension and path once: nested mentions doubled the expression with every content type."""
    from lodestrata.functions import api as A

    u, kind = F.col("u"), F.col("c")
    df = spark.createDataFrame([("https://a.org/x", "text/csv; charset=x"), ("https://a.org/x.PDF", "text/csv"), ("https://a.org/ows/?SERVICE=wfs", "application/zip"), ("https://a.org", None), (None, "text/xml"), ("https://a.org/API?x", "")], "u string, c string")
    out = df.select(A.direct_extension(kind, u).alias("e"), A.is_api_url(u).alias("a"))
    assert [tuple(r) for r in out.collect()] == [(".csv", False), (".pdf", False), (".zip", True), ("", False), (".xml", None), ("", True)]
    assert len(out._jdf.queryExecution().analyzed().toString()) < 60_000


def test_excerpts_equal_the_plain_expression(spark):
    """Excerpts are those of one regular expression over the whole text, found without a search from every character."""
    texts = [None, "", "data", "x" * 500 + "DATA" + "y" * 100 + "data" + "z" * 1000 + "Data", "no match " * 50, "é" * 200 + "data" * 3 + "\n" + "😀" * 300 + "data\nend", ("a data b " * 100) + "tail " * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    found = F.regexp_extract_all("t", F.lit(r"(?is)(.{0,160}(?:data|end).{0,240})"), 1)
    plain = F.slice(F.array_distinct(F.transform(found, T.collapse)), 1, 5)
    for r in df.select("k", T.error_excerpts(F.col("t"), "data|end").alias("got"), plain.alias("want")).collect():
        assert r.got == r.want, r.k
    import time

    long = spark.range(20).select(F.concat(F.lit("data "), F.repeat(F.lit("abcdefgh "), 100_000)).alias("t"))
    began = time.perf_counter()
    assert long.where(F.size(T.error_excerpts(F.col("t"), "data")) == 1).count() == 20
    assert time.perf_counter() - began < 15  # linear in the text


def test_spread(spark):
    from lodestrata.sources.shared import spread

    df = spread(spark.range(1000).coalesce(1), "id", rows=100)
    assert df.count() == 1000 and df.rdd.getNumPartitions() == 11
