"""Queries of URL, HTTP, HTML and configuration functions, over the pages and over cases made of the orders."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import functions as F

from ..functions import api as A
from ..functions import html as H
from ..functions import text as T
from ..functions import urls as U
from ..operators import catalog, frontier, packages, resolution, state
from ..sources import files, sinks
from .registry import query
from .rules import CODES, _c, _holds, cases
from .views import shared_path, table

_API = ["/api/v1/x", "/openapi.json", "/geoserver/wfs", "/x?service=WFS", "/data.csv", "/graphql?query=a", "/graphql", "/swagger.yaml", "/wp-json/x", "/page", "/ows/", "/x?service=SOS", "/v3/api-docs", "/rest/a", "/files/b.PDF"]
_TYPES = ["application/json", "text/csv; charset=utf-8", "application/geo+json", "application/x-ndjson", "text/tab-separated-values", "application/pdf", "text/html", "application/xhtml+xml", "application/zip", "image/png", "application/x-yaml", "text/xml", "", None]
_web, _web_sql = cases({"path": _API, "kind": _TYPES, "method": ["get", "GET", "post"], "auth": [True, False, False]})
_OPENAPI = _holds("path", "openapi.json", "openapi.yaml", "openapi.yml", "swagger.json", "swagger.yaml", "swagger.yml", "/api-docs", "/v3/api-docs")


@query(f"""SELECT k, {_OPENAPI} AS openapi, {_OPENAPI} OR {_holds('path', '/api/', '/rest/', '/wp-json/', '/openapi', '/swagger', '/api-docs', '/geoserver/', '/graphql')} OR path IN ('/x?service=WFS', '/ows/') AS api,
CASE WHEN path = '/graphql' THEN 1 ELSE 0 END AS missing, upper(method) = 'GET' AND NOT auth AND path <> '/graphql' AS callable,
kind IS NULL OR kind = '' OR kind LIKE 'text/%' OR kind IN ('application/xhtml+xml', 'application/xml') AS markup,
CASE WHEN path = '/data.csv' THEN '.csv' WHEN path = '/files/b.PDF' THEN '.pdf' WHEN path = '/openapi.json' THEN '.json' WHEN path IN ('/swagger.yaml') AND false THEN '' WHEN kind = 'application/pdf' THEN '.pdf' WHEN kind LIKE 'text/csv%' THEN '.csv' WHEN kind = 'application/zip' THEN '.zip' WHEN kind = 'application/json' THEN '.json' WHEN kind = 'text/xml' THEN '.xml' ELSE '' END AS extension,
CASE WHEN kind = 'application/geo+json' THEN 'geojson' WHEN kind = 'application/x-ndjson' THEN 'ndjson' WHEN kind = 'application/json' THEN CASE WHEN {_OPENAPI} THEN 'openapi' ELSE 'json' END WHEN kind = 'text/xml' OR kind = 'application/xhtml+xml' THEN 'xml' WHEN kind LIKE 'text/tab%' THEN 'tsv' WHEN kind LIKE 'text/csv%' THEN 'csv' WHEN kind = 'application/x-yaml' AND {_OPENAPI} THEN 'openapi' END AS declared FROM ({_web_sql})""")
def api_predicates(spark, sf_dir):
    """F58, F59, F60, F61, F63, H07, X02."""
    w = _web(spark, sf_dir).withColumn("u", F.concat(F.lit("https://a.org"), "path"))
    u, missing = F.col("u"), A.unresolved_params(F.col("u"))
    return w.select("k", A.is_openapi_url(u).alias("openapi"), A.is_api_url(u).alias("api"), F.size(missing).alias("missing"), A.callable_by_policy(F.col("method"), F.col("auth"), missing).alias("callable"), A.is_markup(F.col("kind")).alias("markup"), A.direct_extension(F.col("kind"), u).alias("extension"), A.declared_format(F.col("kind"), u).alias("declared"))


_HOST_LIST = ["a.org", "www.a.org", "data.a.org", "b.net", "A.ORG"]
_urls, _urls_sql = cases({"scheme": ["http", "https", "ftp"], "host": _HOST_LIST, "path": ["/x/y.csv", "/x/", "/", "/api/data?format=json", "/img.png", "/download/1"], "title": ["A title", " ", None], "context": ["Around it", "", None], "label": ["HTML", "javascript", "sitemap", "api", "seed", "commented_html", "zz"]})


@query(f"""SELECT k, CASE WHEN trim(coalesce(title, '')) <> '' THEN title WHEN regexp_extract(regexp_extract(path, '^[^?]*'), '([^/]*)/*$', 1) <> '' THEN regexp_extract(regexp_extract(path, '^[^?]*'), '([^/]*)/*$', 1) ELSE u END AS title,
CASE WHEN trim(coalesce(title, '')) <> '' THEN title ELSE 'API GET ' || regexp_extract(path, '^[^?]*') END AS api_title, CASE WHEN trim(coalesce(context, '')) <> '' THEN context WHEN trim(coalesce(title, '')) <> '' THEN title ELSE u END AS description,
CASE lower(label) WHEN 'javascript' THEN 'rendered_dom' WHEN 'sitemap' THEN 'sitemap' WHEN 'api' THEN 'api_reference' WHEN 'seed' THEN 'seed' WHEN 'commented_html' THEN 'html_comment' ELSE 'html_link' END AS label,
scheme IN ('http', 'https') AND lower(host) IN ('a.org', 'b.net') AS allowed, lower(host) <> 'b.net' AS same_site, regexp_replace(u, '/+$', '') AS entrypoint, scheme || '://' || lower(host) || '/sitemap.xml' AS sitemap,
path IN ('/x/y.csv', '/api/data?format=json', '/download/1') AS data, len(list_distinct([u] || list_transform(['https://', 'https://www.', 'http://', 'http://www.'], lambda s: s || regexp_replace(lower(host), '^www\\.', '') || path)))::INT AS variants FROM (SELECT *, scheme || '://' || host || path AS u FROM ({_urls_sql}))""")
def url_scalars(spark, sf_dir):
    """F09, F20, F65, F72, F73, F75, P02, P03, U07, U08, Z08, Z11."""
    x = _urls(spark, sf_dir).withColumn("u", F.concat("scheme", F.lit("://"), "host", "path"))
    u, title = F.col("u"), F.col("title")
    return x.select(
        "k", resolution.effective_title(title, u).alias("title"), resolution.api_title(title, F.lit("get"), u).alias("api_title"), resolution.description(F.col("context"), F.lit(None).cast("string"), title, u).alias("description"),
        resolution.method_label(F.col("label")).alias("label"), resolution.redirect_allowed(u, F.array(F.lit("a.org"), F.lit("b.net"))).alias("allowed"), U.same_site(u, F.lit("https://www.a.org/")).alias("same_site"), U.entrypoint(u).alias("entrypoint"),
        resolution.default_sitemap(u).alias("sitemap"), resolution.looks_like_data(u).alias("data"), F.size(resolution.host_variants(u)).alias("variants"),
    )


_misc, _misc_sql = cases({"name": ["a.zip", "b.TAR", "c.csv", "d.tgz", "e.gz"], "path": ["ok/a.csv", "/abs", "../up", "a/../b", "a/..b"], "flow": ["HTTP-HTML", "Java Script", "api", "java_script"], "stamp": ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02 03:04:05", "none", None], "retry": ["5", " 500 ", "-1", "x", None], "attempt": [1, 2, 5], "artifacts": [0, 3, None], "logged": [0, 7, None], "methods": ["get", "post", "HEAD"], "link": ['"https://a.org/1"', '{"url": "https://a.org/2"}', '{"href": "/3"}', "https://a.org/4"], "records": [0, 4, None], "error": ["rc=2", None], "special": [True, False, None]})


@query(f"""SELECT k, name <> 'c.csv' AS archive, path IN ('/abs', '../up', 'a/../b') AS unsafe, CASE regexp_replace(lower(flow), '[^a-z0-9]', '', 'g') WHEN 'javascript' THEN 'js' ELSE regexp_replace(lower(flow), '[^a-z0-9]', '', 'g') END AS flow,
CASE stamp WHEN '2024-01-02T03:04:05Z' THEN TIMESTAMP '2024-01-02 03:04:05' WHEN '2024-01-02T03:04:05+02:00' THEN TIMESTAMP '2024-01-02 01:04:05' WHEN '2024-01-02 03:04:05' THEN TIMESTAMP '2024-01-02 03:04:05' END AS stamp,
CASE WHEN try_cast(trim(retry) AS DOUBLE) >= 0 THEN least(try_cast(trim(retry) AS DOUBLE), 120) END AS retry, 2.0 ^ (attempt - 1) AS backoff, greatest(coalesce(artifacts, 0), coalesce(logged, 0))::INT AS resources,
CASE WHEN coalesce(artifacts, 0) > 0 THEN 'L1' WHEN coalesce(logged, 0) > 0 THEN 'L0' ELSE 'NEG' END AS level, (methods = 'post')::INT AS forbidden, CASE WHEN link LIKE '"%' THEN trim(link, '"') WHEN link LIKE '{{%' THEN regexp_extract(link, ': "([^"]*)"', 1) ELSE link END AS link,
CASE WHEN special THEN CASE WHEN error IS NULL THEN 'ACQUISITION_JOB_READY' ELSE 'SPECIALIZATION_FAILED' END WHEN error IS NOT NULL THEN 'PROJECTION_FAILED' WHEN records > 0 THEN 'DATAX_READY' ELSE 'PROJECTION_EMPTY' END AS outcome FROM ({_misc_sql})""")
def bookkeeping_scalars(spark, sf_dir):
    """D02, D05, D06, F34, F66, F77, S13, Z15, Z39, Z40, Z55."""
    m = _misc(spark, sf_dir)
    level = resolution.probe_level(*_c("artifacts", "logged"))
    return m.select(
        "k", files.is_archive(F.col("name")).alias("archive"), catalog.unsafe_path(F.col("path")).alias("unsafe"), T.workflow_name(F.col("flow"), {"javascript": "js"}).alias("flow"), resolution.utc(F.col("stamp")).cast("timestamp_ntz").alias("stamp"),
        state.retry_after(F.col("retry"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("retry"), state.backoff(F.col("attempt")).alias("backoff"), level["resources"].alias("resources"), level["level"].alias("level"),
        F.size(resolution.forbidden_methods(F.array("methods"))).alias("forbidden"), packages.link_of(F.col("link")).alias("link"), packages.projection_outcome(*_c("records", "error", "special")).alias("outcome"),
    )


@query(f"""SELECT k, CASE WHEN code BETWEEN 200 AND 299 THEN 'rules' WHEN code BETWEEN 400 AND 499 AND code <> 429 THEN 'unavailable' ELSE 'unreachable' END AS kind, CASE WHEN seconds >= 900 THEN 'MAX_RUNTIME' WHEN requests >= 250 THEN 'REQUEST_BUDGET_REACHED' WHEN errors >= 5 THEN 'MAX_CONSECUTIVE_ERRORS' WHEN urls >= 250 THEN 'MAX_URLS' WHEN queued = 0 THEN 'QUEUE_EXHAUSTED' END AS stop FROM ({(_stops := cases({"code": [200, 204, 301, 404, 429, 500, 503, None], "seconds": [10, 900, 20], "requests": [1, 250, 3], "errors": [0, 5, 1], "urls": [10, 250, 20], "queued": [0, 4]}))[1]})""")
def crawl_stops(spark, sf_dir):
    """G08, S06."""
    s = _stops[0](spark, sf_dir)
    return s.select("k", frontier.robots_kind(F.col("code")).alias("kind"), frontier.stop_reason(*_c("queued", "urls", "seconds", "requests", "errors")).alias("stop"))


_ROBOTS = "# all\nUser-agent: LodeBot # us\nUser-agent: other\nCrawl-delay: 3\nDisallow: /x/\n\nDisallow: /never\nUser-agent: none\n\nUSER-AGENT: *\nDisallow: /private\nAllow: /private/ok\nDisallow: /tmp%20x\nDisallow:\nDisallow: /free\n"


@query("""WITH p AS (SELECT page_id, ['LodeBot/1.0', 'plain', 'OTHER-thing'][page_id % 3 + 1] AS agent, ['https://a.org/x/', 'https://a.org/private/ok/', 'https://a.org/tmp%20x/', 'https://a.org/free?n=', 'ftp://a.org/'][page_id % 5 + 1] || page_id AS url, [200, 204, 301, 404, 429, 503, NULL][page_id % 7 + 1] AS status, page_id % 11 = 0 AS skip, CASE page_id % 2 WHEN 0 THEN 'agreed' ELSE ' ' END AS reason FROM pages),
r AS (SELECT *, CASE WHEN agent = 'plain' THEN url NOT LIKE '%/private/%' AND url NOT LIKE '%/tmp%' ELSE url NOT LIKE '%/x/%' END AS open FROM p),
d AS (SELECT page_id, CASE WHEN url LIKE 'ftp%' THEN 'INVALID_URL' WHEN skip AND reason = ' ' THEN 'ROBOTS_OVERRIDE_REASON_REQUIRED' WHEN skip THEN 'ROBOTS_OVERRIDE' WHEN status = 404 THEN 'ROBOTS_UNAVAILABLE_ALLOW' WHEN status IS NULL OR status NOT IN (200, 204) THEN 'ROBOTS_UNREACHABLE' WHEN open THEN 'ROBOTS_ALLOWED' ELSE 'ROBOTS_DISALLOWED' END AS code FROM r)
SELECT page_id, 'https://a.org/private/' || page_id AS sitemap, code IN ('ROBOTS_OVERRIDE', 'ROBOTS_UNAVAILABLE_ALLOW', 'ROBOTS_ALLOWED') AS allowed, code FROM d""")
def robots_decisions(spark, sf_dir):
    """Three agents, one of them without a group of its own; the first matching rule decides, not the longest."""
    i = F.col("page_id").cast("string")
    pick = lambda values: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.col("page_id") % len(values) + 1).cast("int"))
    text = F.concat(F.lit(_ROBOTS), F.lit("SiteMap:  https://a.org/private/"), i, F.lit("\nsitemap: https://a.org/private/"), i)
    p = table(spark, sf_dir, "pages").withColumns({"robots": text, "agent": pick(["LodeBot/1.0", "plain", "OTHER-thing"]), "status": pick([200, 204, 301, 404, 429, 503, None]).cast("int")})
    p = p.withColumn("target", F.concat(pick(["https://a.org/x/", "https://a.org/private/ok/", "https://a.org/tmp%20x/", "https://a.org/free?n=", "ftp://a.org/"]), i))
    decision = frontier.robots_decision(F.col("status"), F.col("robots"), F.col("target"), F.col("agent"), F.col("page_id") % 11 == 0, F.when(F.col("page_id") % 2 == 0, "agreed").otherwise(" "))
    return p.select("page_id", frontier.robots_sitemaps(F.col("robots"))[0].alias("sitemap"), decision.alias("d")).select("page_id", "sitemap", "d.*")


@query("""WITH p AS (SELECT page_id AS i, page_id // 4 * 4 + 3 AS last, (SELECT max(page_id) FROM pages) AS most FROM pages)
SELECT 'http://a/' || i AS start, 'http://a/' || CASE WHEN i = last THEN i WHEN i = most THEN i + 1 WHEN i % 3 = 0 THEN least(i + 2, last, most + 1) ELSE least(last, most + 1) END AS url,
  CASE WHEN i = last THEN 200 WHEN i % 3 = 0 AND i + 2 <= last THEN NULL WHEN least(last, most + 1) = last AND last <= most THEN 200 END AS status, CASE WHEN i = last THEN 'POST' ELSE 'GET' END AS method,
  (CASE WHEN i = last THEN 0 WHEN i = most THEN 1 WHEN i % 3 = 0 THEN least(i + 2, last, most + 1) - i ELSE least(last, most + 1) - i END)::INT AS redirects,
  CASE WHEN i = last THEN 'FINAL' WHEN i % 3 = 0 AND i + 2 <= least(last, most + 1) THEN 'REQUEST_BUDGET_EXCEEDED' WHEN least(last, most + 1) = last AND last <= most THEN 'FINAL' ELSE 'NOT_CAPTURED' END AS outcome FROM p
UNION ALL SELECT 'http://loop/' || i, 'http://loop/' || i, NULL, 'HEAD', 2, 'REDIRECT_LOOP' FROM p
UNION ALL SELECT 'http://odd/' || i, 'http://odd/' || i, CASE i % 4 WHEN 3 THEN NULL ELSE 302 END, 'GET', 0, ['REDIRECT_LOCATION_MISSING', 'INVALID_REDIRECT_URL', 'REDIRECT_OUT_OF_SCOPE', 'TIMEOUT'][i % 4 + 1] FROM p
UNION ALL SELECT 'http://far/' || i, 'http://far/' || i, NULL, 'GET', 0, 'REDIRECT_OUT_OF_SCOPE' FROM p
UNION ALL SELECT 'http://long/' || i || '/0', 'http://long/' || i || '/5', 301, 'GET', 5, 'TOO_MANY_REDIRECTS' FROM p""")
def redirect_chains(spark, sf_dir):
    """Pages redirect to their successor up to the fourth of each four, some with a budget of two requests; hosts that redirect
    to each other, odd answers, a host out of scope, chains that are too long."""
    at = lambda host, c, end="": F.concat(F.lit(f"http://{host}/"), c.cast("string"), F.lit(end))
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    none, last = F.lit(None).cast("string"), F.col("page_id") % 4 == 3
    odd = F.element_at(F.array(F.lit(""), F.lit("mailto:a@b"), F.lit("http://else/1"), F.lit("/x")), (i % 4 + 1).cast("int"))
    r = p.select(at("a", i).alias("url"), F.when(last, 200).otherwise(303).alias("status"), F.when(~last, F.concat(F.lit("/"), (i + 1).cast("string"))).alias("location"), none.alias("error"))
    r = r.union(p.select(at("loop", i), F.lit(302), at("back", i), none)).union(p.select(at("back", i), F.lit(307), at("loop", i), none)).union(p.select(at("odd", i), F.when(~last, 302), odd, F.when(last, "TIMEOUT")))
    for k in range(7):
        r = r.union(p.select(at("long", i, f"/{k}"), F.lit(301), F.lit(str(k + 1)), none))
    scope = F.array(*map(F.lit, ["a", "loop", "back", "odd", "long"]))
    starts = [("a", "", "post", F.when(i % 3 == 0, 2)), ("loop", "", "HEAD", F.lit(None)), ("odd", "", None, F.lit(None)), ("far", "", None, F.lit(None)), ("long", "/0", None, F.lit(None))]
    s = None
    for host, end, method, budget in starts:
        one = p.select(at(host, i, end).alias("url"), F.lit(method).cast("string").alias("method"), scope.alias("hosts"), budget.cast("int").alias("budget"))
        s = one if s is None else s.union(one)
    return frontier.redirect_chain(r, s)


@query("SELECT 's' || page_id % 5 AS source_id, 'https://a.org/' || page_id || '?x=1' AS link FROM pages")
def sitemap_scan(spark, sf_dir):
    """A document of each source with its pages twice, a tracking parameter and a host out of scope."""
    loc = lambda end: F.concat(F.lit("<url><loc> https://A.org/"), F.col("page_id").cast("string"), F.lit(end))
    one = F.concat(loc("?x=1&amp;utm_source=f</loc></url>"), loc("?x=1</loc></url><url><loc>https://b.org/3</loc></url>"))
    docs = table(spark, sf_dir, "pages").select(F.concat(F.lit("s"), (F.col("page_id") % 5).cast("string")).alias("source_id"), one.alias("x")).groupBy("source_id").agg(F.concat(F.lit("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>"), F.array_join(F.collect_list("x"), ""), F.lit("</urlset>")).alias("xml"))
    docs = docs.select("source_id", F.lit("https://a.org/sitemap.xml").alias("url"), "xml")
    return H.sitemap_entries(docs, docs.select("source_id", F.lit("a.org").alias("host")), max_urls=1 << 30).select("source_id", "link")


@query("""SELECT page_id, '/items/' || page_id AS path, 'https://a.org/v1/items/' || page_id AS url, CASE WHEN page_id % 2 = 0 THEN 'json' ELSE 'csv' END AS format, page_id % 2 = 1 AS auth_required, (page_id % 2)::INT AS missing FROM pages""")
def openapi_operations(spark, sf_dir):
    """X10-X14, Z14, through a Python table function: a specification of each page with one GET operation."""
    i = F.col("page_id").cast("string")
    get = F.when(F.col("page_id") % 2 == 0, F.lit('{"security": [{}], "responses": {"200": {"content": {"application/json": {}}}}}')).otherwise(F.lit('{"parameters": [{"name": "q", "in": "query", "required": true}], "responses": {"200": {"content": {"text/csv": {}}}}}'))
    doc = F.concat(F.lit('{"openapi": "3.0.0", "servers": [{"url": "/{v}", "variables": {"v": {"default": "v1"}}}], "security": [{"key": []}], "paths": {"/items/'), i, F.lit('": {"post": {}, "get": '), get, F.lit("}}}"))
    d = table(spark, sf_dir, "pages").select(F.concat(F.lit("https://a.org/openapi.json?"), i).alias("url"), doc.alias("body"))
    return A.openapi_operations(d.union(d.select("url", F.lit("x")))).select(F.substring_index("url", "?", -1).cast("long").alias("page_id"), "path", F.col("url_of_operation").alias("url"), "format", "auth_required", F.size("unresolved").alias("missing"))


_BODY = {
    "list": ("concat('[{\"a\": ', page_id, '}, {\"a\": 2}]')", "application/json"), "geo": ("concat('{\"type\": \"FeatureCollection\", \"features\": [1, 2, ', page_id, ']}')", ""), "csv": ("concat('a,b\\n1,2\\n', page_id, ',4\\n')", "text/csv"),
    "ndjson": ("concat('{\"a\": 1}\\n{\"a\": ', page_id, '}\\n')", "application/x-ndjson"), "xml": ("concat('<?xml version=\"1.0\"?><x>', page_id, '</x>')", ""), "paged": ("concat('{\"items\": [1], \"next\": \"/x?page=', page_id, '\"}')", "application/json"),
}


@query("""SELECT page_id, kind, CASE kind WHEN 'list' THEN 'json' WHEN 'geo' THEN 'geojson' WHEN 'paged' THEN 'json' ELSE kind END AS format, CASE kind WHEN 'geo' THEN 3 WHEN 'paged' THEN 1 WHEN 'xml' THEN NULL ELSE 2 END::BIGINT AS records,
CASE kind WHEN 'list' THEN 'LIST_RECORDS' WHEN 'geo' THEN 'ARRAY_FIELD:features' WHEN 'paged' THEN 'ARRAY_FIELD:items' ELSE 'INVALID' END AS shape, kind = 'paged' AS has_pagination, CASE WHEN kind = 'paged' THEN 'https://a.org/x?page=' || page_id END AS next_url, 'GET https://a.org/x' AS identity
FROM (SELECT page_id, ['list', 'geo', 'csv', 'ndjson', 'xml', 'paged'][page_id % 6 + 1] AS kind FROM pages)""")
def api_bodies(spark, sf_dir):
    """G04, G06, X01, X03, X04, X06, X15, Z32."""
    names = list(_BODY)
    kind = F.element_at(F.array(*map(F.lit, names)), (F.col("page_id") % len(names) + 1).cast("int"))
    pick = lambda k: F.expr("CASE kind " + " ".join(f"WHEN '{n}' THEN {v[0] if k == 0 else repr(v[1])}" for n, v in _BODY.items()) + " END")
    b = table(spark, sf_dir, "pages").select("page_id", kind.alias("kind")).withColumns({"body": pick(0), "content_type": pick(1)}).withColumn("url", F.lit("https://a.org/x"))
    nxt = A.next_page(F.col("body"), F.lit(None).cast("string"), F.col("url"))
    return packages.api_catalog(b.withColumn("next_url", F.when(F.col("kind") == "paged", nxt["next_url"]))).select("page_id", "kind", "format", "records", "shape", "has_pagination", "next_url", "identity")


_NEXT_KINDS = ["header", "json", "number", "other", "same", "none", "cursor", "meta", "port", "mail", "last", "list"]


@query(f"""SELECT o_orderkey AS k, {_NEXT_KINDS}[o_orderkey % {len(_NEXT_KINDS)} + 1] AS kind,
CASE kind WHEN 'header' THEN 'https://a.org/x?page=' || o_orderkey WHEN 'json' THEN 'https://a.org/x?page=' || o_orderkey WHEN 'number' THEN 'https://a.org/x?page_number=' || (o_orderkey + 1) || '&q=1' WHEN 'cursor' THEN 'https://a.org/x?cursor=c' || o_orderkey WHEN 'meta' THEN 'https://a.org/x?offset=' || o_orderkey END AS next_url,
CASE kind WHEN 'header' THEN 'http_link_next' WHEN 'json' THEN 'json_next' WHEN 'number' THEN 'numeric_page' WHEN 'cursor' THEN 'cursor' WHEN 'meta' THEN 'json_meta_next' END AS strategy,
CASE kind WHEN 'other' THEN 'NEXT_HOST_CHANGED' WHEN 'same' THEN 'SAME_PAGE' WHEN 'port' THEN 'NEXT_IDENTITY_CHANGED' WHEN 'mail' THEN 'INVALID_NEXT' WHEN 'none' THEN 'NO_EXPLICIT_NEXT' WHEN 'last' THEN 'NO_EXPLICIT_NEXT' WHEN 'list' THEN 'NO_EXPLICIT_NEXT' ELSE 'OK' END AS reason FROM orders""")
def api_next_page(spark, sf_dir):
    """X05, X06, X07, X08."""
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", f"element_at(array{tuple(_NEXT_KINDS)}, cast(o_orderkey % {len(_NEXT_KINDS)} + 1 as int)) AS kind", "cast(o_orderkey as string) AS s")
    body = """CASE kind WHEN 'json' THEN concat('{"Next": "/x?page=', s, '"}') WHEN 'number' THEN concat('{"page": ', s, ', "totalPages": ', k + 5, '}') WHEN 'last' THEN concat('{"page": ', s, ', "total_pages": ', s, '}')
    WHEN 'other' THEN '{"next": "https://b.org/x?page=3"}' WHEN 'same' THEN '{"next": "/x"}' WHEN 'port' THEN '{"next_url": "https://a.org:8443/x?page=2"}' WHEN 'mail' THEN '{"next": {"href": "mailto:a@b.c"}}'
    WHEN 'meta' THEN concat('{"next": " ", "links": [1], "META": {"next": {"url": "", "href": "?offset=', s, '"}}}') WHEN 'none' THEN '{"next": null, "cursor": "c"}' WHEN 'cursor' THEN concat('{"next_cursor": "c', s, '"}') ELSE '[{"next": "/x?page=1"}]' END"""
    link = """CASE WHEN kind = 'header' THEN concat('<https://a.org/y>; rel="prev", <https://a.org/x?page=', s, '>; title="t"; rel=next') END"""
    url = "CASE kind WHEN 'number' THEN concat('https://a.org/x?page_number=', s, '&q=1') WHEN 'last' THEN concat('https://a.org/x?page=', s) WHEN 'json' THEN 'https://a.org/x?page=2' WHEN 'cursor' THEN 'https://a.org/x?cursor=0' ELSE 'https://a.org/x' END"
    return o.select("k", "kind", A.next_page(F.expr(body), F.expr(link), F.expr(url)).alias("n")).select("k", "kind", "n.*")


@query("SELECT page_id::VARCHAR AS path, 'a/' || page_id || '.csv' AS filename, strlen(html)::BIGINT AS size_bytes, '.csv' AS extension FROM pages WHERE page_id % 3 <> 2")
def archive_listing(spark, sf_dir):
    """Archives of the pages (ZIP, TAR, or none at all), made and read in Python on Arrow batches."""

    def make(frames):
        import io
        import tarfile

        for f in frames:
            out = []
            for i, html in zip(f["page_id"], f["html"], strict=True):
                data, name = html.encode(), f"a/{i}.csv"
                if i % 3 == 0:
                    content = sinks.zip_package([(name, data), ("a/.hidden", b"x")])
                else:
                    t = io.BytesIO()
                    with tarfile.open(fileobj=t, mode="w") as tar:
                        info = tarfile.TarInfo(name)
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
                    content = t.getvalue() if i % 3 == 1 else data
                out.append((str(i), content))
            yield pd.DataFrame(out, columns=["path", "content"])

    return files.archive_entries(table(spark, sf_dir, "pages").select("page_id", "html").mapInPandas(make, "path string, content binary"))


@query("""SELECT lower(n_name) AS source_id, u AS url, (o - 1)::INT AS ord, 'n' || n_nationkey || '.org' AS host FROM (SELECT *, unnest(CASE WHEN n_nationkey % 2 = 0 THEN ['https://n' || n_nationkey || '.org/'] ELSE ['https://n' || n_nationkey || '.org/', 'https://n' || n_nationkey || '.org/b'] END) AS u, generate_subscripts(CASE WHEN n_nationkey % 2 = 0 THEN [1] ELSE [1, 2] END, 1) AS o FROM nation)""")
def config_seeds(spark, sf_dir):
    """Nations as a configuration file in the shared folder, read back; a
    control table of 25 rows."""
    site = lambda r: f"https://n{r.n_nationkey}.org/"
    rows = {r.n_name.lower(): {"entrypoint": site(r), "seeds": [site(r)] + ([site(r) + "b"] if r.n_nationkey % 2 else []), "allowed_hosts": [f"N{r.n_nationkey}.org "]} for r in table(spark, sf_dir, "nation").collect()}
    path = shared_path(spark, f"config-{uuid.uuid4().hex}")
    spark.createDataFrame([(json.dumps({"sources": rows}),)], "value string").coalesce(1).write.text(path)
    configs = packages.require_rows(files.source_configs(spark, files.latest_file(spark, path + "/*.txt").first().path), len(rows))
    assert resolution.only_source(configs, "NATION_1").first().source_id == "nation_1"
    return files.seed_urls(configs).join(files.scope_hosts(configs), "source_id")


@query("SELECT lower(n_name) AS source_id, stage, max_depth::INT AS max_depth, max_urls::INT AS max_urls, apis AS discover_apis FROM nation, (VALUES ('recovery', 1, 20, false), ('expanded_html', 2, 60, false), ('api_enriched', 2, 60, true)) s(stage, max_depth, max_urls, apis)")
def stage_plans(spark, sf_dir):
    """P08, P09."""
    return packages.stage_configs(table(spark, sf_dir, "nation").select(F.lower("n_name").alias("source_id"), F.lit("https://x.org").alias("entrypoint"))).select("source_id", "stage", "max_depth", "max_urls", "discover_apis")


@query("""SELECT s_suppkey AS source_id, '{"schema":"acquisition-v1","source_id":' || s_suppkey || ',"entrypoint":"https://s.org","method":"GET"}' AS job FROM supplier WHERE s_nationkey % 2 = 1""")
def acquisition_jobs(spark, sf_dir):
    """P11, Z30."""
    return packages.acquisition_jobs(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"), F.lit("https://s.org").alias("entrypoint"), F.when(F.col("s_nationkey") % 2 == 1, "ACQUISITION").otherwise("X").alias("classification")))


@query("""SELECT o_orderkey, o AS ord, 'https://a.org/' || o_orderkey || CASE o WHEN 0 THEN '/x' ELSE '/y' END AS url, CASE o WHEN 0 THEN 'GET' ELSE 'HEAD' END AS method, CASE o WHEN 0 THEN 200 ELSE 404 END AS code FROM orders, (SELECT unnest([0, 1])::INT AS o)""")
def trace_requests(spark, sf_dir):
    """S22."""
    i = F.col("o_orderkey").cast("string")
    text = F.concat(F.lit("[INFO] GET https://a.org/"), i, F.lit('/x "HTTP/1.1 200 OK"\nHEAD https://a.org/'), i, F.lit("/y -> 404\nnothing"))
    return files.request_trace(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("log")), "log")


@query("""SELECT conv_id, turn, replace(replace(text, chr(13), ''), chr(0), '') || 'red' AS plain, 'error ' || turn AS last_error, 'UTF-8' AS charset FROM conversations""")
def log_texts(spark, sf_dir):
    """F35, F37, S21, Z26."""
    c = table(spark, sf_dir, "conversations")
    colored = F.concat("text", F.lit("\x1b[31mred\r\x1b[0m"))
    lines = F.concat(F.lit("fine\nerror 0\nok\nerror "), F.col("turn").cast("string"), F.lit("\nfine"))
    return c.select("conv_id", "turn", T.plain_log(colored).alias("plain"), resolution.interesting_lines(lines, "error", 1).alias("last_error"), files.decode_log(F.col("text").cast("binary"))["charset"].alias("charset"))


@query("SELECT conv_id, turn, text AS inflated, text AS decoded FROM conversations")
def decoded_bodies(spark, sf_dir):
    """Texts compressed and encoded in Python, then inflated and decoded."""
    @F.pandas_udf("binary")
    def squeeze(t: pd.Series) -> pd.Series:
        import gzip

        return t.map(lambda x: gzip.compress(x.encode()) if x is not None else None)

    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", files.gunzip(squeeze("text"), 1 << 24).cast("string").alias("inflated"), resolution.decode_body(F.encode("text", "UTF-16"), F.lit("text/html; charset=utf-16")).alias("decoded"))


@query("SELECT o_orderkey, 'https://a.org/' || o_orderkey || '.csv' AS link FROM orders UNION ALL SELECT o_orderkey, 'https://a.org/' || o_orderkey || '.pdf' FROM orders")
def json_file_links(spark, sf_dir):
    """X16, S19, S20."""
    i = F.col("o_orderkey").cast("string")
    body = F.concat(F.lit('{"meta": {}, "items": [{"url": "https://a.org/'), i, F.lit('.csv"}, {"link": "https://a.org/page"}, {"download_url": "https://a.org/'), i, F.lit('.pdf"}]}'))
    return resolution.file_links(table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body")), "o_orderkey", "body")


@query("""SELECT page_id, o AS ord, CASE o WHEN 0 THEN '{"a": ' || page_id || '}' ELSE '1' END AS node FROM pages, (SELECT unnest([0, 1])::INT AS o)""")
def json_tree_nodes(spark, sf_dir):
    """S19, S20, through a Python table function."""
    body = F.concat(F.lit('{"x": [{"resources": [{"a": '), F.col("page_id").cast("string"), F.lit("}]}, {\"y\": {\"resources\": [1]}}]}"))
    return files.json_nodes(table(spark, sf_dir, "pages").select("page_id", body.alias("body")), "page_id", "body", "resources")


@query("""SELECT page_id, o AS ord, CASE o WHEN 0 THEN 'link' WHEN 1 THEN 'data' ELSE 'openapi' END AS kind, 'https://a.org/' || page_id || CASE o WHEN 0 THEN '/feed.json' WHEN 1 THEN '/api' ELSE '/openapi.json' END AS link FROM pages, (SELECT unnest([0, 1, 2])::INT AS o)""")
def api_references(spark, sf_dir):
    """H04, H05."""
    i = F.col("page_id").cast("string")
    html = F.concat(F.lit('<link rel="alternate" type="application/json" href="/'), i, F.lit('/feed.json"><link rel="icon" href="/i.png"><div data-api-url="/'), i, F.lit('/api"></div><script>SwaggerUI({url: "/'), i, F.lit('/openapi.json"})</script>'))
    return H.api_references(table(spark, sf_dir, "pages").select("page_id", F.lit("https://a.org/start").alias("url"), html.alias("html"))).select("page_id", "ord", "kind", "link")


@query("SELECT page_id, 'https://a.org/hidden/' || page_id AS link FROM pages")
def commented_links(spark, sf_dir):
    """G02, H03."""
    html = F.concat(F.lit('<a href="/seen">x</a><!-- <a href="/hidden/'), F.col("page_id").cast("string"), F.lit('">y</a> -->'))
    return H.comment_links(table(spark, sf_dir, "pages").select("page_id", F.lit("https://a.org/start").alias("url"), html.alias("html"))).select("page_id", "link")


@query("SELECT 'https://a.org/p' || page_id AS page_url, 'https://a.org/s?q=a+b&n=' || page_id AS url FROM pages")
def form_queries(spark, sf_dir):
    """Z34."""
    field = lambda name, kind, value: F.struct(F.lit(name).alias("name"), F.lit(kind).cast("string").alias("type"), value.alias("value"))
    fields = F.array(field("q", "text", F.lit("a b")), field("n", None, F.col("page_id").cast("string")), field("pw", "password", F.lit("1")))
    f = table(spark, sf_dir, "pages").select(F.concat(F.lit("https://a.org/p"), F.col("page_id").cast("string")).alias("page_url"), F.lit("/s").alias("action"), F.lit("get").alias("method"), fields.alias("fields"))
    return resolution.form_queries(f.union(f.select("page_url", F.lit("https://b.org/"), "method", "fields")).union(f.select("page_url", "action", F.lit("post"), "fields")))


@query("SELECT user_id, 'a,b,c' AS names, '2' AS a, (count(*) FILTER (event_type = 'view'))::INT AS many FROM events GROUP BY 1")
def header_maps(spark, sf_dir):
    """Z05, Z28, Z33."""
    merged = resolution.headers(F.create_map(F.lit("A"), F.lit("1"), F.lit("b"), F.lit("x")), F.create_map(F.lit("a"), F.lit("2"), F.lit("C"), F.lit("y")))
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(F.when(F.col("event_type") == "view", F.col("event_id").cast("string"))).alias("urls"))
    return e.select("user_id", F.array_join(F.array_sort(F.map_keys(merged)), ",").alias("names"), merged["a"].alias("a"), F.size(packages.candidate_urls(F.col("urls"), F.col("urls"))).alias("many"))


@query("SELECT n_regionkey, count(*) AS files, count(*) AS rows, count(*) FILTER (ok) AS hashed FROM (SELECT *, true AS ok FROM nation) GROUP BY 1")
def package_files(spark, sf_dir):
    """Nations written as one JSON file each, appended as Parquet, read back with checksums."""
    path = shared_path(spark, f"package-{uuid.uuid4().hex}")
    n = table(spark, sf_dir, "nation")
    sinks.write_partitions(n, f"{path}/json", ["n_regionkey", "n_nationkey"])
    sinks.append(n.where("n_nationkey < 10"), f"{path}/log", ["n_regionkey"])
    sinks.append(n.where("n_nationkey >= 10"), f"{path}/log", ["n_regionkey"])
    c = sinks.checksums(spark, f"{path}/json").where("path LIKE '%.json'")
    c = c.groupBy(F.regexp_extract("path", r"n_regionkey=(\d+)", 1).cast("long").alias("n_regionkey")).agg(F.count("*").alias("files"), F.count_if(F.length("sha256") == 64).alias("hashed"))
    return c.join(spark.read.parquet(f"{path}/log").groupBy(F.col("n_regionkey").cast("long").alias("n_regionkey")).agg(F.count("*").alias("rows")), "n_regionkey").select("n_regionkey", "files", "rows", "hashed")


@query("""SELECT n_regionkey, count(*)::INT AS items, max(length('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}'))::INT AS longest FROM nation GROUP BY 1""")
def snapshot_exports(spark, sf_dir):
    """K01 in its three forms: as many items in each."""
    n = table(spark, sf_dir, "nation").withColumns({"resource_key": F.col("n_name"), "discovered_from_url": F.lit("https://a.org")})
    form = lambda f: sinks.snapshot_documents(n, ["n_regionkey"], ["n_nationkey", "n_name"], f).withColumnRenamed("document", f)
    d = form("map").join(form("compact"), "n_regionkey").join(form("tree"), "n_regionkey")
    items = F.json_array_length("compact")
    same = (F.size(F.json_object_keys("map")) == items) & (F.json_array_length(F.get_json_object("tree", "$[0].resources")) == items)
    longest = F.array_max(F.transform(F.from_json("compact", "array<struct<n_nationkey:bigint,n_name:string>>"), lambda x: F.length(F.to_json(x))))
    return d.where(same).select("n_regionkey", items.alias("items"), longest.alias("longest"))


@query("SELECT c_custkey AS config, CASE WHEN c_custkey % 3 = 0 THEN 'KEPT_BY_ID' WHEN c_custkey % 3 = 1 THEN 'KEPT_BY_URL' ELSE 'GENERATED' END AS origin FROM customer")
def promoted_configs(spark, sf_dir):
    """P10, Z59."""
    c = table(spark, sf_dir, "customer")
    i = F.col("c_custkey").cast("string")
    current = c.select(F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("S"), i)).otherwise(F.concat(F.lit("old"), i)).alias("source_id"), F.when(F.col("c_custkey") % 3 == 2, F.lit("https://shared.org")).otherwise(F.concat(F.lit("https://C"), i, F.lit(".org/"))).alias("entrypoint"))
    desired = c.select(F.concat(F.lit("s"), i).alias("source_id"), F.when(F.col("c_custkey") % 3 == 2, F.lit("https://shared.org/")).otherwise(F.concat(F.lit("https://c"), i, F.lit(".org"))).alias("entrypoint"))
    return packages.promoted(current, desired).select(F.substring("source_id", 2, 20).cast("long").alias("config"), "origin")


@query("SELECT p_brand AS source_id, 'files/' || min(p_partkey) AS path, CASE WHEN count(*) = 1 THEN 'OK' ELSE 'AMBIGUOUS' END AS outcome FROM (SELECT *, min(p_partkey % 2) OVER (PARTITION BY p_brand) AS m FROM part) WHERE p_partkey % 2 = m GROUP BY 1")
def chosen_files(spark, sf_dir):
    """Z48, Z49, Z68."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("source_id"), F.concat(F.lit("files/"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("path"), (F.col("p_partkey") % 2 == 0).alias("canonical"))
    return packages.choose_file(p, "source_id", F.col("canonical")).select("source_id", F.concat(F.lit("files/"), F.substring("path", 7, 9).cast("long").cast("string")).alias("path"), "outcome")
