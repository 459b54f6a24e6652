"""Registered queries of the API crawl, over responses made from orders (endpoints) and line items (their pages)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import api_crawl as C
from ..sources.shared import store
from .registry import query
from .views import table

# A customer is a source, its orders are its seeds. By the order's key modulo 11: 0 times out, 1 is a specification of 1 to 4
# operations, 2 a page with a link and two specifications (one of them a page that names a third), 3 no JSON though promised,
# 4 too large, else data, whose pages are its line items.


def captured(spark, sf_dir: str):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("k"))
    o = o.withColumn("kind", F.col("k") % 11).withColumn("h", F.concat(F.lit("https://h"), (F.col("c") % 5).cast("string"), F.lit(".org")))
    path = F.expr("CASE kind WHEN 1 THEN concat('/spec', k, '/openapi.json') WHEN 2 THEN concat('/landing', k) ELSE concat('/api/o', k, '?page=1') END")
    o = store(o.withColumn("url", F.concat("h", path)))
    sources = o.groupBy(F.col("c").alias("source_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "url"))), lambda x: x["url"]).alias("seeds"))
    sources = sources.select("source_id", "seeds", *[e.alias(n) for n, e in (("max_requests", (4 + F.col("source_id") % 9).cast("int")), ("max_endpoints", (3 + F.col("source_id") % 4).cast("int")), ("max_records", F.lit(5)), ("max_documents", F.lit(5)))])

    none = F.lit(None).cast("string")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax"))
    i = table(spark, sf_dir, "lineitem").withColumn("p", place).join(o.where("kind > 4"), F.col("l_orderkey") == F.col("k"))
    n = i.groupBy("k").agg(F.max("p").alias("n"))
    i = i.join(n, "k").withColumn("shown", F.when((F.col("p") > 1) & (F.col("l_discount") >= 0.09), 1).otherwise(F.col("p")))
    own = i.groupBy("k").agg(F.max_by(F.col("l_quantity") > 15, -F.col("p")).alias("first"))
    i = i.join(own, "k").withColumn("full", F.when(F.col("shown") == 1, F.col("first")).otherwise(F.col("l_quantity") > 15))
    body = F.concat(F.lit('{"items": ['), F.when(F.col("full"), "1, 2").otherwise(""), F.lit('], "page": '), F.col("shown").cast("string"), F.lit(', "total_pages": '), F.col("n").cast("string"), F.lit("}"))
    bad = F.when((F.col("p") > 1) & (F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.07), "HTTP_403")
    table_ = (F.col("p") > 1) & (F.month("l_shipdate") == 3)
    pages = i.select(F.concat("h", F.lit("/api/o"), F.col("k").cast("string"), F.lit("?page="), F.col("p").cast("string")).alias("url"), bad.alias("error"), F.when(table_, F.concat(F.lit("a,b\n"), F.col("p").cast("string"))).otherwise(body).alias("body"), F.when(table_, "text/csv").otherwise("application/json").alias("content_type"))

    def spec(paths):
        return F.concat(F.lit('{"openapi": "3.0.0", "paths": {'), F.array_join(F.transform(paths, lambda x: F.concat(F.lit('"'), x, F.lit('": {"get": {}}'))), ", "), F.lit("}}"))

    k, html, json = F.col("k").cast("string"), "text/html", "application/json"
    made = [
        ("kind = 0", F.col("url"), F.lit("TIMEOUT"), none, none),
        ("kind = 1", F.col("url"), none, spec(F.transform(F.sequence(F.lit(0), F.col("k") % 4), lambda x: F.concat(F.lit("/v"), k, F.lit("/"), x.cast("string")))), F.lit(json)),
        ("kind = 2", F.col("url"), none, F.concat(F.lit('<a href="/api/list'), k, F.lit('">x</a> <a href="/docs'), k, F.lit('/openapi.json">y</a> <a href="/docs'), k, F.lit('/swagger.json">z</a>')), F.lit(html)),
        ("kind = 2", F.concat("h", F.lit("/docs"), k, F.lit("/openapi.json")), none, spec(F.transform(F.array(F.lit("a"), F.lit("b")), lambda x: F.concat(F.lit("/w"), k, F.lit("/"), x))), F.lit(json)),
        ("kind = 2", F.concat("h", F.lit("/docs"), k, F.lit("/swagger.json")), none, F.concat(F.lit('<a href="/deep'), k, F.lit('/openapi.json">deep</a>')), F.lit(html)),
        ("kind = 2 AND k % 2 = 0", F.concat("h", F.lit("/deep"), k, F.lit("/openapi.json")), none, spec(F.array(F.concat(F.lit("/d"), k))), F.lit(json)),
        ("kind = 3", F.col("url"), none, F.lit("oops"), F.lit(json)),
        ("kind = 4", F.col("url"), F.lit("RESPONSE_TOO_LARGE"), none, none),
    ]
    for where, *columns in made:
        pages = pages.union(o.where(where).select(*columns))
    return sources, pages.withColumn("link", none)


# The same by hand: a chain's pages one by one, then a source's seeds one by one, then its documents one by one.
_CRAWL = """
WITH RECURSIVE s AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderkey % 11 AS kind, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS no, 4 + o_custkey % 9 AS budget, 3 + o_custkey % 4 AS cap FROM orders),
lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_tax) AS p FROM lineitem),
raw AS (SELECT l_orderkey AS k, p, count(*) OVER (PARTITION BY l_orderkey) AS n, p > 1 AND l_returnflag = 'R' AND l_tax >= 0.07 AS bad, p > 1 AND month(l_shipdate) = 3 AS csv, p > 1 AND l_discount >= 0.09 AS again, CASE WHEN l_quantity > 15 THEN 2 ELSE 0 END AS r FROM lines),
chain(k, p, total, idle, stop) AS (
  SELECT s.k, 1, raw.r, 0, CASE WHEN raw.r >= 5 THEN 'MAX_RECORDS' WHEN n = 1 THEN 'NO_EXPLICIT_NEXT' END FROM s JOIN raw ON s.k = raw.k AND raw.p = 1 WHERE kind > 4
  UNION ALL
  SELECT c.k, c.p + 1, CASE WHEN bad OR csv OR again THEN c.total ELSE c.total + r END, CASE WHEN r = 0 THEN c.idle + 1 ELSE 0 END,
         CASE WHEN bad THEN 'FETCH_ERROR' WHEN csv THEN 'FORMAT_CHANGED' WHEN again THEN 'REPEATED_PAYLOAD' WHEN r = 0 AND c.idle >= 1 THEN 'STAGNANT' WHEN c.p + 1 >= 5 THEN 'MAX_PAGES'
              WHEN c.total + r >= 5 THEN 'MAX_RECORDS' WHEN c.p + 1 >= n THEN 'NO_EXPLICIT_NEXT' END
  FROM chain c JOIN raw ON c.k = raw.k AND raw.p = c.p + 1 WHERE c.stop IS NULL),
whole AS (SELECT k, max(p) AS steps, max(stop) AS stop FROM chain GROUP BY k),
outcome AS (SELECT s.*, steps, stop, CASE kind WHEN 0 THEN 'FAILED' WHEN 1 THEN 'OPENAPI' WHEN 2 THEN 'PAGE' WHEN 3 THEN 'INVALID_RESPONSE' WHEN 4 THEN 'TOO_LARGE' ELSE CASE WHEN steps IS NULL THEN 'FAILED' ELSE 'DATA' END END AS outcome,
  coalesce(sum(coalesce(steps, 1)) OVER (PARTITION BY c ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s LEFT JOIN whole ON s.k = whole.k),
fold(c, no, n, reason) AS (
  SELECT c, 0, 0::BIGINT, NULL::VARCHAR FROM s WHERE no = 0
  UNION ALL
  SELECT f.c, f.no + (CASE WHEN f.n >= cap OR before >= budget THEN 0 ELSE 1 END), CASE WHEN f.n >= cap OR before >= budget THEN f.n ELSE CASE outcome WHEN 'OPENAPI' THEN least(cap, f.n + k % 4 + 1) WHEN 'PAGE' THEN f.n + 3 WHEN 'DATA' THEN f.n + 1 WHEN 'TOO_LARGE' THEN f.n + 1 ELSE f.n END END,
         CASE WHEN f.n >= cap THEN 'MAX_API_ENDPOINTS' WHEN before >= budget THEN 'REQUEST_BUDGET_EXCEEDED' END
  FROM fold f JOIN outcome o ON o.c = f.c AND o.no = f.no WHERE f.reason IS NULL),
src AS (SELECT c, max(no) AS begun, max(n) AS n, max(reason) AS reason FROM fold GROUP BY c),
att AS (SELECT o.c, o.no, o.k, o.outcome, o.stop, o.budget, x.step, o.steps, o.before + x.step AS req FROM outcome o, (SELECT unnest(range(1, 6)) AS step) x JOIN src ON src.c = o.c WHERE x.step <= coalesce(o.steps, 1) AND o.no < src.begun AND o.before + x.step <= o.budget),
seed AS (
  SELECT a.c, a.no, any_value(a.outcome) AS outcome, max(a.step) AS last_step, max(a.req) AS last, any_value(a.steps) AS steps, any_value(a.stop) AS stop, any_value(a.budget) AS budget,
         count(*) FILTER (a.outcome = 'DATA' AND NOT (a.step > 1 AND (bad OR csv OR again))) AS pages, coalesce(sum(r) FILTER (a.outcome = 'DATA' AND NOT (a.step > 1 AND (bad OR csv OR again))), 0)::BIGINT AS records
  FROM att a LEFT JOIN raw ON raw.k = a.k AND raw.p = a.step GROUP BY a.c, a.no),
seeds AS (
  SELECT c AS source_id, no AS seed_no, outcome, pages, records, CASE WHEN pages > 0 AND last_step > 1 THEN 'numeric_page' END AS strategy,
         CASE WHEN stop IS NOT NULL AND last >= budget AND (last_step < steps OR stop NOT IN ('MAX_PAGES', 'FETCH_ERROR', 'FORMAT_CHANGED', 'REPEATED_PAYLOAD', 'STAGNANT')) THEN 'REQUEST_BUDGET' ELSE stop END AS stop FROM seed)"""


@query(_CRAWL + " SELECT source_id, seed_no, outcome, pages, records, strategy, stop FROM seeds")
def api_crawl_seeds(spark, sf_dir):
    """G04, G05."""
    return C.api_crawl(*captured(spark, sf_dir), documents=False)["seeds"].select("source_id", "seed_no", "outcome", "pages", "records", "strategy", "stop")


_DOCUMENTS = """,
used AS (SELECT c, count(*) AS used FROM att GROUP BY c),
q0 AS (SELECT o.c, o.k, i, row_number() OVER (PARTITION BY o.c ORDER BY o.no, i) AS n FROM outcome o JOIN src ON src.c = o.c AND o.no < src.begun, (SELECT unnest([1, 2]) AS i) WHERE outcome = 'PAGE'),
d0 AS (SELECT q0.*, n <= 5 AND coalesce(used, 0) + n <= 4 + q0.c % 9 AS ok FROM q0 LEFT JOIN used ON used.c = q0.c),
k0 AS (SELECT c, count(*) FILTER (ok) AS taken, bool_and(ok) AS all_ok FROM d0 GROUP BY c),
q1 AS (SELECT d0.c, k, 3 AS i, row_number() OVER (PARTITION BY d0.c ORDER BY n) AS m, taken FROM d0 JOIN k0 ON k0.c = d0.c WHERE i = 2 AND ok AND all_ok),
d AS (SELECT c, k, i, n FROM d0 WHERE ok UNION ALL SELECT q1.c, k, i, taken + m FROM q1 LEFT JOIN used ON used.c = q1.c WHERE taken + m <= 5 AND coalesce(used, 0) + taken + m <= 4 + q1.c % 9),
grow(c, n, keys) AS (
  SELECT c, 0::BIGINT, n FROM src
  UNION ALL
  SELECT g.c, g.n + 1, CASE WHEN i = 1 THEN greatest(g.keys, least(3 + g.c % 4, g.keys + 2)) WHEN i = 3 AND k % 2 = 0 THEN greatest(g.keys + 1, least(3 + g.c % 4, g.keys + 2)) ELSE g.keys END FROM grow g JOIN d ON d.c = g.c AND d.n = g.n + 1),
docs AS (SELECT c, count(*) AS probed, count(*) FILTER (i = 3 AND k % 2 = 1) AS failed, count(*) FILTER (i = 1 OR (i = 3 AND k % 2 = 0)) AS specs FROM d GROUP BY c),
cov AS (SELECT source_id AS c, sum(pages) AS pages, sum(records) AS records, count(*) FILTER (stop NOT IN ('NO_EXPLICIT_NEXT', 'MAX_PAGES')) AS stopped, count(*) FILTER (outcome = 'OPENAPI') AS specs, count(*) FILTER (outcome IN ('FAILED', 'INVALID_RESPONSE')) + count(*) FILTER (stop = 'FETCH_ERROR') AS failed, count(*) FILTER (outcome NOT IN ('FAILED', 'INVALID_RESPONSE')) AS good,
  arg_max(outcome, seed_no) FILTER (outcome IN ('FAILED', 'INVALID_RESPONSE')) AS last_bad, arg_max(seed_no, seed_no) FILTER (outcome IN ('FAILED', 'INVALID_RESPONSE')) AS last_no FROM seeds GROUP BY 1)
SELECT src.c AS source_id, coalesce(used, 0) + coalesce(probed, 0) AS requests, coalesce(cov.pages, 0)::BIGINT AS api_pages_visited, coalesce(cov.records, 0)::BIGINT AS api_records_sampled, coalesce(stopped, 0) AS pagination_stopped, coalesce(probed, 0) AS documents_probed, coalesce(docs.failed, 0) AS document_errors,
  coalesce(cov.specs, 0) + coalesce(docs.specs, 0) AS openapi_documents, coalesce(cov.failed, 0) + coalesce(docs.failed, 0) AS urls_failed, (SELECT max(keys) FROM grow WHERE grow.c = src.c)::INT AS api_endpoints, coalesce(reason, 'API_SEEDS_EXHAUSTED') AS stop_reason,
  coalesce(good, 0) > 0 OR coalesce(cov.failed, 0) + coalesce(docs.failed, 0) = 0 AS success,
  CASE WHEN coalesce(good, 0) = 0 AND cov.failed > 0 THEN CASE WHEN last_bad = 'INVALID_RESPONSE' THEN 'INVALID_RESPONSE' WHEN o.kind = 0 THEN 'TIMEOUT' ELSE 'NOT_CAPTURED' END END AS failure_code
FROM src LEFT JOIN used ON used.c = src.c LEFT JOIN cov ON cov.c = src.c LEFT JOIN docs ON docs.c = src.c LEFT JOIN outcome o ON o.c = src.c AND o.no = last_no"""


@query(_CRAWL + _DOCUMENTS)
def api_crawl_sources(spark, sf_dir):
    """G04, G06."""
    return C.api_crawl(*captured(spark, sf_dir))["sources"]


@query(_CRAWL + " SELECT c AS source_id, req AS request_no, CASE step WHEN 1 THEN 'SEED' ELSE 'PAGE' END AS phase FROM att")
def data_endpoint_crawl(spark, sf_dir):
    """The requests of custom sources, which ask their data endpoints and probe no documentation."""
    sources, responses = captured(spark, sf_dir)
    blank = F.when(F.col("source_id") % 2 == 0, F.array_insert("seeds", 1, " "))
    custom = C.data_endpoint_sources(sources.select("source_id", "seeds", blank.alias("data_endpoints"))).drop("failure_code")
    out = C.api_crawl(custom.join(sources.select("source_id", "max_requests", "max_endpoints", "max_records"), "source_id"), responses)
    return out["attempts"].select("source_id", "request_no", "phase")
